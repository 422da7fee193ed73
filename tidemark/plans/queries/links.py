"""Entity linkage, allocation, balances, inventory merge and topic checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import norm_key
from tidemark.operators import inventory as inv
from tidemark.operators import linkage as lk
from tidemark.plans.queries.registry import query, rounded, table


def coded(spark, sf):
    """Customers with noisy codes: mixed case, blanks, and a second code that only some rows carry."""
    c = table(spark, sf, "customer")
    seg = F.col("c_mktsegment")
    return c.select(
        F.concat(F.lit(" "), F.lower(seg), F.lit("-"), F.col("c_nationkey").cast("string"), F.lit(" ")).alias("code_a"),
        F.when(F.col("c_nationkey") < 10, F.concat(F.lit("n"), F.col("c_nationkey").cast("string"))).alias("code_b"),
        F.round(F.abs("c_acctbal")).cast("bigint").alias("amount"),
    )


def register(spark, sf):
    s = table(spark, sf, "supplier")
    seg = F.when(F.col("s_suppkey") % 2 == 0, "MACHINERY").otherwise("Household")
    return s.select(
        F.concat(seg, F.lit("-"), F.col("s_nationkey").cast("string")).alias("kood"),
        F.concat(F.lit("N"), F.col("s_nationkey").cast("string")).alias("kkr_kood"),
        F.col("s_suppkey").alias("id"),
    )


CODED_SQL = """
g AS (SELECT ' ' || lower(c_mktsegment) || '-' || c_nationkey || ' ' AS code_a, CASE WHEN c_nationkey < 10 THEN 'n' || c_nationkey END AS code_b, CAST(round(abs(c_acctbal)) AS BIGINT) AS amount FROM customer),
r AS (SELECT CASE WHEN s_suppkey % 2 = 0 THEN 'MACHINERY' ELSE 'Household' END || '-' || s_nationkey AS kood, 'N' || s_nationkey AS kkr_kood, s_suppkey AS id FROM supplier)"""


def _pair(a: str, b: str) -> str:
    return f"""SELECT '{a}' AS left_column, '{b}' AS right_column, (SELECT count(DISTINCT upper(trim({a}))) FROM g) AS distinct_left,
(SELECT count(DISTINCT upper(trim({b}))) FROM r) AS distinct_right,
(SELECT count(*) FROM (SELECT DISTINCT upper(trim({a})) AS k FROM g) x JOIN (SELECT DISTINCT upper(trim({b})) AS k FROM r) y ON x.k = y.k) AS matching_codes,
round((SELECT coalesce(sum(amount), 0) FROM g WHERE upper(trim({a})) IN (SELECT upper(trim({b})) FROM r)) / (SELECT sum(amount) FROM g), 9) AS matching_volume_share"""


@query(
    "key_linkage_report",
    "G01 G10 G11 G13",
    f"WITH {CODED_SQL} " + " UNION ALL ".join(_pair(a, b) for a in ("code_a", "code_b") for b in ("kood", "kkr_kood")),
)
def key_linkage_report(spark, sf):
    return rounded(lk.link_report(coded(spark, sf), register(spark, sf), ["code_a", "code_b", "absent"], ["kood", "kkr_kood"], "amount"), 9)


def _reg(c: str) -> str:
    return f"""SELECT '{c}' AS register_column, (SELECT count(DISTINCT upper(trim(code_a))) FROM g) AS distinct_amount_codes, (SELECT count(DISTINCT upper(trim({c}))) FROM r) AS distinct_register_codes,
(SELECT count(DISTINCT upper(trim({c}))) FROM r WHERE upper(trim({c})) IN (SELECT upper(trim(code_a)) FROM g)) AS matching_codes,
(SELECT count(DISTINCT id) FROM r WHERE upper(trim({c})) IN (SELECT upper(trim(code_a)) FROM g)) AS matched_ids,
(SELECT count(DISTINCT id) FROM r WHERE upper(trim({c})) IN (SELECT upper(trim(code_a)) FROM g) AND id IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 49)) AS matched_ids_with_target,
round((SELECT coalesce(sum(amount), 0) FROM g WHERE upper(trim(code_a)) IN (SELECT upper(trim({c})) FROM r)) / (SELECT sum(amount) FROM g), 9) AS matching_volume_share"""


@query("registry_report", "G12", f"WITH {CODED_SQL} " + " UNION ALL ".join(_reg(c) for c in ("kood", "kkr_kood")))
def registry_report(spark, sf):
    links = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("link"), F.when(F.col("l_quantity") > 49, F.col("l_partkey")).alias("target")
    )
    return rounded(
        lk.registry_report(coded(spark, sf), register(spark, sf), links, "code_a", "amount", ["kood", "kkr_kood"], "id", "link", "target"), 9
    )


UNITS_SQL = """
bh AS (SELECT l_suppkey AS link, CAST(CASE WHEN l_suppkey % 3 = 0 THEN l_partkey % 7 ELSE l_suppkey // 4 END AS BIGINT) AS unit FROM lineitem),
pid AS (SELECT link, count(DISTINCT unit) AS units, min(unit) AS unit FROM bh GROUP BY 1),
k AS (SELECT s_suppkey AS id, upper(trim(' n' || CAST(s_suppkey // 2 AS VARCHAR))) AS code FROM supplier),
ib AS (SELECT code, count(*) AS entries, coalesce(max(units), 0) AS units, min(unit) AS unit,
       CASE WHEN min(unit) IS NULL THEN 0 WHEN min(unit) = max(unit) THEN 1 ELSE 2 END AS unit_n FROM k LEFT JOIN pid ON k.id = pid.link GROUP BY 1),
ab AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, 'N' || CAST(l_suppkey // 2 + CASE WHEN l_linenumber = 7 THEN 1000000 ELSE 0 END AS VARCHAR) AS code, l_quantity AS amount FROM lineitem),
al AS (SELECT ab.*, ib.unit, CASE WHEN coalesce(unit_n, 0) = 0 THEN 'none' WHEN units > 1 OR unit_n > 1 THEN 'multiple' ELSE 'single' END AS class FROM ab LEFT JOIN ib USING (code))"""


def allocated(spark, sf):
    li, s = table(spark, sf, "lineitem"), table(spark, sf, "supplier")
    # every third supplier draws from several units
    unit = F.when(F.col("l_suppkey") % 3 == 0, F.col("l_partkey") % 7).otherwise(F.floor(F.col("l_suppkey") / 4))
    bores = li.select(F.col("l_suppkey").alias("link"), unit.alias("unit"))
    half = F.floor(F.col("s_suppkey") / 2).cast("string")
    reg = s.select(F.col("s_suppkey").alias("id"), F.concat(F.lit(" n"), half).alias("kkr"))
    units = lk.code_units(reg, bores, "kkr", "id", "link", "unit")
    code = F.floor(F.col("l_suppkey") / 2) + F.when(F.col("l_linenumber") == 7, 1000000).otherwise(0)
    amounts = li.select(
        F.year("l_shipdate").alias("year"), F.concat(F.lit("n"), code.cast("string"), F.lit(" ")).alias("raw"), F.col("l_quantity").alias("amount")
    )
    return lk.allocate(amounts, units, "raw"), units, reg


@query("code_units", "G02", f"WITH {UNITS_SQL} SELECT code, entries, units, CAST(unit AS DOUBLE) AS unit, unit_n FROM ib")
def code_units(spark, sf):
    return allocated(spark, sf)[1].withColumn("unit", F.col("unit").cast("double"))


@query(
    "allocate_classes",
    "G03 G06",
    f"""WITH {UNITS_SQL} SELECT year, sum(amount) AS total, count(*) AS rows, round(coalesce(sum(amount) FILTER (class = 'single'), 0) / sum(amount), 9) AS single,
round(coalesce(sum(amount) FILTER (class = 'multiple'), 0) / sum(amount), 9) AS multiple, round(coalesce(sum(amount) FILTER (class = 'none'), 0) / sum(amount), 9) AS "none" FROM al GROUP BY 1""",
)
def allocate_classes(spark, sf):
    return rounded(lk.class_shares(allocated(spark, sf)[0], ["year"], "class", "amount"), 9)


@query(
    "intake_types",
    "G08",
    f"""WITH {UNITS_SQL}, t AS (SELECT code, min(CASE WHEN id % 3 = 0 THEN 'deep' WHEN id % 3 = 1 THEN 'shallow' END) AS kind FROM k GROUP BY 1)
SELECT coalesce(kind, 'unknown') AS kind, sum(amount) AS total, count(DISTINCT al.code) AS codes, coalesce(sum(amount) FILTER (class = 'single'), 0) AS total_single
FROM al LEFT JOIN t ON al.code = t.code GROUP BY 1""",
)
def intake_types(spark, sf):
    g, _, reg = allocated(spark, sf)
    typed = reg.withColumn("kind", F.when(F.col("id") % 3 == 0, "deep").when(F.col("id") % 3 == 1, "shallow"))
    return lk.by_register_type(g, typed, "kkr", "kind", "amount", "unknown")


BALANCE_SQL = """
a AS (SELECT o_custkey % 40 + 5 AS body, sum(CAST(round(o_totalprice) AS BIGINT)) AS m, count(DISTINCT o_custkey) AS intakes FROM orders GROUP BY 1),
r AS (SELECT c_custkey % 40 AS body, count(*) AS deposits, coalesce(sum(CAST(round(c_acctbal) AS BIGINT) * 30), 0) AS reserve, count(*) AS n_with_reserve FROM customer GROUP BY 1),
j AS (SELECT coalesce(a.body, r.body) AS body, m / 365.0 AS per_day, intakes, deposits, reserve,
      CASE WHEN m / 365.0 > 0 AND reserve > 0 THEN m / 365.0 / reserve END AS ratio FROM a FULL JOIN r ON a.body = r.body)"""


def balance(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    amounts = o.select(
        (F.col("o_custkey") % 40 + 5).alias("body"), F.col("o_custkey").alias("code"), F.round("o_totalprice").cast("bigint").alias("m")
    )
    res = c.select((F.col("c_custkey") % 40).alias("body"), (F.round("c_acctbal").cast("bigint") * 30).alias("v"))
    return lk.balance_by_unit(amounts, lk.reserves_per_unit(res, "body", "v"), None, "body", "m")


@query(
    "balance_full_join",
    "G04 G07",
    f"""WITH {BALANCE_SQL} SELECT body, CAST(intakes AS DOUBLE) AS intakes, CAST(deposits AS DOUBLE) AS deposits, CAST(reserve AS DOUBLE) AS reserve, round(per_day, 6) AS per_day, round(ratio, 9) AS ratio FROM j""",
)
def balance_full_join(spark, sf):
    b = balance(spark, sf).select(
        "body", *[F.col(c).cast("double").alias(c) for c in ("intakes", "deposits", "reserve")], F.round("per_day", 6).alias("per_day"), F.round("ratio", 9).alias("ratio")
    )
    return b


@query(
    "balance_bands",
    "G07 G09",
    f"""WITH {BALANCE_SQL} SELECT count(intakes) AS units_with_amount, count(deposits) AS units_with_reserve, count(ratio) AS units_with_both,
round(coalesce(sum(per_day) FILTER (reserve IS NULL OR reserve <= 0), 0), 4) AS per_day_without_reserve, count(*) FILTER (ratio > 1) AS ratio_gt1,
count(*) FILTER (ratio > 0.5 AND ratio <= 1) AS ratio_05_1, count(*) FILTER (ratio <= 0.5) AS ratio_lt05,
round(coalesce(sum(per_day) FILTER (ratio IS NOT NULL), 0), 4) AS per_day_in_both, CAST(coalesce(sum(reserve) FILTER (ratio IS NOT NULL), 0) AS BIGINT) AS reserve_in_both FROM j""",
)
def balance_bands(spark, sf):
    return rounded(lk.balance_summary(balance(spark, sf)), 4)


@query(
    "dangling_links",
    "I24",
    """SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1""",
)
def dangling_links(spark, sf):
    o = table(spark, sf, "orders").where(F.col("o_orderstatus") != "P")
    return lk.missing_links(table(spark, sf, "lineitem").select("l_orderkey"), "l_orderkey", o, "o_orderkey").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n")
    )


INVENTORY_SQL = """
b AS (SELECT c_mktsegment AS grp, 'http://Host' || c_nationkey || '.org/p/' || c_custkey % 50 || '/' AS page, 'Host' || c_nationkey AS host, 'Book ' || c_custkey % 20 AS book, CASE WHEN c_custkey % 5 = 0 THEN '(unidentified)' ELSE 'V' || c_custkey % 3 END AS vw, c_custkey AS id FROM customer),
bk AS (SELECT *, 'http://host' || substr(host, 5) || '.org' || rtrim(regexp_extract(page, 'org(/.*)$', 1), '/') AS k1, lower(host) AS k2, lower(trim(book)) AS k3, CASE WHEN vw = '(unidentified)' THEN '' ELSE lower(vw) END AS k4 FROM b),
c AS (SELECT 'http://host' || s_nationkey || '.org/p/' || s_suppkey % 50 || '?x=1' AS page, 'HOST' || s_nationkey AS host, 'book ' || s_suppkey % 20 AS book, 'v' || s_suppkey % 3 AS vw,
      CASE WHEN s_suppkey % 4 = 0 THEN 'link' ELSE 'iframe' END AS kind FROM supplier),
ck AS (SELECT *, regexp_replace(page, '[?].*', '') AS k1, lower(host) AS k2, book AS k3, vw AS k4 FROM c WHERE kind = 'iframe'),
once AS (SELECT k1, k2, k3, k4, min(page) AS page, min(host) AS host, min(book) AS book, min(vw) AS vw FROM ck GROUP BY 1, 2, 3, 4)"""


def inventory_frames(spark, sf):
    c, s = table(spark, sf, "customer"), table(spark, sf, "supplier")
    nat = F.col("c_nationkey").cast("string")
    key = F.col("c_custkey")
    base = c.select(
        F.col("c_mktsegment").alias("group"),
        F.concat(F.lit("http://Host"), nat, F.lit(".org/p/"), (key % 50).cast("string"), F.lit("/")).alias("page_url"),
        F.concat(F.lit("Host"), nat).alias("host"),
        F.concat(F.lit("Book "), (key % 20).cast("string")).alias("workbook"),
        F.when(key % 5 == 0, "(unidentified)").otherwise(F.concat(F.lit("V"), (key % 3).cast("string"))).alias("view"),
        key.cast("string").alias("title"),
    )
    sn, sk = F.col("s_nationkey").cast("string"), F.col("s_suppkey")
    page = F.concat(F.lit("http://host"), sn, F.lit(".org/p/"), (sk % 50).cast("string"), F.lit("?x=1"))
    crawl = s.select(
        page.alias("page_url"), F.concat(F.lit("HOST"), sn).alias("host"), F.concat(F.lit("book "), (sk % 20).cast("string")).alias("workbook"),
        F.concat(F.lit("v"), (sk % 3).cast("string")).alias("view"), F.when(sk % 4 == 0, "link").otherwise("iframe").alias("kind"), page.alias("src"),
    )
    return base, crawl


@query(
    "inventory_merge",
    "I04 I06",
    f"""WITH {INVENTORY_SQL}
SELECT grp AS "group", bk.page AS page_url, bk.host, bk.book AS workbook, bk.vw AS view, CAST(id AS VARCHAR) AS title, 'inventory' AS origin, CASE WHEN o.k1 IS NOT NULL THEN 'yes' ELSE 'no' END AS found
FROM bk LEFT JOIN once o ON bk.k1 = o.k1 AND bk.k2 = o.k2 AND bk.k3 = o.k3 AND bk.k4 = o.k4
UNION ALL SELECT 'crawl', page, host, book, vw, '', 'crawl', 'yes' FROM once o WHERE NOT EXISTS (SELECT 1 FROM bk WHERE bk.k1 = o.k1 AND bk.k2 = o.k2 AND bk.k3 = o.k3 AND bk.k4 = o.k4)""",
)
def inventory_merge(spark, sf):
    base, crawl = inventory_frames(spark, sf)
    return inv.merge_inventory(base, crawl, None)


@query(
    "server_listing",
    "I05 I10",
    """WITH v AS (SELECT p_brand AS project, p_type || '/sheets/' || p_name AS content, p_name AS name, p_size FROM part),
r AS (SELECT 'server: ' || project AS grp, 'srv' AS host, split_part(content, '/sheets/', 1) AS workbook, CASE WHEN p_size % 2 = 0 THEN split_part(content, '/sheets/', 2) ELSE name END AS view FROM v WHERE p_size % 5 <> 0)
SELECT DISTINCT host, CASE WHEN true THEN workbook END AS workbook, view FROM r WHERE view <> ''""",
)
def server_listing(spark, sf):
    p = table(spark, sf, "part")
    even = F.col("p_size") % 2 == 0
    listing = p.select(
        F.when(F.col("p_size") % 5 != 0, "view").otherwise("workbook").alias("type"), F.col("p_brand").alias("project"), F.col("p_name").alias("name"),
        F.col("p_type").alias("workbook"),
        F.when(even, F.concat("p_type", F.lit("/sheets/"), "p_name")).otherwise(F.col("p_type")).alias("content_url"),
    )
    return inv.distinct_views([inv.server_rows(listing, "srv")])


@query(
    "topic_views",
    "I16 I24",
    """WITH t AS (SELECT n_name AS slug, n_nationkey AS grp FROM nation), i AS (SELECT c_nationkey AS grp, c_mktsegment AS host, count(*) AS n FROM customer GROUP BY 1, 2)
SELECT slug, CAST(coalesce(n, 0) AS BIGINT) AS views FROM t LEFT JOIN i ON t.grp = i.grp AND host = 'BUILDING'""",
)
def topic_views(spark, sf):
    n, c = table(spark, sf, "nation"), table(spark, sf, "customer")
    topics = n.select(
        F.col("n_name").alias("slug"), F.col("n_nationkey").cast("string").alias("group"), F.array("n_name").alias("related")
    )
    items = c.groupBy(F.col("c_nationkey").cast("string").alias("group"), F.col("c_mktsegment").alias("host")).agg(F.count(F.lit(1)).alias("views"))
    out = inv.attach_topics(topics, items, "BUILDING")["topics"]
    return out.select("slug", F.coalesce("views", F.lit(0)).alias("views"))


@query(
    "normalised_keys",
    "G01 G10",
    """SELECT upper(trim('  ' || lower(n_name) || ' ')) AS key, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
)
def normalised_keys(spark, sf):
    c, n = table(spark, sf, "customer"), table(spark, sf, "nation")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    return j.groupBy(norm_key(F.concat(F.lit("  "), F.lower("n_name"), F.lit(" "))).alias("key")).agg(F.count(F.lit(1)).alias("n"))
