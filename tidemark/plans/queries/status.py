"""Status snapshots, transitions, paired comparisons, site statistics and sampling-error propagation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import bin_of, period_label, ratio, upper_bound
from tidemark.functions.ranks import latest
from tidemark.operators import estimates as es
from tidemark.operators import transition as tr
from tidemark.plans import air, species
from tidemark.plans.queries.registry import query, rounded, table
from tidemark.sources.staging import staged

LATEST_SQL = """
lt AS (SELECT o_custkey, year, o_orderstatus, o_orderkey FROM (
  SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, o_orderkey,
         row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1),
cur AS (SELECT lt.*, c_mktsegment AS grp, CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' END AS cls FROM lt JOIN customer ON o_custkey = c_custkey)"""


def latest_orders(spark, sf):
    o = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    return latest(o, ["o_custkey", "year"], ["o_orderdate", "o_orderkey"], ["o_orderstatus", "o_orderkey"])


def current(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("grp"))
    cls = F.when(F.col("o_orderstatus") == "F", "1").when(F.col("o_orderstatus") == "O", "2")
    return latest_orders(spark, sf).join(c, "o_custkey").withColumn("cls", cls)


@query("latest_row", "V02 G05", f"WITH {LATEST_SQL} SELECT o_custkey, year, o_orderstatus, o_orderkey FROM lt")
def latest_row(spark, sf):
    return latest_orders(spark, sf)


@query(
    "latest_after",
    "V06",
    f"WITH {LATEST_SQL} SELECT o_custkey, max(year) AS year, arg_max(o_orderstatus, year) AS o_orderstatus FROM lt WHERE year > 1996 GROUP BY 1",
)
def latest_after(spark, sf):
    return tr.latest_after(latest_orders(spark, sf), "o_custkey", "year", 1996, ["o_orderstatus"])


DIST = """count(*) AS n, count(cls) AS classified, count(*) - count(cls) AS not_classified, count(*) FILTER (cls = '1') AS class_1,
count(*) FILTER (cls = '2') AS class_2, count(*) FILTER (cls = '3') AS class_3, round(count(*) FILTER (cls = '1') / count(cls), 6) AS share_good"""


@query("class_distribution", "V03 V04", f"WITH {LATEST_SQL} SELECT year, {DIST} FROM cur GROUP BY 1")
def class_distribution(spark, sf):
    return rounded(tr.distribution(current(spark, sf), ["year"], classes=("1", "2", "3"), good=("1",)))


@query(
    "class_distribution_baseline",
    "V01 V05",
    f"""WITH {LATEST_SQL}, g AS (SELECT * FROM (VALUES ('BUILDING'), ('MACHINERY'), ('NO SUCH GROUP')) t(grp)),
d AS (SELECT grp, {DIST} FROM cur WHERE year = 1996 GROUP BY 1)
SELECT g.grp, coalesce(n, 0) AS n, coalesce(classified, 0) AS classified, coalesce(not_classified, 0) AS not_classified,
coalesce(class_1, 0) AS class_1, coalesce(class_2, 0) AS class_2, coalesce(class_3, 0) AS class_3, share_good FROM g LEFT JOIN d ON g.grp = d.grp""",
)
def class_distribution_baseline(spark, sf):
    d = tr.distribution(current(spark, sf).where(F.col("year") == 1996), ["grp"], classes=("1", "2", "3"), good=("1",))
    return rounded(tr.with_fixed_groups(d, "grp", ["BUILDING", "MACHINERY", "NO SUCH GROUP"]))


PAIRS_SQL = """
ba AS (SELECT o_custkey, grp, cls AS cls0 FROM cur WHERE year = 1996),
la AS (SELECT o_custkey, arg_max(CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '0' END, year) AS c1 FROM lt WHERE year > 1996 GROUP BY 1),
pr AS (SELECT o_custkey, grp, cls0, nullif(c1, '0') AS cls_later FROM ba JOIN la USING (o_custkey) WHERE cls0 IS NOT NULL AND c1 <> '0')"""


def pairs(spark, sf):
    cur = staged(current(spark, sf))  # read for both ends
    base = cur.where(F.col("year") == 1996).select("o_custkey", "grp", F.col("cls").alias("cls0"))
    later = tr.latest_after(cur, "o_custkey", "year", 1996, ["cls"]).select("o_custkey", F.col("cls").alias("cls_later"))
    return base, later


@query(
    "paired_classes",
    "V07",
    f"""WITH {LATEST_SQL}, {PAIRS_SQL} SELECT grp, count(*) AS n, count(*) FILTER (cls_later < cls0) AS improved, count(*) FILTER (cls_later = cls0) AS same,
count(*) FILTER (cls_later > cls0) AS worsened, count(*) FILTER (cls0 = '1') AS good_before, count(*) FILTER (cls_later = '1') AS good_after
FROM pr GROUP BY ROLLUP (grp)""",
)
def paired_classes(spark, sf):
    base, later = pairs(spark, sf)
    return tr.paired_classes(base, later, "o_custkey", group="grp", good=("1",))


@query(
    "transition_matrix",
    "V07",
    f"""WITH {LATEST_SQL}, {PAIRS_SQL}, k AS (SELECT * FROM (VALUES ('1'), ('2'), ('3')) t(cls0))
SELECT k.cls0, count(*) FILTER (cls_later = '1') AS to_1, count(*) FILTER (cls_later = '2') AS to_2, count(*) FILTER (cls_later = '3') AS to_3
FROM k LEFT JOIN pr ON pr.cls0 = k.cls0 GROUP BY 1""",
)
def transition_matrix(spark, sf):
    base, later = pairs(spark, sf)
    return tr.transition_matrix(base.join(later, "o_custkey"), "cls0", "cls_later", ("1", "2", "3"))


@query(
    "status_targets",
    "V08",
    """SELECT count(*) AS objective_rows, count(f) AS flagged, count(*) FILTER (f = 'F') AS achieved, count(*) FILTER (f <> 'F') AS not_achieved
FROM (SELECT nullif(o_orderstatus, 'P') AS f FROM orders WHERE year(o_orderdate) = 1996)""",
)
def status_targets(spark, sf):
    o = table(spark, sf, "orders").where(F.year("o_orderdate") == 1996).withColumn("f", F.nullif("o_orderstatus", F.lit("P")))
    return tr.status_targets(o, "f", "F")


@query(
    "share_with_condition",
    "V09",
    """WITH p AS (SELECT c_mktsegment AS grp, o_custkey, max(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 1 ELSE 0 END) AS hit
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
SELECT grp, count(*) AS assessed, CAST(sum(hit) AS BIGINT) AS with_condition, round(sum(hit) / count(*), 6) AS share FROM p GROUP BY 1""",
)
def share_with_condition(spark, sf):
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("grp"))
    hit = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    return rounded(tr.share_with_condition(o.join(c, "o_custkey"), "o_custkey", hit, "grp"))


@query(
    "entities_by_attribute",
    "V09 K07",
    """SELECT nullif(o_orderpriority, '5-LOW') AS name, count(DISTINCT o_custkey) AS bodies, count(*) AS pressures FROM orders
WHERE o_orderpriority <> '5-LOW' GROUP BY 1""",
)
def entities_by_attribute(spark, sf):
    o = table(spark, sf, "orders").withColumn("pr", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return tr.by_attribute(o, "pr", "o_custkey")


@query(
    "class_counts_by_year",
    "V10",
    """WITH l AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, 'l_returnflag' AS status, l_returnflag AS cls FROM lineitem
UNION ALL SELECT CAST(year(l_shipdate) AS INTEGER), 'l_linestatus', l_linestatus FROM lineitem)
SELECT year, status, count(*) AS n, count(*) FILTER (cls = 'R') AS "class_R", count(*) FILTER (cls = 'F') AS "class_F" FROM l GROUP BY 1, 2""",
)
def class_counts_by_year(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    return tr.class_counts_by_year(li, "year", ["l_returnflag", "l_linestatus"], ["R", "F"])


@query(
    "first_last_change",
    "V10 K05",
    """WITH y AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(count(*) % 5 AS INTEGER) AS v FROM lineitem GROUP BY 1, 2),
e AS (SELECT min(year) AS a, max(year) AS b FROM y),
p AS (SELECT x.l_suppkey, x.v AS a, z.v AS b FROM y x JOIN y z ON x.l_suppkey = z.l_suppkey, e WHERE x.year = e.a AND z.year = e.b)
SELECT count(*) AS n, count(*) FILTER (b < a) AS improved, count(*) FILTER (b = a) AS same, count(*) FILTER (b > a) AS worsened FROM p""",
)
def first_last_change(spark, sf):
    y = table(spark, sf, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(F.count(F.lit(1)).alias("n"))
    y = y.withColumn("v", (F.col("n") % 5).cast("int"))
    return tr.change_counts(tr.first_and_last(y, "l_suppkey", "year", "v"))


@query(
    "paired_first_last",
    "Q07",
    """WITH y AS (SELECT l_returnflag, l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, avg(l_quantity) AS m FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) >= 2),
u AS (SELECT l_returnflag, year, row_number() OVER (PARTITION BY l_returnflag ORDER BY year) AS up, row_number() OVER (PARTITION BY l_returnflag ORDER BY year DESC) AS down,
      count(*) OVER (PARTITION BY l_returnflag) AS k FROM (SELECT DISTINCT l_returnflag, year FROM y)),
p AS (SELECT y.l_returnflag, l_suppkey, avg(m) FILTER (up <= 3) AS a, avg(m) FILTER (down <= 3) AS b FROM y JOIN u ON y.l_returnflag = u.l_returnflag AND y.year = u.year
      WHERE k >= 6 GROUP BY 1, 2),
w AS (SELECT *, 100.0 * (b / a - 1) AS pct FROM p WHERE a IS NOT NULL AND b IS NOT NULL),
s AS (SELECT l_returnflag, min(year) FILTER (up <= 3) AS ff, max(year) FILTER (up <= 3) AS ft, min(year) FILTER (down <= 3) AS lf, max(year) FILTER (down <= 3) AS lt FROM u GROUP BY 1)
SELECT w.l_returnflag, count(*) AS stations, round(count(*) FILTER (b < a) / count(*), 6) AS share_decreased, round(median(a), 6) AS median_first, round(median(b), 6) AS median_last,
round(CASE WHEN bool_and(a > 0) THEN median(pct) END, 6) AS median_change_pct, ff AS first_from, ft AS first_to, lf AS last_from, lt AS last_to
FROM w JOIN s ON w.l_returnflag = s.l_returnflag GROUP BY w.l_returnflag, ff, ft, lf, lt HAVING count(*) >= 3""",
)
def paired_first_last(spark, sf):
    from tidemark.operators.mergeable import gated_mean

    li = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    y = gated_mean(li, ["l_returnflag", "l_suppkey", "year"], "l_quantity", 2)
    return rounded(tr.paired_ends(y, ["l_returnflag"], "l_suppkey", "year", "value"))


@query(
    "paired_periods",
    "N23 N24",
    """WITH r AS (SELECT l_linestatus, l_suppkey, CAST(1995 + ((year(l_shipdate) - 1995) // 3) * 3 AS INTEGER) AS s, l_quantity AS v FROM lineitem),
p AS (SELECT l_linestatus, l_suppkey, s || '-' || (s + 2) AS period, median(v) AS v FROM r GROUP BY 1, 2, 3),
k AS (SELECT l_linestatus, period FROM p GROUP BY 1, 2 HAVING count(*) >= 10),
e AS (SELECT l_linestatus, min(period) AS f, max(period) AS t FROM k GROUP BY 1 HAVING min(period) < max(period)),
w AS (SELECT p.l_linestatus, f, t, l_suppkey, max(v) FILTER (period = f) AS a, max(v) FILTER (period = t) AS b FROM p JOIN e ON p.l_linestatus = e.l_linestatus GROUP BY 1, 2, 3, 4)
SELECT l_linestatus, f AS "from", t AS "to", count(*) AS plots, round(count(*) FILTER (b > a) / count(*), 6) AS share_increased, round(median(a), 6) AS median_first,
round(median(b), 6) AS median_last, round(median(b - a), 6) AS median_change FROM w WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY 1, 2, 3""",
)
def paired_periods(spark, sf):
    li = table(spark, sf, "lineitem").select("l_linestatus", "l_suppkey", period_label(F.year("l_shipdate"), 1995, 3).alias("period"), "l_quantity")
    return rounded(tr.paired_periods(li, ["l_linestatus"], "l_suppkey", "period", "l_quantity", 10))


@query(
    "text_class_upper",
    "N13 N14 N15",
    """WITH l AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '>' || p_size || '-' || (p_size + 5) || '%' WHEN 1 THEN p_size || ' %, none' WHEN 2 THEN 'Hindamata' ELSE 'unclear' END AS label FROM part),
u AS (SELECT *, CASE WHEN label LIKE 'Hindamata%' THEN NULL WHEN regexp_extract(label, '>?\\s*(\\d+)\\s*[-–]\\s*(\\d+)\\s*%', 2) <> '' THEN CAST(regexp_extract(label, '>?\\s*(\\d+)\\s*[-–]\\s*(\\d+)\\s*%', 2) AS DOUBLE)
      WHEN regexp_extract(label, '^\\s*(\\d+)\\s*%', 1) <> '' THEN CAST(regexp_extract(label, '^\\s*(\\d+)\\s*%', 1) AS DOUBLE) END AS upper FROM l)
SELECT p_partkey, label, upper, CASE WHEN upper IS NULL THEN NULL WHEN upper <= 10 THEN 'none' WHEN upper <= 25 THEN 'slight' WHEN upper <= 60 THEN 'moderate' ELSE 'severe' END AS cls FROM u""",
)
def text_class_upper(spark, sf):
    return labels(spark, sf).select("p_partkey", "label", "upper", "cls")


def labels(spark, sf):
    size = F.col("p_size")
    text = (
        F.when(size % 4 == 0, F.concat(F.lit(">"), size.cast("string"), F.lit("-"), (size + 5).cast("string"), F.lit("%")))
        .when(size % 4 == 1, F.concat(size.cast("string"), F.lit(" %, none")))
        .when(size % 4 == 2, F.lit("Hindamata"))
        .otherwise(F.lit("unclear"))
    )
    p = table(spark, sf, "part").withColumn("label", text).withColumn("upper", upper_bound("label"))
    return p.withColumn("cls", bin_of("upper", species.CROWN_EDGES, "severe"))


@query(
    "grouping_sets_report",
    "N16 N17 V07 M06",
    """WITH r AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag AS sp, l_suppkey AS place, CASE WHEN l_quantity <= 10 THEN 'none' WHEN l_quantity <= 25 THEN 'slight' WHEN l_quantity <= 45 THEN 'moderate' ELSE 'severe' END AS cls, l_quantity AS upper FROM lineitem)
SELECT year, sp, CAST(grouping(sp) AS INTEGER) AS all_species, count(*) AS trees, count(DISTINCT place) AS plots, count(*) FILTER (cls = 'none') AS "none", count(*) FILTER (cls = 'slight') AS slight,
count(*) FILTER (cls = 'moderate') AS moderate, count(*) FILTER (cls = 'severe') AS severe, round(count(*) FILTER (cls IN ('moderate', 'severe')) / count(*), 6) AS share_damaged, round(avg(upper), 6) AS mean_upper
FROM r GROUP BY GROUPING SETS ((year), (year, sp))""",
)
def grouping_sets_report(spark, sf):
    edges = ((10.0, "none"), (25.0, "slight"), (45.0, "moderate"))
    r = table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("year"), F.col("l_returnflag").alias("sp"), F.col("l_suppkey").alias("place"), F.col("l_quantity").alias("upper")
    ).withColumn("cls", bin_of("upper", edges, "severe"))
    return rounded(species.damage_by_year(r, "year", "sp", "place"))


RN = "row_number() OVER (PARTITION BY {k} ORDER BY v) AS rn, count(*) OVER (PARTITION BY {k}) AS n"


@query(
    "period_buckets",
    "N18 N21",
    f"""WITH r AS (SELECT o_orderstatus, CAST(1995 + ((year(o_orderdate) - 1995) // 2) * 2 AS INTEGER) AS s, o_custkey, o_totalprice AS v, CASE WHEN o_orderpriority = '5-LOW' THEN 1 END AS mark FROM orders),
p AS (SELECT *, s || '-' || (s + 1) AS period FROM r), q AS (SELECT *, {RN.format(k='o_orderstatus, period')} FROM p)
SELECT o_orderstatus, period, count(*) AS samples, count(DISTINCT o_custkey) AS plots, count(mark) AS below_loq_mark, round(median(v), 4) AS median,
max(v) FILTER (rn = round((n - 1) * 0.1) + 1) AS p10, max(v) FILTER (rn = round((n - 1) * 0.9) + 1) AS p90 FROM q GROUP BY 1, 2""",
)
def period_buckets(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderstatus", period_label(F.year("o_orderdate"), 1995, 2).alias("period"), "o_custkey", "o_totalprice",
        F.when(F.col("o_orderpriority") == "5-LOW", 1).alias("mark"),
    )
    return rounded(tr.period_summary(o, ["o_orderstatus", "period"], "o_totalprice", "o_custkey", "mark"), 4)


@query(
    "method_list",
    "N22",
    """WITH g AS (SELECT o_orderstatus, o_orderpriority, count(*) AS rows, CAST(min(year(o_orderdate)) AS INTEGER) AS first_year, CAST(max(year(o_orderdate)) AS INTEGER) AS last_year FROM orders GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY rows DESC, o_orderpriority) AS INTEGER) AS rank FROM g) SELECT * FROM r WHERE rank <= 3""",
)
def method_list(spark, sf):
    from tidemark.plans.soil_water import methods

    o = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    return methods(o, ["o_orderstatus"], "o_orderpriority", 3)


@query(
    "two_level_medians",
    "W04",
    f"""WITH r AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_suppkey, l_quantity AS v FROM lineitem), q AS (SELECT *, {RN.format(k='year')} FROM r),
s AS (SELECT year, l_suppkey, median(v) AS med FROM r GROUP BY 1, 2), t AS (SELECT year, count(*) AS sites, count(*) FILTER (med > 25) / count(*) AS share FROM s GROUP BY 1)
SELECT q.year, count(*) AS samples, round(count(*) FILTER (v > 25) / count(*), 6) AS share_over_limit, round(median(v), 6) AS median, max(v) FILTER (rn = round((n - 1) * 0.9) + 1) AS p90,
sites, round(share, 6) AS site_share_over_limit FROM q JOIN t ON q.year = t.year GROUP BY q.year, sites, share""",
)
def two_level_medians(spark, sf):
    li = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year"), "l_suppkey", "l_quantity")
    return rounded(tr.two_level_limit(li, ["year"], "l_suppkey", "l_quantity", 25.0))


@query(
    "surface_statistics",
    "W06",
    f"""WITH r AS (SELECT p_type, CAST(year(l_shipdate) AS INTEGER) AS year, l_suppkey, l_quantity AS v FROM lineitem JOIN part ON l_partkey = p_partkey), q AS (SELECT *, {RN.format(k='p_type, year')} FROM r)
SELECT p_type, year, count(*) AS samples, count(DISTINCT l_suppkey) AS plots, round(median(v), 6) AS median, max(v) FILTER (rn = round((n - 1) * 0.25) + 1) AS p25,
max(v) FILTER (rn = round((n - 1) * 0.75) + 1) AS p75 FROM q GROUP BY 1, 2 HAVING count(*) >= 5""",
)
def surface_statistics(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part").select("p_partkey", "p_type")
    rows = li.join(p, li.l_partkey == p.p_partkey).select("p_type", F.year("l_shipdate").alias("year"), "l_suppkey", "l_quantity")
    return rounded(tr.period_summary(rows, ["p_type", "year"], "l_quantity", "l_suppkey", None, (0.25, 0.75), 5))


STATION_SQL = """
d AS (SELECT event_type, user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, avg(value) AS v, bool_or(value < 1) AS loq FROM events WHERE value >= 0 GROUP BY 1, 2, 3),
sy AS (SELECT event_type, user_id, count(*) AS days, avg(v) AS mean, count(*) FILTER (loq) AS loq_days, count(*) FILTER (v > 50) AS over_limit FROM d GROUP BY 1, 2
       HAVING count(*) >= CASE WHEN event_type IN ('error', 'signup') THEN 5 ELSE 10 END)"""


def station_frame(spark, sf):
    ev = table(spark, sf, "events").where(F.col("value") >= 0).select(
        "event_type", "user_id", F.to_date("ts").cast("string").alias("day"), F.col("value").alias("v"), F.when(F.col("value") < 1, "<").alias("mark")
    )
    day = air.daily(ev, ["event_type", "user_id", "day"], "v", "mark")
    need = F.when(F.col("event_type").isin("error", "signup"), 5).otherwise(10)
    return air.station_years(day, ["event_type", "user_id"], need)


@query(
    "station_years",
    "Q02 Q04 Q05",
    f"WITH {STATION_SQL} SELECT event_type, user_id, days, round(mean, 9) AS mean, loq_days, over_limit FROM sy",
)
def station_years(spark, sf):
    return rounded(station_frame(spark, sf), 9)


@query(
    "station_spread",
    "Q06 Q08",
    f"""WITH {STATION_SQL} SELECT event_type, count(*) AS stations, round(min(mean), 9) AS min, round(max(mean), 9) AS max, CAST(sum(days) AS BIGINT) AS days, round(sum(loq_days) / sum(days), 6) AS loq_share,
max(over_limit) AS over_max, count(*) FILTER (over_limit > 4) AS stations_above_allowed, round(median(mean), 9) AS median FROM sy GROUP BY 1""",
)
def station_spread(spark, sf):
    out = air.by_year(station_frame(spark, sf), ["event_type"], 4)
    return rounded(out.withColumn("loq_share", F.round("loq_share", 6)), 9)


@query(
    "target_unit_only",
    "Q03",
    """WITH u AS (SELECT event_type, value - 1 AS x, CASE WHEN event_type IN ('view', 'click') AND user_id < 30 THEN 'kg' ELSE 't' END AS unit FROM events),
v AS (SELECT event_type, x, CASE WHEN unit = CASE event_type WHEN 'view' THEN 'kg' WHEN 'click' THEN 't' WHEN 'error' THEN 't' END THEN x END AS v FROM u)
SELECT event_type, count(*) AS rows, count(*) FILTER (v IS NULL) AS other_unit, count(*) FILTER (v < 0) AS negative_or_sentinel, count(*) FILTER (v >= 0) AS used FROM v GROUP BY 1""",
)
def target_unit_only(spark, sf):
    from tidemark.operators.screening import target_unit_only as screen

    unit = F.when(F.col("event_type").isin("view", "click") & (F.col("user_id") < 30), "kg").otherwise("t")
    ev = table(spark, sf, "events").withColumns({"unit": unit, "x": F.col("value") - 1})
    used, left_out = screen(ev, "event_type", "x", "unit", {"view": "kg", "click": "t", "error": "t"})
    n = used.groupBy("event_type").agg(F.count(F.lit(1)).alias("used"))
    return left_out.join(n, "event_type", "left").na.fill(0, ["used"])


@query(
    "reporting_effort",
    "N10 N11 N12",
    """SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS year, count(DISTINCT l_suppkey) AS districts, count(*) AS observations FROM lineitem GROUP BY 1, 2""",
)
def reporting_effort(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    return species.effort(li, ["l_returnflag", "year"], "l_suppkey")


@query(
    "area_types",
    "K01 K02",
    """SELECT CASE WHEN starts_with(o_orderpriority, '1') OR starts_with(o_orderpriority, '2') THEN 'designated' ELSE 'planned' END AS status, coalesce(nullif(o_orderstatus, 'P'), 'unknown') AS name,
count(*) AS n, CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_totalprice > 100000), 0) AS DOUBLE) AS land_ha, count(*) FILTER (o_totalprice > 100000) AS n_land_area FROM orders GROUP BY 1, 2""",
)
def area_types(spark, sf):
    from tidemark.plans.nature import areas_by_type

    pr = F.col("o_orderpriority")
    o = table(spark, sf, "orders").select(
        F.when(pr.startswith("1") | pr.startswith("2"), "designated").otherwise("planned").alias("status"),
        F.nullif("o_orderstatus", F.lit("P")).alias("kind"),
        F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice").cast("decimal(18,2)")).alias("land"),
    )
    out = areas_by_type(o, ["status"], "kind", {"land_ha": "land"}, "unknown", count="n_land_area")
    return out.withColumn("land_ha", F.col("land_ha").cast("double"))


@query(
    "version_statistics",
    "K03 K04 K05 K06",
    """WITH r AS (SELECT coalesce(nullif(regexp_extract('version of ' || CAST(year(o_orderdate) AS VARCHAR) || ' data', '(?:19|20)\\d{2}', 0), ''), '?') AS version, o_custkey, o_orderpriority,
CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 END AS cons, CAST(round(o_totalprice) AS BIGINT) AS area FROM orders)
SELECT version, count(*) AS records, count(DISTINCT o_custkey) AS sites, count(DISTINCT o_orderpriority) AS types, CAST(sum(area) AS BIGINT) AS area, count(cons) AS rated,
count(*) FILTER (cons = 1) AS rated_1, count(*) FILTER (cons = 2) AS rated_2, count(*) FILTER (cons = 3) AS rated_3 FROM r GROUP BY 1""",
)
def version_statistics(spark, sf):
    from tidemark.functions.columns import lookup, version_label
    from tidemark.plans.nature import version_statistics as stats

    text = F.concat(F.lit("version of "), F.year("o_orderdate").cast("string"), F.lit(" data"))
    o = table(spark, sf, "orders").select(
        version_label(text).alias("version"), "o_custkey", "o_orderpriority", lookup("o_orderstatus", {"F": 1, "O": 2}).alias("cons"),
        F.round("o_totalprice").cast("bigint").alias("area"),
    )
    return stats(o, ["version"], {"sites": "o_custkey", "types": "o_orderpriority"}, "area")


PARTS_SQL = """
p AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag AS part, sum(l_quantity) AS value,
      CASE WHEN l_returnflag = 'N' AND max(year(l_shipdate)) = 1997 THEN NULL ELSE count(*) / 100000.0 END AS err FROM lineitem GROUP BY 1, 2)"""
TOTAL_SQL = """
t AS (SELECT year, sum(value) AS value, CASE WHEN sum(value) <> 0 AND NOT bool_or(err IS NULL AND value > 0)
      THEN sqrt(sum((value * coalesce(err, 0)) * (value * coalesce(err, 0)))) / sum(value) END AS err FROM p GROUP BY 1)"""


def parts_frame(spark, sf):
    li = table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year"), F.col("l_returnflag").alias("part")).agg(
        F.sum("l_quantity").alias("value"), F.count(F.lit(1)).alias("n")
    )
    unknown = (F.col("part") == "N") & (F.col("year") == 1997)
    return li.select("year", "part", "value", F.when(~unknown, F.col("n") / 100000.0).alias("err"))


@query("error_sum", "F02 F03 F19", f"WITH {PARTS_SQL}, {TOTAL_SQL} SELECT year, value, round(err, 9) AS err FROM t")
def error_sum(spark, sf):
    return rounded(es.total_over(parts_frame(spark, sf), ["year"]), 9)


@query(
    "error_ratio",
    "F05 F06",
    f"""WITH {PARTS_SQL}, a AS (SELECT * FROM p WHERE part = 'R'), b AS (SELECT * FROM p WHERE part = 'N'), c AS (SELECT * FROM p WHERE part = 'A'),
s AS (SELECT a.year, a.value + b.value AS value, sqrt(pow(a.value * a.err, 2) + pow(b.value * b.err, 2)) / (a.value + b.value) AS err FROM a JOIN b USING (year))
SELECT s.year, round(s.value / c.value, 9) AS value, round(sqrt(s.err * s.err + c.err * c.err), 9) AS err FROM s JOIN c USING (year) WHERE c.value <> 0""",
)
def error_ratio(spark, sf):
    p = parts_frame(spark, sf)
    r, n, a = (p.where(F.col("part") == k) for k in ("R", "N", "A"))
    return rounded(es.ratio_of(es.add(r, n), a), 9)


@query(
    "error_change",
    "F04 F16",
    f"""WITH {PARTS_SQL}, l AS (SELECT part, max(year) AS ly, min(year) AS fy FROM p GROUP BY 1),
e AS (SELECT p.part, max(p.year) AS ey FROM p JOIN l USING (part) WHERE p.year <= ly - 4 GROUP BY 1),
pr AS (SELECT part, 'since_start' AS period, fy AS y0, ly AS y1 FROM l UNION ALL SELECT e.part, 'last_4_years', ey, ly FROM e JOIN l USING (part))
SELECT pr.part, period, y0 AS "from", y1 AS "to", b.value - a.value AS diff, round((b.value - a.value) / a.value, 9) AS pct,
round(sqrt(pow(a.value * a.err, 2) + pow(b.value * b.err, 2)), 6) AS half_width, abs(b.value - a.value) > sqrt(pow(a.value * a.err, 2) + pow(b.value * b.err, 2)) AS distinguishable
FROM pr JOIN p a ON a.part = pr.part AND a.year = y0 JOIN p b ON b.part = pr.part AND b.year = y1""",
)
def error_change(spark, sf):
    out = es.changes(parts_frame(spark, sf), ["part"], 4)
    return out.withColumns({"pct": F.round("pct", 9), "half_width": F.round("half_width", 6)})


@query(
    "exact_shape_series",
    "F01 F07 F08 F09 F10 F11",
    """WITH c AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag AS d1, l_linestatus AS d2, sum(l_quantity) AS v FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus), 1)
SELECT 'all' AS metric, year, v AS value FROM c WHERE d1 IS NULL AND d2 IS NULL UNION ALL SELECT 'returned', year, v FROM c WHERE d1 = 'R' AND d2 IS NULL
UNION ALL SELECT 'open_total', year, v FROM c WHERE d1 IS NULL AND d2 = 'O'""",
)
def exact_shape_series(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    cube = li.groupingSets(
        [["year", "l_returnflag", "l_linestatus"], ["year", "l_returnflag"], ["year", "l_linestatus"], ["year"]], "year", "l_returnflag", "l_linestatus"
    ).agg(F.sum("l_quantity").alias("v"))
    cube = cube.withColumns({"kind": F.lit("sum"), "err": F.lit(None).cast("double")})
    dims, sel = ["l_returnflag", "l_linestatus"], {"kind": "sum"}
    metrics = {
        "all": es.Shape(sel), "returned": es.Shape(sel, {"l_returnflag": "R"}), "open_total": es.Shape(sel, {"l_linestatus": "O"}),
    }
    return es.series(es.label_metrics(cube, dims, metrics), ["metric"], "year", "v", "err").drop("err")


@query(
    "shares_of_total",
    "F14 F17",
    f"""WITH {PARTS_SQL}, l AS (SELECT part, arg_max(value, year) AS v FROM p WHERE part <> 'N' GROUP BY 1), t AS (SELECT sum(value) AS v FROM p WHERE year = (SELECT max(year) FROM p))
SELECT round((SELECT sum(v) FROM l) / (SELECT v FROM t), 9) AS share""",
)
def shares_of_total(spark, sf):
    p = parts_frame(spark, sf)
    parts = es.latest_values(p.where(F.col("part") != "N"), ["part"])
    total = es.latest_values(es.total_over(p, ["year"]).withColumn("k", F.lit(1)), ["k"])
    return rounded(es.shares_check(parts, total), 9)


@query(
    "age_class_scheme",
    "F12 F13",
    """WITH n AS (SELECT DISTINCT CASE WHEN p_size % 3 = 0 THEN p_size || '…' || (p_size + 9) || ' a' WHEN p_size % 3 = 1 THEN '…' || p_size || ' a' ELSE p_size || '… a' END AS label,
  p_size AS s, p_size % 3 AS k FROM part),
t AS (SELECT max(s) FILTER (k = 0) + 9 AS top FROM n)
SELECT label, CAST(CASE WHEN k = 1 THEN 0 ELSE s END AS INTEGER) AS lower FROM n, t WHERE k = 0 OR (k = 1 AND s = 10) OR (k = 2 AND s = top + 1)""",
)
def age_class_scheme(spark, sf):
    s = F.col("p_size")
    text = (
        F.when(s % 3 == 0, F.concat(s.cast("string"), F.lit("…"), (s + 9).cast("string"), F.lit(" a")))
        .when(s % 3 == 1, F.concat(F.lit("…"), s.cast("string"), F.lit(" a")))
        .otherwise(F.concat(s.cast("string"), F.lit("… a")))
    )
    return es.age_class_set(table(spark, sf, "part").withColumn("label", text), "label", 10)


@query(
    "error_summary",
    "F15 D10",
    """WITH r AS (SELECT CASE WHEN l_tax > 0 THEN l_discount + l_tax END AS e FROM lineitem), q AS (SELECT e, row_number() OVER (ORDER BY e) AS rn, count(*) OVER () AS n FROM r WHERE e IS NOT NULL)
SELECT (SELECT count(*) FROM r) AS rows, round((SELECT count(*) FILTER (e IS NULL) / count(*) FROM r), 6) AS null_error_share, round((SELECT count(*) FILTER (e > 0.105) / count(e) FROM r), 6) AS share_over_50pct,
round(max(e) FILTER (rn = round((n - 1) * 0.1) + 1), 6) AS p10, round(max(e) FILTER (rn = round((n - 1) * 0.5) + 1), 6) AS p50, round(max(e) FILTER (rn = round((n - 1) * 0.9) + 1), 6) AS p90,
round(max(e) FILTER (rn = round((n - 1) * 0.99) + 1), 6) AS p99 FROM q""",
)
def error_summary(spark, sf):
    li = table(spark, sf, "lineitem").select(F.when(F.col("l_tax") > 0, F.col("l_discount") + F.col("l_tax")).alias("e"))
    return rounded(es.error_summary(li, "e", 0.105))
