"""Mergeable aggregates, profiles, unit and outlier screening, compositions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import composition as comp
from tidemark.operators import mergeable as mg
from tidemark.operators import profile as pf
from tidemark.operators import screening as sc
from tidemark.functions.columns import keyword_label
from tidemark.plans.queries.registry import DAILY_SQL, daily_events, query, rounded, table

#: amount of a line: discounted price minus a flat handling fee, so that corrections (negatives) occur
FEE = 20000
AMOUNT = f"(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) - {FEE})"


UNITS = 10000  # amounts are held as whole ten-thousandths, so sums are exact on any partitioning


def amounts(spark, sf):
    li = table(spark, sf, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    kept = F.lit(100) - F.round(F.col("l_discount") * 100).cast("bigint")
    return li.select(
        F.year("l_shipdate").alias("year"), F.col("l_returnflag").alias("flow"), F.col("l_suppkey").alias("supplier"),
        (cents * kept - F.lit(FEE * UNITS)).alias("maht"),
    )


def doubles(df):
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in df.dtypes])


FLOW_SQL = f"""
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag AS flow,
       CAST(sum({AMOUNT}) AS DOUBLE) AS total,
       CAST(coalesce(sum(CASE WHEN {AMOUNT} < 0 THEN {AMOUNT} END), 0) AS DOUBLE) AS negative_total,
       CAST(count(*) AS BIGINT) AS rows,
       CAST(sum(CASE WHEN {AMOUNT} < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_rows
FROM lineitem GROUP BY 1, 2"""


@query("flow_totals", "A01 A02 T02 T03", FLOW_SQL)
def flow_totals(spark, sf):
    partial = mg.partial_sums(amounts(spark, sf), ["year", "flow", "supplier"], "maht")
    out = comp.flow_totals(partial, ["year", "flow"])
    return out.withColumns({c: (F.col(c) / UNITS).alias(c) for c in ("total", "negative_total")})


@query(
    "partial_merge_equals_direct",
    "A01 A02 A03 A04",
    """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag AS flow, count(*) AS rows, count(l_quantity) AS n_value,
       sum(l_quantity) AS v_sum, min(l_quantity) AS v_min, max(l_quantity) AS v_max,
       count(*) FILTER (l_quantity < 0) AS n_negative
FROM lineitem GROUP BY 1, 2""",
)
def partial_merge(spark, sf):
    li = table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("year"), F.col("l_returnflag").alias("flow"), F.col("l_quantity").alias("v")
    )
    y = F.col("year")
    spans = [y <= 1996, (y > 1996) & (y <= 1999), y > 1999]  # three stored parts that together hold every row
    parts = [mg.partial_range(li.where(span), ["year", "flow"], "v") for span in spans]
    return mg.merge_range(parts, ["year", "flow"])


@query(
    "daily_from_events",
    "A05 H02",
    """
SELECT user_id, event_type AS series, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, round(avg(value), 6) AS value,
       CAST(count(*) AS INTEGER) AS n_hours
FROM events GROUP BY 1, 2, 3""",
)
def daily_from_events(spark, sf):
    ev = table(spark, sf, "events").withColumn("series", F.concat("event_type", F.lit(" avg")))
    d = mg.daily(ev, "user_id", "series", "ts", "value")
    return rounded(d.withColumns({"series": F.regexp_replace("series", " avg$", ""), "date": F.col("date").cast("string")}))


@query(
    "series_summary",
    "A06",
    f"""
WITH {DAILY_SQL}, r AS (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value) AS rn,
         count(*) OVER (PARTITION BY event_type) AS n FROM d)
SELECT event_type, count(*) AS days, CAST(min(date) AS VARCHAR) AS first, CAST(max(date) AS VARCHAR) AS last,
       count(*) FILTER (n_hours = 2) AS full_days,
       min(value) AS q00, max(value) AS q100, count(*) FILTER (value < 0) AS n_negative,
       count(*) FILTER (value = 0) AS n_zero,
       max(CASE WHEN rn = round((n - 1) * 0.05) + 1 THEN value END) AS q05,
       round(quantile_cont(value, 0.5), 6) AS q50,
       max(CASE WHEN rn = round((n - 1) * 0.95) + 1 THEN value END) AS q95
FROM r GROUP BY 1""",
)
def series_summary(spark, sf):
    out = mg.summarise_series(daily_events(spark, sf), ["event_type"], full=2)
    return rounded(out.withColumns({c: F.col(c).cast("string") for c in ("first", "last")}))


@query(
    "reconcile_years",
    "S03 S16 S17 D07",
    """
WITH e AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS rows_expected FROM orders GROUP BY 1),
     r AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS rows_read FROM lineitem GROUP BY 1),
     w AS (SELECT CAST(x AS INTEGER) AS year FROM range(1993, 2003) t(x)),
     j AS (SELECT coalesce(e.year, r.year) AS year, rows_expected, rows_read FROM e FULL JOIN r ON e.year = r.year)
SELECT coalesce(w.year, j.year) AS year, CAST(rows_expected AS DOUBLE) AS rows_expected, CAST(rows_read AS DOUBLE) AS rows_read,
       CASE WHEN rows_read IS NULL THEN 'missing' WHEN rows_expected IS NULL THEN 'unexpected'
            WHEN rows_read <> rows_expected THEN 'mismatch' ELSE 'ok' END AS status
FROM w FULL JOIN j ON w.year = j.year""",
)
def reconcile_years(spark, sf):
    orders = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("rows_expected"))
    read = table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year")).agg(F.count(F.lit(1)).alias("rows_read"))
    wanted = mg.expected_years(spark, 1993, 2002)
    out = mg.reconcile(read, wanted.join(orders, "year", "full"))
    return out.withColumns({c: F.col(c).cast("double") for c in ("rows_expected", "rows_read")})


@query(
    "table_profile",
    "D01 D02 D03 D14 D20",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, round(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) / count(*), 6) AS null_share,
  count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS "distinct",
  {'CAST(min(' + c + ') AS DOUBLE)' if num else 'CAST(NULL AS DOUBLE)'} AS v_min, {'CAST(max(' + c + ') AS DOUBLE)' if num else 'CAST(NULL AS DOUBLE)'} AS v_max,
  {'min(' + c + ')' if not num else 'CAST(NULL AS VARCHAR)'} AS text_min, {'max(' + c + ')' if not num else 'CAST(NULL AS VARCHAR)'} AS text_max FROM customer"""
        for c, num in (("c_custkey", True), ("c_name", False), ("c_nationkey", True), ("c_acctbal", True), ("c_mktsegment", False))
    ),
)
def table_profile(spark, sf):
    return rounded(pf.describe(table(spark, sf, "customer")))


@query(
    "top_values",
    "D01 D03 D04 D16",
    """
WITH c AS (SELECT 'l_returnflag' AS "column", l_returnflag AS value, count(*) AS rows FROM lineitem GROUP BY 2
           UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY 2
           UNION ALL SELECT 'l_linenumber', CAST(l_linenumber AS VARCHAR), count(*) FROM lineitem GROUP BY 2),
r AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY rows DESC, value) AS rn FROM c)
SELECT "column", value, rows FROM r WHERE rn <= 8""",
)
def top_values(spark, sf):
    return pf.top_values(table(spark, sf, "lineitem"), columns=["l_returnflag", "l_linestatus", "l_linenumber", "l_orderkey"], max_distinct=40, top=8)


@query(
    "value_counts_top",
    "D04 D05",
    """
SELECT o_orderstatus, o_orderpriority, count(*) AS rows FROM orders GROUP BY 1, 2
ORDER BY rows DESC, 1, 2 LIMIT 10""",
)
def value_counts_top(spark, sf):
    return pf.counts(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], 10)


@query(
    "duplicate_keys",
    "D05 D06 D12 D17",
    """
WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT l_quantity) AS k FROM lineitem GROUP BY 1, 2)
SELECT count(*) AS key_groups, count(*) FILTER (n > 1) AS groups_with_multiple_rows,
       count(*) FILTER (k > 1) AS groups_with_different_values FROM g""",
)
def duplicate_keys(spark, sf):
    return pf.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_quantity")


@query(
    "repeated_key_differences",
    "D11 D12",
    """
WITH f AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_linenumber, l_partkey, l_quantity) AS rn FROM lineitem),
g AS (SELECT l_orderkey, l_suppkey, count(*) AS n, count(DISTINCT l_quantity) AS amounts, count(DISTINCT l_returnflag) AS flags,
      count(DISTINCT l_partkey) AS parts, sum(l_quantity) AS total, max(CASE WHEN rn = 1 THEN l_quantity END) AS first
      FROM f GROUP BY 1, 2)
SELECT count(*) FILTER (n > 1) AS groups_n_gt_1, count(*) FILTER (n > 1 AND amounts = 1) AS identical_amounts,
       count(*) FILTER (n > 1 AND flags > 1) AS differing_flag, count(*) FILTER (n > 1 AND parts > 1) AS differing_part,
       coalesce(sum(total - first) FILTER (n > 1), 0) AS excess_if_first_row_only,
       round(coalesce(sum(total - first) FILTER (n > 1), 0) / sum(total), 6) AS share_of_all
FROM g""",
)
def repeated_key_differences(spark, sf):
    return rounded(
        pf.repeated_key_differences(
            table(spark, sf, "lineitem"), ["l_orderkey", "l_suppkey"], "l_quantity",
            {"differing_flag": "l_returnflag", "differing_part": "l_partkey"}, ["l_linenumber", "l_partkey"],
        )
    )


@query(
    "rows_per_key",
    "D05",
    """
WITH g AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) SELECT n, count(*) AS keys FROM g GROUP BY 1""",
)
def rows_per_key(spark, sf):
    return pf.rows_per_key(table(spark, sf, "orders"), ["o_custkey"])


@query(
    "join_coverage",
    "D05",
    """
SELECT count(DISTINCT l.l_orderkey) AS keys, count(DISTINCT o.o_orderkey) AS found_in_register
FROM lineitem l LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') o ON l.l_orderkey = o.o_orderkey""",
)
def join_coverage(spark, sf):
    reg = table(spark, sf, "orders").where(F.col("o_orderstatus") == "F")
    return pf.join_coverage(table(spark, sf, "lineitem"), "l_orderkey", reg, "o_orderkey")


@query(
    "shape_counts",
    "D09 D10 F01",
    """
WITH c AS (SELECT o.o_orderkey, CAST(year(o.o_orderdate) AS INTEGER) AS year, nullif(o_orderstatus, 'P') AS status,
           CASE WHEN l.l_quantity > 25 THEN l_returnflag END AS flag, l.l_linenumber AS line
           FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey)
SELECT concat_ws('+', CASE WHEN status IS NOT NULL THEN 'status' END, CASE WHEN flag IS NOT NULL THEN 'flag' END,
                 CASE WHEN line IS NOT NULL THEN 'line' END) AS shape,
       count(*) AS rows, min(year) AS first_year, max(year) AS last_year,
       count(DISTINCT status) AS n_status, count(DISTINCT flag) AS n_flag, count(DISTINCT line) AS n_line
FROM c GROUP BY 1""",
)
def shape_counts(spark, sf):
    o = table(spark, sf, "orders")
    li = table(spark, sf, "lineitem")
    cube = o.join(li, o.o_orderkey == li.l_orderkey, "left").select(
        F.year("o_orderdate").alias("year"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("l_quantity") > 25, F.col("l_returnflag")).alias("flag"),
        F.col("l_linenumber").alias("line"),
    )
    return pf.table_shapes(cube, ["status", "flag", "line"], year="year")


@query(
    "filter_trace",
    "D15",
    """
SELECT 1 AS step_no, 'year 1996' AS step, count(*) FILTER (year(o_orderdate) = 1996) AS rows FROM orders
UNION ALL SELECT 2, 'status F', count(*) FILTER (year(o_orderdate) = 1996 AND o_orderstatus = 'F') FROM orders
UNION ALL SELECT 3, 'urgent', count(*) FILTER (year(o_orderdate) = 1996 AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') FROM orders
UNION ALL SELECT 4, 'above 100000', count(*) FILTER (year(o_orderdate) = 1996 AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' AND o_totalprice > 100000) FROM orders""",
)
def filter_trace(spark, sf):
    return pf.filter_trace(
        table(spark, sf, "orders"),
        [
            ("year 1996", F.year("o_orderdate") == 1996),
            ("status F", F.col("o_orderstatus") == "F"),
            ("urgent", F.col("o_orderpriority") == "1-URGENT"),
            ("above 100000", F.col("o_totalprice") > 100000),
        ],
    )


@query(
    "additivity_check",
    "D13",
    """
WITH g AS (SELECT l_orderkey, count(*) AS n, max(l_quantity) AS mq, min(l_quantity) = max(l_quantity) AS cq,
           max(l_tax) AS mt, min(l_tax) = max(l_tax) AS ct FROM lineitem GROUP BY 1)
SELECT count(*) AS keys, count(*) FILTER (n > 1) AS multi_row_keys,
       count(*) FILTER (n > 1 AND cq) AS constant_l_quantity, count(*) FILTER (n > 1 AND mq > 0) AS nonzero_l_quantity,
       count(*) FILTER (n > 1 AND mq > 0 AND cq) AS nonzero_constant_l_quantity,
       count(*) FILTER (n > 1 AND ct) AS constant_l_tax, count(*) FILTER (n > 1 AND mt > 0) AS nonzero_l_tax,
       count(*) FILTER (n > 1 AND mt > 0 AND ct) AS nonzero_constant_l_tax
FROM g""",
)
def additivity_check(spark, sf):
    return pf.additivity(table(spark, sf, "lineitem"), "l_orderkey", ["l_quantity", "l_tax"])


@query(
    "report_level_totals",
    "D13",
    """
WITH p AS (SELECT l_orderkey, l_returnflag, max(l_quantity) AS q FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, sum(q) AS l_quantity, count(*) AS keys FROM p GROUP BY 1""",
)
def report_level_totals(spark, sf):
    return pf.per_key_totals(table(spark, sf, "lineitem"), "l_orderkey", "l_returnflag", ["l_quantity"])


@query(
    "predicate_counts",
    "D21 S04",
    """
SELECT 'returned' AS predicate, count(*) FILTER (l_returnflag = 'R') AS rows FROM lineitem
UNION ALL SELECT 'before 1995', count(*) FILTER (l_shipdate < DATE '1995-01-01') FROM lineitem
UNION ALL SELECT '1996', count(*) FILTER (l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '1997-01-01') FROM lineitem
UNION ALL SELECT 'large', count(*) FILTER (l_quantity > 45) FROM lineitem""",
)
def predicate_counts(spark, sf):
    from tidemark.functions.columns import year_bucket

    return pf.predicate_counts(
        table(spark, sf, "lineitem"),
        {
            "returned": F.col("l_returnflag") == "R",
            "before 1995": year_bucket("l_shipdate", 0),
            "1996": year_bucket("l_shipdate", 1996),
            "large": F.col("l_quantity") > 45,
        },
    )


@query(
    "catalog_by_indicator",
    "M01 M02 M04",
    """
WITH e AS (SELECT event_type, CAST(month(ts) AS INTEGER) AS year, user_id, value, CAST(floor(value / 10) * 10 AS BIGINT) AS unit FROM events)
SELECT event_type, count(*) AS rows, min(year) AS first_year, max(year) AS last_year, count(DISTINCT user_id) AS species,
       min(value) AS v_min, max(value) AS v_max,
       array_to_string(list_sort(list(DISTINCT CASE WHEN unit < 50 THEN CAST(unit AS VARCHAR) END)), ',') AS units
FROM e GROUP BY 1""",
)
def catalog_by_indicator(spark, sf):
    from tidemark.plans.monitoring import by_indicator

    unit = (F.floor(F.col("value") / 10) * 10).cast("bigint")
    ev = table(spark, sf, "events").select(
        "event_type", F.month("ts").alias("year"), "user_id", "value", F.when(unit < 50, unit.cast("string")).alias("unit")
    )
    parts = mg.partial_range(ev, ["event_type", "year", "user_id", "unit"], "value")
    cat = by_indicator(parts, ["event_type"], unit="unit", species="user_id", top=None)
    return cat.select(
        "event_type", "rows", "first_year", "last_year", "species", "v_min", "v_max", F.array_join("units", ",").alias("units")
    )


@query(
    "grouped_rows_by_year",
    "M03 M05 M06",
    """
SELECT event_type, CAST(day(ts) AS INTEGER) AS day, count(*) AS rows, grouping(event_type) AS all_types
FROM events GROUP BY GROUPING SETS ((event_type, day(ts)), (day(ts)))""",
)
def grouped_rows_by_year(spark, sf):
    from tidemark.plans.monitoring import rows_by_group_and_year

    ev = table(spark, sf, "events").select("event_type", F.dayofmonth("ts").alias("day"))
    parts = ev.groupBy("event_type", "day").agg(F.count(F.lit(1)).alias("rows"))
    out = rows_by_group_and_year(parts, "event_type", "day")
    return out.select("event_type", "day", "rows", F.col("all_groups").cast("bigint").alias("all_types"))


@query(
    "group_coverage",
    "M07",
    """
WITH p AS (SELECT CASE WHEN event_type <> 'error' THEN event_type END AS g, CAST(day(ts) AS INTEGER) AS y, count(*) AS r FROM events GROUP BY 1, 2)
SELECT coalesce(g, 'unknown') AS name, CAST(sum(r) AS BIGINT) AS rows, min(y) AS first_year, max(y) AS last_year,
       count(DISTINCT y) AS years FROM p GROUP BY 1""",
)
def group_coverage(spark, sf):
    from tidemark.plans.monitoring import group_coverage as coverage

    ev = table(spark, sf, "events").select(
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("g"), F.dayofmonth("ts").alias("year")
    )
    parts = ev.groupBy("g", "year").agg(F.count(F.lit(1)).alias("rows"))
    return coverage(parts, "g")


@query(
    "screen_spikes",
    "H01 H02",
    f"""
WITH {DAILY_SQL}, r AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value) AS rn,
         count(*) OVER (PARTITION BY user_id, event_type) AS n FROM d WHERE event_type IN ('click', 'view') AND value >= 0.5),
q AS (SELECT user_id, event_type, max(CASE WHEN rn = round((n - 1) * 0.95) + 1 THEN value END) AS q95 FROM r GROUP BY 1, 2),
f AS (SELECT d.user_id, d.event_type, d.event_type IN ('click', 'view') AND d.value < 0.5 AS neg,
      coalesce(d.event_type IN ('click', 'view') AND d.value - 0.5 > 1.5 * (q95 - 0.5) AND q95 - 0.5 > 0, false) AS spk,
      d.event_type NOT IN ('click', 'view') AND (d.value - 0.5 < 2.0 OR d.value - 0.5 > 30.0) AS oor
      FROM d LEFT JOIN q ON d.user_id = q.user_id AND d.event_type = q.event_type)
SELECT user_id, event_type, count(*) FILTER (neg) AS negative, count(*) FILTER (spk) AS spike,
       count(*) FILTER (oor) AS out_of_range, count(*) AS n
FROM f GROUP BY 1, 2 HAVING count(*) FILTER (neg) + count(*) FILTER (spk) + count(*) FILTER (oor) > 0""",
)
def screen_spikes(spark, sf):
    d = daily_events(spark, sf).withColumn("value", F.col("value") - 0.5)
    flow = F.col("event_type").isin("click", "view")
    _, report = sc.screen_series(d, ["user_id", "event_type"], "value", flow, spike_factor=1.5, valid_range=(2.0, 30.0))
    return report


@query(
    "unit_screening",
    "Q03 E01 N20 W03 W05",
    """
WITH u AS (SELECT event_type, value, CASE WHEN event_type = 'view' THEN 'kg' WHEN event_type = 'click' THEN 't'
           WHEN event_type = 'purchase' THEN 'mg' ELSE 'pcs' END AS unit FROM events)
SELECT unit, count(*) AS rows_read, count(*) FILTER (unit IN ('kg', 't', 'mg')) AS rows_used,
       count(*) FILTER (unit NOT IN ('kg', 't', 'mg')) AS rows_unknown_unit,
       round(CASE unit WHEN 'kg' THEN max(value * 0.001) WHEN 't' THEN max(value * 1.0) WHEN 'mg' THEN max(value * 0.000001) END, 9) AS max_amount
FROM u GROUP BY 1""",
)
def unit_screening(spark, sf):
    kind = F.col("event_type")
    unit = F.when(kind == "view", "kg").when(kind == "click", "t").when(kind == "purchase", "mg").otherwise("pcs")
    ev = table(spark, sf, "events").withColumn("unit", unit)
    used, dropped = sc.convert_units(ev, "value", "unit", {"t": 1.0, "kg": 0.001, "mg": 0.000001})
    a = used.groupBy("unit").agg(F.count(F.lit(1)).alias("rows_used"), F.max("amount").alias("max_amount"))
    out = a.join(dropped, "unit", "full").na.fill(0, ["rows_used", "rows_unknown_unit"])
    out = out.withColumn("rows_read", F.col("rows_used") + F.col("rows_unknown_unit"))
    return rounded(out, 9)


@query(
    "ratio_outliers",
    "E09",
    """
WITH d AS (SELECT p_type, p_brand, l_quantity AS heat, CASE WHEN l_linenumber > 1 THEN l_linenumber - 1.0 ELSE 0.0 END AS fuel,
           CASE WHEN l_linenumber > 1 THEN l_quantity / (l_linenumber - 1.0) END AS ratio
           FROM lineitem JOIN part ON l_partkey = p_partkey),
m AS (SELECT p_type, quantile_cont(ratio, 0.5) AS med FROM d WHERE heat > 0 AND ratio IS NOT NULL GROUP BY 1)
SELECT d.p_type, count(*) AS rows, count(*) FILTER (heat > 0 AND NOT fuel > 0) AS no_base,
       count(*) FILTER (heat > 0 AND (ratio > 3.0 * med OR ratio < 0.2 * med)) AS off_ratio,
       round(max(med), 6) AS med_ratio
FROM d JOIN m ON d.p_type = m.p_type GROUP BY 1""",
)
def ratio_outliers(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    d = li.join(p, li.l_partkey == p.p_partkey).select(
        "p_type", F.col("l_quantity").alias("heat"), (F.greatest(F.col("l_linenumber") - 1, F.lit(0)) * 1.0).cast("double").alias("fuel")
    )
    marked, _ = sc.ratio_outliers(d, ["p_type"], "heat", "fuel", 0.2, 3.0)
    return rounded(
        marked.groupBy("p_type").agg(
            F.count(F.lit(1)).alias("rows"), F.count_if("no_base").alias("no_base"), F.count_if("off_ratio").alias("off_ratio"),
            F.max("med_ratio").alias("med_ratio"),
        )
    )


@query(
    "top_types",
    "T06",
    """
SELECT p_type, p_brand, sum(l_quantity) AS total FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_returnflag = 'R' AND year(l_shipdate) = 1998 GROUP BY 1, 2 ORDER BY total DESC, 1, 2 LIMIT 12""",
)
def top_types(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    rows = li.where((F.col("l_returnflag") == "R") & (F.year("l_shipdate") == 1998))
    per = rows.groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    return comp.top_types(per.join(p, per.l_partkey == p.p_partkey), ["p_type", "p_brand"], "q", 12)


@query(
    "top_partners_series",
    "T07",
    """
WITH s AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, sum(l_quantity) AS total FROM lineitem
           WHERE l_returnflag = 'A' GROUP BY 1, 2),
t AS (SELECT l_suppkey FROM s GROUP BY 1 ORDER BY sum(total) DESC, l_suppkey LIMIT 10)
SELECT s.* FROM s JOIN t ON s.l_suppkey = t.l_suppkey""",
)
def top_partners_series(spark, sf):
    li = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "A")
    return comp.top_member_series(li.withColumn("year", F.year("l_shipdate")), ["year"], "l_suppkey", "l_quantity", 10)


@query(
    "hazardous_share",
    "T05 T04",
    """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, sum(l_quantity) AS total,
       coalesce(sum(l_quantity) FILTER (l_linestatus = 'F'), 0) AS flagged,
       round(coalesce(sum(l_quantity) FILTER (l_linestatus = 'F'), 0) / sum(l_quantity), 6) AS share
FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1""",
)
def hazardous_share(spark, sf):
    li = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").withColumn("year", F.year("l_shipdate"))
    return rounded(comp.flagged_share(li, ["year"], "l_quantity", F.col("l_linestatus") == "F"))


@query(
    "stock_continuity",
    "T08",
    """
WITH p AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(sum(CASE WHEN o_orderstatus = 'O' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS opening,
           CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS closing
           FROM orders GROUP BY 1)
SELECT a.year, a.closing, b.opening AS next_opening, round(b.opening / nullif(a.closing, 0), 6) AS ratio
FROM p a JOIN p b ON b.year = a.year + 1 WHERE a.closing IS NOT NULL AND b.opening IS NOT NULL""",
)
def stock_continuity(spark, sf):
    o = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"), "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("v")
    )
    out = comp.stock_continuity(o, "year", "v", F.col("o_orderstatus") == "O", F.col("o_orderstatus") == "F")
    return rounded(doubles(out))


@query(
    "longest_name",
    "T09",
    """
WITH r AS (SELECT p_brand, p_name, row_number() OVER (PARTITION BY p_brand ORDER BY length(p_name) DESC, p_name DESC) AS rn
           FROM (SELECT DISTINCT p_brand, p_name FROM part))
SELECT p_brand, p_name FROM r WHERE rn = 1""",
)
def longest_name(spark, sf):
    return comp.longest_name(table(spark, sf, "part"), "p_brand", "p_name")


STREAMS_SQL = {
    "returned": "l_returnflag = 'R'",
    "large": "l_quantity > 40",
    "economy": "p_type = 'ECONOMY'",
    "brand1": "starts_with(p_brand, 'Brand#1')",
}


def stream_rows(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    rows = li.join(p, li.l_partkey == p.p_partkey).withColumn("year", F.year("l_shipdate"))
    preds = {
        "returned": F.col("l_returnflag") == "R",
        "large": F.col("l_quantity") > 40,
        "economy": F.col("p_type") == "ECONOMY",
        "brand1": F.col("p_brand").startswith("Brand#1"),
    }
    return rows, preds


@query(
    "overlapping_streams",
    "T10",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS stream, l_linestatus, CAST(year(l_shipdate) AS INTEGER) AS year, sum(l_quantity) AS total
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE {p} GROUP BY 2, 3"""
        for n, p in STREAMS_SQL.items()
    ),
)
def overlapping_streams(spark, sf):
    rows, preds = stream_rows(spark, sf)
    return comp.stream_flows(rows, preds, ["l_linestatus", "year"], {"total": "l_quantity"})


@query(
    "stream_top_types",
    "T10",
    "WITH s AS ("
    + " UNION ALL ".join(
        f"SELECT '{n}' AS stream, p_brand, sum(l_quantity) AS total FROM lineitem JOIN part ON l_partkey = p_partkey WHERE {p} GROUP BY 2"
        for n, p in STREAMS_SQL.items()
    )
    + """), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY stream ORDER BY total DESC, p_brand) AS INTEGER) AS rank FROM s)
SELECT * FROM r WHERE rank <= 8""",
)
def stream_top_types(spark, sf):
    rows, preds = stream_rows(spark, sf)
    return comp.stream_top(rows, preds, ["p_brand"], "l_quantity", 8)


@query(
    "top_n_fold",
    "E04 J01",
    """
WITH s AS (SELECT p_brand, CAST(year(l_shipdate) AS INTEGER) AS year, sum(l_quantity) AS total
           FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
t AS (SELECT p_brand FROM s GROUP BY 1 ORDER BY sum(total) DESC, p_brand LIMIT 8)
SELECT year, CASE WHEN p_brand IN (SELECT p_brand FROM t) THEN p_brand ELSE 'other' END AS p_brand, sum(total) AS total
FROM s GROUP BY 1, 2""",
)
def top_n_fold(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part").select("p_partkey", "p_brand")
    per = li.groupBy("l_partkey", F.year("l_shipdate").alias("year")).agg(F.sum("l_quantity").alias("q"))
    return comp.fold_rest(per.join(p, per.l_partkey == p.p_partkey), ["year"], "p_brand", "q", 8)


@query(
    "concentration_shares",
    "E07",
    """
WITH p AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v FROM orders GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY v DESC, o_custkey) AS rn FROM p)
SELECT year, count(*) AS reports, CAST(sum(v) AS DOUBLE) AS total,
       round(CAST(sum(v) FILTER (rn <= 1) AS DOUBLE) / CAST(sum(v) AS DOUBLE), 6) AS top1_share,
       round(CAST(sum(v) FILTER (rn <= 5) AS DOUBLE) / CAST(sum(v) AS DOUBLE), 6) AS top5_share,
       round(CAST(sum(v) FILTER (rn <= 10) AS DOUBLE) / CAST(sum(v) AS DOUBLE), 6) AS top10_share
FROM r GROUP BY 1""",
)
def concentration_shares(spark, sf):
    o = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"), "o_custkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("v")
    )
    out = comp.concentration(o, ["year"], "o_custkey", "v")
    return rounded(out.withColumn("total", F.col("total") / 100))


@query(
    "dedup_gap",
    "E03",
    """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_linenumber, l_partkey, l_returnflag, l_quantity) AS rn FROM lineitem),
a AS (SELECT l_returnflag, sum(l_quantity) AS all_total, sum(l_quantity) FILTER (rn = 1) AS first_total FROM r GROUP BY 1)
SELECT l_returnflag, all_total, first_total, round((all_total - first_total) / all_total, 6) AS gap_share FROM a""",
)
def dedup_gap(spark, sf):
    return rounded(
        comp.dedup_gap(
            table(spark, sf, "lineitem"), ["l_orderkey", "l_suppkey"], ["l_returnflag"], "l_quantity", ["l_linenumber", "l_partkey"]
        )
    )


@query(
    "yearly_totals",
    "E02 E05 E06 E10",
    """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, coalesce(nullif(o_orderpriority, '4-NOT SPECIFIED'), 'unknown') AS grp,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, count(DISTINCT o_custkey) AS reports, count(*) AS rows
FROM orders GROUP BY 1, 2""",
)
def yearly_totals(spark, sf):
    o = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"), "o_custkey",
        F.coalesce(F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")), F.lit("unknown")).alias("grp"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("v"),
    )
    return doubles(comp.group_totals(o, ["year", "grp"], "v", distinct="o_custkey"))


@query(
    "keyword_groups",
    "E08",
    """
SELECT CASE WHEN contains(lower(p_name), 'ring') OR contains(lower(p_name), 'bolt') THEN 'metal'
            WHEN contains(lower(p_name), 'widget') THEN 'widget'
            WHEN contains(lower(p_name), 'red') OR contains(lower(p_name), 'blue') THEN 'coloured' ELSE 'other' END AS grp,
       count(*) AS n, sum(p_retailprice * 10) / 10 AS price
FROM part GROUP BY 1""",
)
def keyword_groups(spark, sf):
    rules = [("metal", ("ring", "bolt")), ("widget", ("widget",)), ("coloured", ("red", "blue"))]
    p = table(spark, sf, "part").withColumn("grp", keyword_label("p_name", rules, "other"))
    return p.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), (F.sum(F.col("p_retailprice") * 10) / 10).alias("price"))


@query(
    "running_totals",
    "K09",
    """
WITH p AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus, count(*) AS n,
           sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total FROM orders GROUP BY 1, 2)
SELECT o_orderstatus, year, n, CAST(total AS DOUBLE) AS total,
       CAST(sum(n) OVER w AS BIGINT) AS cum_n, CAST(sum(total) OVER w AS DOUBLE) AS cum_total
FROM p WINDOW w AS (PARTITION BY o_orderstatus ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def running_totals(spark, sf):
    o = table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("year"), "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("v")
    )
    return doubles(comp.running_totals(o, "year", "v", ["o_orderstatus"]))


@query(
    "wide_to_long_months",
    "U03 U04",
    "WITH s AS (SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS year, month(l_shipdate) AS mo, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2, 3),"
    " y AS (SELECT DISTINCT l_returnflag, year FROM s)"
    " SELECT y.l_returnflag, y.year, 'm' || k AS month, coalesce(q, 0) AS value FROM y CROSS JOIN range(1, 13) t(k)"
    " LEFT JOIN s ON s.l_returnflag = y.l_returnflag AND s.year = y.year AND s.mo = k",
)
def wide_to_long_months(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("mo"), "l_quantity")
    months = [f"m{i}" for i in range(1, 13)]
    wide = li.select("l_returnflag", "year", *[F.when(F.col("mo") == i + 1, F.col("l_quantity")).alias(m) for i, m in enumerate(months)])
    return comp.wide_to_long(wide, ["l_returnflag", "year"], months, "month", "value")


@query(
    "quarter_limit_exceedance",
    "U05",
    """
WITH w AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_suppkey,
  max(l_quantity) FILTER (quarter(l_shipdate) = 1) AS q1, max(l_quantity) FILTER (quarter(l_shipdate) = 2) AS q2,
  max(l_quantity) FILTER (quarter(l_shipdate) = 3) AS q3, max(l_quantity) FILTER (quarter(l_shipdate) = 4) AS q4,
  max(l_tax) FILTER (quarter(l_shipdate) = 1) AS t1, max(l_tax) FILTER (quarter(l_shipdate) = 2) AS t2,
  max(l_tax) FILTER (quarter(l_shipdate) = 3) AS t3, max(l_tax) FILTER (quarter(l_shipdate) = 4) AS t4,
  CASE WHEN min(l_quantity) <= 2 THEN 49.0 END AS qlim, CASE WHEN min(l_quantity) <= 2 THEN 0.07 END AS tlim
  FROM lineitem GROUP BY 1, 2)
SELECT 'quantity' AS substance, year, count(*) AS with_limit, count(*) FILTER (greatest(q1, q2, q3, q4) > qlim) AS over_limit FROM w WHERE qlim > 0 GROUP BY 2
UNION ALL SELECT 'tax', year, count(*), count(*) FILTER (greatest(t1, t2, t3, t4) > tlim) FROM w WHERE tlim > 0 GROUP BY 2""",
)
def quarter_limit_exceedance(spark, sf):
    li = table(spark, sf, "lineitem").withColumns({"year": F.year("l_shipdate"), "q": F.quarter("l_shipdate")})
    wide = li.groupBy("year", "l_suppkey").agg(
        *[F.max(F.when(F.col("q") == i, F.col("l_quantity"))).alias(f"q{i}") for i in range(1, 5)],
        *[F.max(F.when(F.col("q") == i, F.col("l_tax"))).alias(f"t{i}") for i in range(1, 5)],
        F.when(F.min("l_quantity") <= 2, 49.0).alias("qlim"), F.when(F.min("l_quantity") <= 2, 0.07).alias("tlim"),
    )
    checks = {"quantity": ("qlim", ["q1", "q2", "q3", "q4"]), "tax": ("tlim", ["t1", "t2", "t3", "t4"])}
    return comp.limit_exceedance(wide, ["year"], checks)


@query(
    "tiling_check",
    "D18 F14",
    """
WITH w AS (SELECT l_orderkey, sum(l_quantity) AS total, coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0) AS r,
           coalesce(sum(l_quantity) FILTER (l_returnflag = 'A'), 0) AS a FROM lineitem GROUP BY 1)
SELECT count(*) AS rows, count(*) FILTER (abs(r + a - total) / total <= 0.01) AS within_tolerance,
       round(count(*) FILTER (abs(r + a - total) / total <= 0.01) / count(*), 6) AS share FROM w WHERE total > 0""",
)
def tiling_check(spark, sf):
    w = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("total"),
        F.sum(F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))).alias("r"),
        F.sum(F.when(F.col("l_returnflag") == "A", F.col("l_quantity"))).alias("a"),
    )
    return rounded(pf.tiling(w, "total", ["r", "a"]))


@query(
    "use_by_type",
    "U01 U02",
    """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, coalesce(nullif(l_returnflag, 'N'), 'unknown') AS kind, sum(l_quantity) AS total,
       count(DISTINCT l_orderkey) AS reports, count(*) AS rows
FROM lineitem GROUP BY 1, 2""",
)
def use_by_type(spark, sf):
    li = table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("year"), F.coalesce(F.nullif("l_returnflag", F.lit("N")), F.lit("unknown")).alias("kind"),
        "l_quantity", "l_orderkey",
    )
    return comp.group_totals(li, ["year", "kind"], "l_quantity", distinct="l_orderkey")


@query(
    "abstraction_vs_use",
    "U08",
    """
WITH u AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS left_total FROM orders GROUP BY 1),
a AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, sum(l_quantity) AS right_total FROM lineitem GROUP BY 1)
SELECT u.year, left_total, CAST(coalesce(right_total, 0) AS DOUBLE) AS right_total,
       round(coalesce(right_total, 0) / left_total, 9) AS ratio FROM u LEFT JOIN a ON u.year = a.year""",
)
def abstraction_vs_use(spark, sf):
    o = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), F.round("o_totalprice").cast("bigint").alias("u"))
    li = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year"), "l_quantity")
    return rounded(comp.ratio_of_totals(o, li, "year", "u", "l_quantity"), 9)


@query(
    "status_summary",
    "I17 U06",
    """
SELECT c_mktsegment AS segment, count(*) AS n, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) AS BIGINT) AS weight,
       count(*) FILTER (o_orderstatus = 'F') AS n_F, count(*) FILTER (o_orderstatus = 'O') AS n_O, count(*) FILTER (o_orderstatus = 'P') AS n_P,
       CAST(coalesce(sum(CAST(round(o_totalprice) AS BIGINT)) FILTER (o_orderstatus = 'F'), 0) AS BIGINT) AS weight_F,
       CAST(coalesce(sum(CAST(round(o_totalprice) AS BIGINT)) FILTER (o_orderstatus = 'O'), 0) AS BIGINT) AS weight_O,
       CAST(coalesce(sum(CAST(round(o_totalprice) AS BIGINT)) FILTER (o_orderstatus = 'P'), 0) AS BIGINT) AS weight_P,
       round(coalesce(sum(CAST(round(o_totalprice) AS BIGINT)) FILTER (o_orderstatus = 'P'), 0) / sum(CAST(round(o_totalprice) AS BIGINT)), 6) AS share_uncovered
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ROLLUP (c_mktsegment)""",
)
def status_summary(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    rows = o.select("o_custkey", "o_orderstatus", F.round("o_totalprice").cast("bigint").alias("w"))
    j = rows.join(c, rows.o_custkey == c.c_custkey).select(F.col("c_mktsegment").alias("segment"), "o_orderstatus", "w")
    return rounded(comp.status_summary(j, "segment", "o_orderstatus", "w", ["F", "O", "P"], "P"))


@query(
    "extreme_rows",
    "J07 J08",
    """
WITH y AS (SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n, count(*) FILTER (l_quantity > 45) AS over FROM lineitem GROUP BY 1, 2),
s AS (SELECT *, 100.0 * over / n AS pct FROM y)
SELECT l_returnflag, arg_max(year, (pct, -year)) AS highest_year, round(max(pct), 6) AS highest_pct,
       arg_min(year, (pct, year)) AS lowest_year, round(min(pct), 6) AS lowest_pct
FROM s GROUP BY 1""",
)
def extreme_rows(spark, sf):
    y = table(spark, sf, "lineitem").groupBy("l_returnflag", F.year("l_shipdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_quantity") > 45).alias("over")
    )
    s = comp.class_percentages(y, ["over"], "n")
    e = comp.extreme_rows(s, ["l_returnflag"], "pct_over", ["year", "pct_over"], "year")
    return rounded(
        e.select(
            "l_returnflag", F.col("highest.year").alias("highest_year"), F.col("highest.pct_over").alias("highest_pct"),
            F.col("lowest.year").alias("lowest_year"), F.col("lowest.pct_over").alias("lowest_pct"),
        )
    )
