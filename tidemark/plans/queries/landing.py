"""Sources and sinks at work: declared reads, guards, parts, cubes in JSON-stat, samples, streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import climatology as cl
from tidemark.operators import mergeable as mg
from tidemark.operators import profile as pf
from tidemark.plans import climate
from tidemark.plans.queries.registry import MONTHLY_SQL, lines_by_month, query, rounded, table
from tidemark.sources import jsonstat, landed, sinks
from tidemark.sources.staging import staged, staging_dir
from tidemark.streaming.incremental import merged_parts, store_parts


def scratch(spark, name):
    return f"{staging_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "normalised_rows",
    "S08 S09 S10 S25",
    """SELECT CAST(c_acctbal AS DOUBLE) AS c_acctbal, CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING'""",
)
def normalised_rows(spark, sf):
    df = landed.read_table(spark, f"{sf}/customer.parquet", where=landed.equals({"c_mktsegment": "BUILDING"}))
    return landed.normalise(landed.drop_private(df, ("c_name",), ("c_mktsegment",)), "c_acctbal")


@query(
    "year_range_read",
    "S01 S04 S05",
    """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS rows_read FROM lineitem WHERE year(l_shipdate) IN (1996, 1999, 2000) OR l_shipdate < DATE '1995-01-01' GROUP BY 1""",
)
def year_range_read(spark, sf):
    rows = landed.read_years(table(spark, sf, "lineitem"), "l_shipdate", [0, 1996, 1999, 2000])
    return landed.year_counts(rows, F.year("l_shipdate"))


@query(
    "stored_parts",
    "S02 S03 S06 S07 S16 S17 S26 S27 S28",
    """WITH y AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n FROM lineitem GROUP BY 1), w AS (SELECT CAST(x AS INTEGER) AS year FROM range(1994, 2004) t(x))
SELECT coalesce(w.year, y.year) AS year, CAST(CASE WHEN w.year = 1998 THEN n + 1 ELSE n END AS DOUBLE) AS rows_expected, CAST(n AS DOUBLE) AS rows_read,
CASE WHEN n IS NULL THEN 'missing' WHEN w.year = 1998 THEN 'mismatch' ELSE 'ok' END AS status FROM w FULL JOIN y ON w.year = y.year""",
)
def stored_parts(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_quantity", F.year("l_shipdate").alias("y"), F.year("l_shipdate").alias("year"))
    root = scratch(spark, "parts")
    sinks.write_by_year(mg.partial_range(li, ["year", "y", "l_returnflag"], "l_quantity"), root)
    schema = "y int, l_returnflag string, rows bigint, n_value bigint, v_sum double, v_min double, v_max double, n_negative bigint"
    parts = landed.read_parts(spark, root, schema)
    merged = mg.merge_range([parts.drop("part_file")], ["y", "l_returnflag"])
    read = merged.groupBy(F.col("y").alias("year")).agg(F.sum("rows").alias("rows_read"))
    expected = landed.year_counts(li, "year").select("year", (F.col("rows_read") + F.when(F.col("year") == 1998, 1).otherwise(0)).alias("rows_expected"))
    out = mg.reconcile(read, mg.expected_years(spark, 1994, 2003).join(expected, "year", "full"))
    return out.withColumns({c: F.col(c).cast("double") for c in ("rows_expected", "rows_read")})


@query(
    "completeness_report",
    "S16 S17",
    """SELECT 7 AS years_present, '1993,1994,2002,2003' AS years_missing, CAST(count(*) AS BIGINT) AS rows_read, false AS complete FROM lineitem""",
)
def completeness_report(spark, sf):
    read = landed.year_counts(table(spark, sf, "lineitem"), F.year("l_shipdate"))
    expected = read.select("year", F.col("rows_read").alias("rows_expected"))
    rec = mg.reconcile(read, mg.expected_years(spark, 1993, 2003).join(expected, "year", "full"))
    out = mg.completeness_report(rec)
    return out.select(
        F.col("years_present").cast("int").alias("years_present"), F.array_join("years_missing", ",").alias("years_missing"), "rows_read", "complete"
    )


def cube_documents(spark, sf):
    """One JSON-stat document per return flag: status × year, with the last cell left out of the sparse ones."""
    li = table(spark, sf, "lineitem")
    cells = li.groupBy("l_returnflag", "l_linestatus", F.year("l_shipdate").alias("year")).agg(F.sum("l_quantity").alias("v"))
    pos = F.when(F.col("l_linestatus") == "F", 0).otherwise(1) * 7 + F.col("year") - 1995
    cells = cells.withColumn("pos", pos.cast("int"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "v")))
    g = cells.groupBy("l_returnflag").agg(ordered.alias("c"))
    dense = F.to_json(F.transform("c", lambda x: x["v"]))
    sparse = F.to_json(F.map_from_entries(F.transform("c", lambda x: F.struct(x["pos"].cast("string"), x["v"]))))
    head = (
        '{"id": ["st", "year"], "dimension": {"st": {"category": {"index": {"F": 0, "O": 1}, "label": {"F": "filled", "O": "open"}}}, '
        '"year": {"category": {"index": ["1995", "1996", "1997", "1998", "1999", "2000", "2001"], "label": {"1995": "first", "2001": "last"}}}}, "value": '
    )
    value = F.when(F.col("l_returnflag") == "R", sparse).otherwise(dense)
    return g.select("l_returnflag", F.concat(F.lit(head), value, F.lit("}")).alias("doc"))


@query(
    "jsonstat_cells",
    "S12",
    """SELECT l_returnflag, l_linestatus AS st, CAST(year(l_shipdate) AS VARCHAR) AS year, sum(l_quantity) AS value FROM lineitem GROUP BY 1, 2, 3""",
)
def jsonstat_cells(spark, sf):
    return jsonstat.flatten(cube_documents(spark, sf), "doc", ["st", "year"], ["l_returnflag"]).drop("status")


@query(
    "jsonstat_labels",
    "S15",
    """SELECT DISTINCT l_returnflag, d AS dim, c AS code, l AS label FROM lineitem, (VALUES ('st', 'F', 'filled'), ('st', 'O', 'open'), ('year', '1995', 'first'), ('year', '2001', 'last')) t(d, c, l)""",
)
def jsonstat_labels(spark, sf):
    return jsonstat.dimension_labels(cube_documents(spark, sf), "l_returnflag", "doc", ["st", "year"])


@query(
    "table_meta",
    "S13 S14",
    """WITH v AS (SELECT l_returnflag, count(DISTINCT year(l_shipdate)) AS ny, count(DISTINCT l_linestatus) AS ns FROM lineitem GROUP BY 1)
SELECT l_returnflag, 'year' AS code, true AS time, CAST(ny AS INTEGER) AS n, ny * ns AS cells FROM v UNION ALL SELECT l_returnflag, 'st', false, CAST(ns AS INTEGER), ny * ns FROM v""",
)
def table_meta(spark, sf):
    li = table(spark, sf, "lineitem")
    g = li.groupBy("l_returnflag").agg(
        F.array_sort(F.collect_set(F.year("l_shipdate").cast("string"))).alias("y"), F.array_sort(F.collect_set("l_linestatus")).alias("s")
    )

    def variable(code, values, time):
        return F.struct(F.lit(code).alias("code"), F.lit(code).alias("text"), F.lit(time).alias("time"), F.col(values).alias("values"), F.col(values).alias("valueTexts"))

    doc = F.to_json(F.struct(F.lit("t").alias("title"), F.array(variable("year", "y", True), variable("st", "s", False)).alias("variables")))
    m = g.select("l_returnflag", doc.alias("doc"))
    out = jsonstat.meta_summary(m, "l_returnflag", "doc").select("l_returnflag", "code", "time", "n")
    return out.join(jsonstat.cells(m, "l_returnflag", "doc"), "l_returnflag")


@query(
    "representative_rows",
    "S21",
    """SELECT p_brand, min(p_partkey) AS p_partkey, arg_min(p_name, p_partkey) AS p_name FROM part GROUP BY 1""",
)
def representative_rows(spark, sf):
    return landed.discover(table(spark, sf, "part"), "p_brand", ["p_partkey", "p_name"])


@query(
    "series_coverage",
    "S22",
    """SELECT event_type, user_id, count(*) AS rows, CAST(CAST(min(ts) AS DATE) AS VARCHAR) AS first, CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS last FROM events GROUP BY 1, 2""",
)
def series_coverage(spark, sf):
    out = landed.series_coverage(table(spark, sf, "events"), ["event_type", "user_id"], "ts")
    return out.withColumns({c: F.to_date(c).cast("string") for c in ("first", "last")})


@query(
    "station_selection",
    "S23",
    """SELECT user_id AS jaam_kood FROM events WHERE event_type = 'view' GROUP BY 1 HAVING count(*) >= 15""",
)
def station_selection(spark, sf):
    per = table(spark, sf, "events").groupBy("user_id", F.col("event_type").alias("series")).agg(F.count(F.lit(1)).alias("rows"))
    stations = per.groupBy(F.col("user_id").alias("jaam_kood")).agg(F.collect_list(F.struct("series", "rows")).alias("series"))
    catalogue = stations.select(F.array(F.struct("jaam_kood", "series")).alias("stations"))
    return landed.select_stations(catalogue, "view", 15)


@query(
    "even_sample",
    "S20 D02",
    """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1 AS pos, count(*) OVER () AS n FROM orders),
b AS (SELECT *, least(pos // greatest(n // 5, 1), 4) AS blk FROM r), s AS (SELECT *, least(blk * greatest(n // 5, 1), n - 400) AS st FROM b)
SELECT o_orderkey FROM s WHERE n <= 2000 OR (pos >= st AND pos < st + 400)""",
)
def even_sample(spark, sf):
    return pf.even_sample(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query("csv_round_trip", "S18 S19", """SELECT c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, '' AS remark FROM customer""")
def csv_round_trip(spark, sf):
    path = scratch(spark, "csv")
    c = table(spark, sf, "customer").select("c_mktsegment", "c_nationkey", "c_name")
    sinks.write_csv(c, path, ["c_name", "c_nationkey", "remark"])
    return sinks.read_csv(spark, path)


@query(
    "stream_partials",
    "A01 A02 S02",
    """SELECT event_type, round(sum(CAST(round(value * 100) AS BIGINT)) / 100.0, 2) AS value, count(*) AS rows, 0::BIGINT AS neg_rows FROM events GROUP BY 1""",
)
def stream_partials(spark, sf):
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    cents = stream.withColumn("value", F.round(F.col("value") * 100).cast("bigint"))
    parts = scratch(spark, "stream")
    store_parts(cents, ["event_type"], "value", parts, checkpoint=scratch(spark, "ck")).awaitTermination()
    out = merged_parts(spark, parts, ["event_type"], "value")
    return out.select("event_type", F.round(F.col("value") / 100.0, 2).alias("value"), "rows", "neg_rows")


@query(
    "series_document",
    "H13 C18 C19",
    f"""WITH {MONTHLY_SQL}, y AS (SELECT entity, year, round(avg(value), 3) AS v FROM m GROUP BY 1, 2)
SELECT entity, count(*) AS years, round(arg_min(v, year), 3) AS first_value, round(arg_max(v, year), 3) AS last_value FROM y GROUP BY 1""",
)
def series_document(spark, sf):
    y = lines_by_month(spark, sf).groupBy("entity", "year").agg(F.avg("value").alias("v"))
    doc = sinks.series_document(y, ["entity"], "year", ["v"])
    recs = F.from_json("document", "array<struct<year:int,v:double>>")
    return doc.select("entity", recs.alias("r")).select(
        "entity", F.size("r").cast("bigint").alias("years"), F.element_at("r", 1)["v"].alias("first_value"), F.element_at("r", -1)["v"].alias("last_value")
    )


@query(
    "seasonal_national",
    "C14 C20",
    f"""WITH {MONTHLY_SQL}, nm AS (SELECT entity, month, avg(value) AS normal FROM m WHERE year BETWEEN 1995 AND 2000 GROUP BY 1, 2 HAVING count(*) >= 5),
a AS (SELECT m.*, value - normal AS anom, CASE WHEN month IN (12, 1, 2) THEN 'DJF' WHEN month <= 5 THEN 'MAM' WHEN month <= 8 THEN 'JJA' ELSE 'SON' END AS season,
      CASE WHEN month = 12 THEN year + 1 ELSE year END AS sy FROM m JOIN nm USING (entity, month)),
p AS (SELECT 'annual' AS period, entity, year, avg(anom) AS anom FROM a GROUP BY 2, 3 HAVING count(*) = 12
      UNION ALL SELECT season, entity, sy, avg(anom) FROM a GROUP BY 1, 2, 3 HAVING count(*) = 3)
SELECT period, CAST(year AS INTEGER) AS year, round(CASE WHEN count(*) >= 5 THEN avg(anom) END, 6) AS mean, round(CASE WHEN count(*) >= 5 THEN quantile_cont(anom, 0.1) END, 6) AS p10,
round(CASE WHEN count(*) >= 5 THEN quantile_cont(anom, 0.9) END, 6) AS p90, count(*) AS n FROM p GROUP BY 1, 2""",
)
def seasonal_national(spark, sf):
    from tidemark.operators.resample import national_series

    names = cl.Names("entity", "year", "month", "value")
    per = climate.annual_and_seasonal(staged(lines_by_month(spark, sf)), "diff", names, (1995, 2000), 5)
    return rounded(national_series(per, "entity", "year", "anom", ["period"], reps=0))


@query(
    "programme_overview",
    "M01 M04 J02",
    """WITH r AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS prog, o_orderpriority AS ind, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)
SELECT prog, count(*) AS rows, min(year) AS first_year, max(year) AS last_year, count(DISTINCT ind) AS indicators FROM r GROUP BY 1""",
)
def programme_overview(spark, sf):
    o = table(spark, sf, "orders").select(
        F.nullif("o_orderstatus", F.lit("P")).alias("prog"), F.col("o_orderpriority").alias("ind"), F.year("o_orderdate").alias("year")
    )
    parts = o.groupBy("prog", "ind", "year").agg(F.count(F.lit(1)).alias("rows"))
    return mg.catalogue_of(parts, ["prog"], distinct={"indicators": "ind"})


@query(
    "fuel_repeats",
    "D11 D19",
    """WITH g AS (SELECT l_orderkey, l_suppkey, count(*) AS n, count(DISTINCT l_tax) AS k FROM lineitem GROUP BY 1, 2)
SELECT count(*) AS groups, count(*) FILTER (n > 1) AS groups_with_multiple_rows, count(*) FILTER (n > 1 AND k = 1) AS multi_row_groups_with_single_amount FROM g""",
)
def fuel_repeats(spark, sf):
    return pf.repeats(table(spark, sf, "lineitem"), ["l_orderkey", "l_suppkey"], "l_tax")


@query(
    "shape_values",
    "D08 D09",
    """WITH c AS (SELECT nullif(o_orderstatus, 'P') AS status, CASE WHEN o_totalprice > 250000 THEN o_orderpriority END AS prio FROM orders),
s AS (SELECT concat_ws('+', CASE WHEN status IS NOT NULL THEN 'status' END, CASE WHEN prio IS NOT NULL THEN 'prio' END) AS shape, * FROM c),
l AS (SELECT shape, 'status' AS "column", status AS v FROM s WHERE status IS NOT NULL UNION ALL SELECT shape, 'prio', prio FROM s WHERE prio IS NOT NULL)
SELECT shape, "column", count(DISTINCT v) AS "distinct", string_agg(DISTINCT v, ',' ORDER BY v) AS values FROM l GROUP BY 1, 2""",
)
def shape_values(spark, sf):
    o = table(spark, sf, "orders").select(
        F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.when(F.col("o_totalprice") > 250000, F.col("o_orderpriority")).alias("prio"), "o_totalprice"
    )
    dims = [c for c in pf.descriptive_columns(o, ["o_totalprice"])]
    return pf.shape_values(o, dims).withColumn("values", F.array_join("values", ","))
