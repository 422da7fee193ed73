"""Normals, anomalies, trends, bootstrap intervals, regimes, indices and cube pivots."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import chain_index as ci
from tidemark.operators import climatology as cl
from tidemark.operators import cubes
from tidemark.operators import hydrology as hy
from tidemark.operators import mergeable as mg
from tidemark.operators import resample as rs
from tidemark.plans.queries.registry import (
    DAILY_SQL,
    MONTHLY_SQL,
    daily_events,
    lines_by_month,
    query,
    rounded,
    table,
)
from tidemark.sources.staging import staged

N = cl.Names("entity", "year", "month", "value")
NORMALS_SQL = """
nm AS (SELECT entity, month, avg(value) AS normal, count(*) AS n_years FROM m WHERE year BETWEEN 1995 AND 2000
       GROUP BY 1, 2 HAVING count(*) >= 5)"""


def monthly(spark, sf):
    """The monthly table written once: normals and anomalies both read it, the lines are scanned once."""
    return staged(lines_by_month(spark, sf))


def normals(m):
    return cl.monthly_normals(m, N, (1995, 2000), 5)


@query("monthly_normals", "C01", f"WITH {MONTHLY_SQL}, {NORMALS_SQL} SELECT entity, month, round(normal, 6) AS normal, n_years FROM nm")
def monthly_normals(spark, sf):
    return rounded(normals(lines_by_month(spark, sf)))


ANOM_SQL = f"WITH {MONTHLY_SQL}, {NORMALS_SQL}, a AS (SELECT m.*, value - normal AS anom FROM m JOIN nm USING (entity, month))"


@query("anomalies_diff", "C02", ANOM_SQL + " SELECT entity, year, month, value, round(anom, 6) AS anom FROM a")
def anomalies_diff(spark, sf):
    m = monthly(spark, sf)
    return rounded(cl.anomalies(m, normals(m), "diff", N).select("entity", "year", "month", "value", "anom"))


@query(
    "anomalies_ratio",
    "C02",
    f"WITH {MONTHLY_SQL}, {NORMALS_SQL} SELECT entity, year, month, round(100.0 * value / normal, 6) AS anom FROM m JOIN nm USING (entity, month) WHERE normal > 0",
)
def anomalies_ratio(spark, sf):
    m = monthly(spark, sf)
    return rounded(cl.anomalies(m, normals(m), "ratio", N).select("entity", "year", "month", "anom"))


SEASON_SQL = """CASE WHEN month IN (12, 1, 2) THEN 'DJF' WHEN month <= 5 THEN 'MAM' WHEN month <= 8 THEN 'JJA' ELSE 'SON' END"""


@query(
    "season_totals",
    "C03 C09",
    f"""WITH {MONTHLY_SQL}, {NORMALS_SQL},
j AS (SELECT m.*, normal, {SEASON_SQL} AS season, CAST(CASE WHEN month = 12 THEN year + 1 ELSE year END AS INTEGER) AS season_year
      FROM m JOIN nm USING (entity, month))
SELECT entity, season, season_year, round(100.0 * sum(value) / sum(normal), 6) AS anom FROM j
GROUP BY 1, 2, 3 HAVING count(*) = 3 AND sum(normal) > 0""",
)
def season_totals(spark, sf):
    m = monthly(spark, sf)
    return rounded(cl.period_ratio(cl.with_season(m, N), normals(m), ["season", "season_year"], 3, N))


@query(
    "gated_period_means",
    "C04 H03",
    ANOM_SQL
    + """ SELECT entity, year, round(avg(anom), 6) AS anom FROM a GROUP BY 1, 2 HAVING count(*) = 12""",
)
def gated_period_means(spark, sf):
    m = monthly(spark, sf)
    return rounded(cl.complete_periods(cl.anomalies(m, normals(m), "diff", N), ["year"], 12, N))


@query(
    "period_matrix",
    "C05 J05",
    ANOM_SQL
    + ", y AS (SELECT entity, year, avg(anom) AS anom FROM a GROUP BY 1, 2 HAVING count(*) = 12) SELECT entity, "
    + ", ".join(f'round(max(CASE WHEN year = {y} THEN anom END), 6) AS "{y}"' for y in range(1995, 2002))
    + " FROM y GROUP BY 1",
)
def period_matrix(spark, sf):
    m = monthly(spark, sf)
    y = cl.complete_periods(cl.anomalies(m, normals(m), "diff", N), ["year"], 12, N)
    return rounded(cl.matrix(y, "year", range(1995, 2002), N))


@query("month_completeness", "C10", f"WITH {MONTHLY_SQL} SELECT entity, year, count(*) AS months FROM m GROUP BY 1, 2")
def month_completeness(spark, sf):
    return cl.completeness(lines_by_month(spark, sf), N)


@query(
    "national_series",
    "C06",
    f"WITH {MONTHLY_SQL}, y AS (SELECT entity, year, sum(value) AS v FROM m GROUP BY 1, 2)"
    " SELECT year, round(avg(v), 6) AS mean, round(quantile_cont(v, 0.1), 6) AS p10, round(quantile_cont(v, 0.9), 6) AS p90, count(*) AS n FROM y GROUP BY 1",
)
def national_series(spark, sf):
    y = lines_by_month(spark, sf).groupBy("entity", "year").agg(F.sum("value").alias("v"))
    return rounded(rs.national_series(y, "entity", "year", "v", reps=0))


REPS = 200


@query(
    "bootstrap_interval",
    "B01 C06",
    f"""WITH {MONTHLY_SQL}, y AS (SELECT entity, year, sum(value) AS v FROM m GROUP BY 1, 2),
e AS (SELECT entity, row_number() OVER (ORDER BY md5(CAST(entity AS VARCHAR)), entity) - 1 AS pos, count(*) OVER () AS n
      FROM (SELECT DISTINCT entity FROM y)),
d AS (SELECT rep, ('0x' || substr(md5('5|' || rep || '|' || pos), 1, 15))::BIGINT % n AS hit FROM e, range(0, {REPS}) t(rep)),
b AS (SELECT rep, year, avg(v) AS mean FROM d JOIN e ON e.pos = d.hit JOIN y ON y.entity = e.entity GROUP BY 1, 2)
SELECT year, round(quantile_cont(mean, 0.025), 8) AS lo, round(quantile_cont(mean, 0.975), 8) AS hi FROM b GROUP BY 1""",
)
def bootstrap_interval(spark, sf):
    y = lines_by_month(spark, sf).groupBy("entity", "year").agg(F.sum("value").alias("v"))
    return rounded(rs.entity_bootstrap(y, [], "entity", "year", "v", REPS, 5), 8)


MONTH_NO = "CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS INTEGER)"
ORDERS_SQL = f"""
o AS (SELECT c_mktsegment AS seg, {MONTH_NO} AS x, count(*) AS y FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)"""


def orders_by_segment(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    x = ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate")).alias("x")
    per = o.groupBy("o_custkey", x).agg(F.count(F.lit(1)).alias("n"))
    return per.join(c, per.o_custkey == c.c_custkey).groupBy(F.col("c_mktsegment").alias("seg"), "x").agg(F.sum("n").alias("y"))


@query(
    "theil_sen_slope",
    "C07",
    f"""WITH {ORDERS_SQL}, s AS (SELECT a.seg, (b.y - a.y) / (b.x - a.x) AS s FROM o a JOIN o b ON a.seg = b.seg AND a.x < b.x),
n AS (SELECT seg, count(*) AS n FROM o GROUP BY 1)
SELECT n.seg, n.n, round(median(s), 6) AS slope FROM n LEFT JOIN s ON n.seg = s.seg GROUP BY 1, 2""",
)
def theil_sen_slope(spark, sf):
    return rounded(rs.theil_sen(orders_by_segment(spark, sf), ["seg"], "x", "y"))


@query(
    "theil_sen_days",
    "C07 C16",
    """WITH o AS (SELECT l_returnflag AS flag, date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS x, sum(l_quantity) AS y FROM lineitem GROUP BY 1, 2),
s AS (SELECT a.flag, median((b.y - a.y) / (b.x - a.x)) AS slope FROM o a JOIN o b ON a.flag = b.flag AND a.x < b.x GROUP BY 1),
n AS (SELECT flag, count(*) AS n FROM o GROUP BY 1)
SELECT n.flag, n.n, round(s.slope, 6) AS slope FROM n LEFT JOIN s ON n.flag = s.flag""",
)
def theil_sen_days(spark, sf):
    """Trend of daily quantities: millions of pairs a series, none of them listed."""
    li = table(spark, sf, "lineitem")
    days = li.groupBy(F.col("l_returnflag").alias("flag"), F.date_diff(F.col("l_shipdate").cast("date"), F.lit("1990-01-01").cast("date")).alias("x")).agg(F.sum("l_quantity").alias("y"))
    return rounded(rs.theil_sen_long(days, ["flag"], "x", "y"))


@query(
    "block_bootstrap_trend",
    "C08 B02",
    f"""WITH o AS (SELECT o_orderpriority AS seg, CAST(year(o_orderdate) * 4 + quarter(o_orderdate) AS INTEGER) AS x, count(*) AS y FROM orders GROUP BY 1, 2),
p AS (SELECT *, row_number() OVER (PARTITION BY seg ORDER BY x) AS i, count(*) OVER (PARTITION BY seg) AS n FROM o),
h AS (SELECT a.seg, 10 * median((b.y - a.y) / (b.x - a.x)) AS slope, max(a.n) AS n FROM p a JOIN p b ON a.seg = b.seg AND a.i < b.i GROUP BY 1),
k AS (SELECT DISTINCT seg, n FROM p),
bl AS (SELECT k.seg, n, rep, b, ('0x' || substr(md5('7|' || rep || '|' || b), 1, 15))::BIGINT % (n - 2) AS start
       FROM k, range(0, 60) t(rep), range(0, 100) u(b) WHERE b < ceil(n / 3.0)),
s AS (SELECT bl.seg, rep, b * 3 + o AS at, p.x, p.y FROM bl, range(0, 3) v(o) JOIN p ON true WHERE p.seg = bl.seg AND p.i = start + o + 1 AND b * 3 + o < bl.n),
r AS (SELECT a.seg, a.rep, 10 * median((c.y - a.y) / (c.x - a.x)) AS s FROM s a JOIN s c ON a.seg = c.seg AND a.rep = c.rep AND a.at < c.at AND a.x <> c.x GROUP BY 1, 2)
SELECT h.seg, h.n, round(h.slope, 6) AS slope_per_decade, round(quantile_cont(s, 0.025), 6) AS lo, round(quantile_cont(s, 0.975), 6) AS hi
FROM h JOIN r ON h.seg = r.seg GROUP BY 1, 2, 3""",
)
def block_bootstrap_trend(spark, sf):
    o = table(spark, sf, "orders").groupBy(
        F.col("o_orderpriority").alias("seg"), (F.year("o_orderdate") * 4 + F.quarter("o_orderdate")).alias("x")
    ).agg(F.count(F.lit(1)).alias("y"))
    return rounded(rs.trend(o, ["seg"], "x", "y", reps=60))


@query(
    "spearman_rank",
    "B04",
    """WITH o AS (SELECT p_brand, CAST(year(l_shipdate) * 12 + month(l_shipdate) AS INTEGER) AS t, sum(l_quantity) AS x, count(*) AS y
           FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
r AS (SELECT p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY x, t) AS rx, row_number() OVER (PARTITION BY p_brand ORDER BY y, t) AS ry FROM o)
SELECT p_brand, round(corr(rx, ry), 6) AS rho, count(*) AS n FROM r GROUP BY 1""",
)
def spearman_rank(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part").select("p_partkey", "p_brand")
    t = (F.year("l_shipdate") * 12 + F.month("l_shipdate")).alias("t")
    per = li.groupBy("l_partkey", t).agg(F.sum("l_quantity").alias("x"), F.count(F.lit(1)).alias("y"))
    o = per.join(p, per.l_partkey == p.p_partkey).groupBy("p_brand", "t").agg(F.sum("x").alias("x"), F.sum("y").alias("y"))
    return rounded(rs.spearman(o, ["p_brand"], "t", "x", "y", reps=0))


@query(
    "spearman_bootstrap",
    "B04 H12 H15",
    """WITH li AS (SELECT CAST(year(l_shipdate) * 4 + quarter(l_shipdate) AS INTEGER) AS t, count(*) AS x FROM lineitem GROUP BY 1),
od AS (SELECT CAST(year(o_orderdate) * 4 + quarter(o_orderdate) AS INTEGER) AS t, count(*) AS y FROM orders GROUP BY 1),
p AS (SELECT t, x, y, row_number() OVER (ORDER BY t) - 1 AS i, count(*) OVER () AS n FROM li JOIN od USING (t)),
h AS (SELECT corr(rx, ry) AS rho, count(*) AS n FROM (SELECT row_number() OVER (ORDER BY x, i) AS rx, row_number() OVER (ORDER BY y, i) AS ry FROM p)),
d AS (SELECT rep, p.i AS spot, ('0x' || substr(md5('11|' || rep || '|' || p.i), 1, 15))::BIGINT % n AS hit FROM p, range(0, 300) t(rep)),
s AS (SELECT rep, spot, x, y FROM d JOIN p ON p.i = d.hit),
b AS (SELECT rep, corr(rx, ry) AS rho FROM (SELECT rep, row_number() OVER (PARTITION BY rep ORDER BY x, spot) AS rx,
      row_number() OVER (PARTITION BY rep ORDER BY y, spot) AS ry FROM s) GROUP BY 1)
SELECT round(h.rho, 6) AS rho, h.n, round(quantile_cont(b.rho, 0.025), 6) AS lo, round(quantile_cont(b.rho, 0.975), 6) AS hi FROM h, b GROUP BY h.rho, h.n""",
)
def spearman_bootstrap(spark, sf):
    def per_quarter(name, ts, out):
        t = (F.year(ts) * 4 + F.quarter(ts)).alias("t")
        return table(spark, sf, name).groupBy(t).agg(F.count(F.lit(1)).alias(out))

    _, corr = hy.link_series(per_quarter("lineitem", "l_shipdate", "x"), per_quarter("orders", "o_orderdate", "y"), "t", "x", "y", reps=300)
    return rounded(corr)


@query(
    "threshold_days",
    "C12",
    """WITH d AS (SELECT user_id AS entity, CASE WHEN day(ts) <= 15 THEN 1 ELSE 2 END AS year, event_type, CAST(ts AS DATE) AS date, max(value) AS v
           FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1, 2, 3, 4)
SELECT entity, year,
  CASE WHEN count(*) FILTER (event_type = 'view') >= 5 THEN count(*) FILTER (event_type = 'view' AND v < 5) END::DOUBLE AS "ID",
  CASE WHEN count(*) FILTER (event_type = 'view') >= 5 THEN count(*) FILTER (event_type = 'view' AND v >= 25) END::DOUBLE AS "SU25",
  CASE WHEN count(*) FILTER (event_type = 'click') >= 5 THEN count(*) FILTER (event_type = 'click' AND v < 10) END::DOUBLE AS "FD",
  CASE WHEN count(*) FILTER (event_type = 'purchase') >= 5 THEN count(*) FILTER (event_type = 'purchase' AND v >= 20) END::DOUBLE AS "R20",
  CASE WHEN count(*) FILTER (event_type = 'purchase') >= 5 THEN max(v) FILTER (event_type = 'purchase') END AS "Rx1day"
FROM d GROUP BY 1, 2 HAVING greatest(count(*) FILTER (event_type = 'view'), count(*) FILTER (event_type = 'click'), count(*) FILTER (event_type = 'purchase')) >= 5""",
)
def threshold_days(spark, sf):
    return day_index_frame(spark, sf).withColumns({c: F.col(c).cast("double") for c in ("ID", "SU25", "FD", "R20")})


def day_index_frame(spark, sf):
    ev = table(spark, sf, "events").groupBy(
        F.col("user_id").alias("entity"), F.when(F.dayofmonth("ts") <= 15, 1).otherwise(2).alias("year"),
        F.col("event_type").alias("variable"), F.to_date("ts").alias("date"),
    ).agg(F.max("value").alias("value"))
    spec = {"ID": ("view", "<", 5.0), "SU25": ("view", ">=", 25.0), "FD": ("click", "<", 10.0), "R20": ("purchase", ">=", 20.0)}
    return cl.day_indices(ev, N, indices=spec, maximum={"Rx1day": "purchase"}, min_days=5)


@query(
    "index_series",
    "C13",
    """WITH d AS (SELECT l_suppkey AS entity, CAST(year(l_shipdate) AS INTEGER) AS year, count(*) FILTER (l_quantity > 49) AS a, count(*) FILTER (l_discount > 0.09) AS b FROM lineitem GROUP BY 1, 2),
l AS (SELECT year, 'A' AS index, a AS v FROM d UNION ALL SELECT year, 'B', b FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY index, year ORDER BY v) AS rn, count(*) OVER (PARTITION BY index, year) AS n FROM l)
SELECT index, year, round(avg(v), 6) AS mean, round(avg(CASE WHEN v > 0 THEN 1.0 ELSE 0.0 END), 6) AS share_any, count(*) AS n,
  round(quantile_cont(v, 0.5), 6) AS median, CAST(max(CASE WHEN rn = round((n - 1) * 0.1) + 1 THEN v END) AS DOUBLE) AS q10,
  CAST(max(CASE WHEN rn = round((n - 1) * 0.9) + 1 THEN v END) AS DOUBLE) AS q90
FROM r GROUP BY 1, 2 HAVING count(*) >= 5""",
)
def index_series(spark, sf):
    d = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("entity"), F.year("l_shipdate").alias("year")).agg(
        F.count_if(F.col("l_quantity") > 49).alias("A"), F.count_if(F.col("l_discount") > 0.09).alias("B")
    )
    return rounded(cl.index_series(d, ["A", "B"], "year"))


@query(
    "period_means_range_join",
    "C15",
    """WITH y AS (SELECT o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS v FROM orders GROUP BY 1, 2),
p AS (SELECT * FROM (VALUES (1991, 1994), (1995, 1997), (1998, 2000), (2001, 2005)) t("from", "to")), s AS (SELECT DISTINCT o_orderstatus FROM y)
SELECT s.o_orderstatus, CAST(p."from" AS INTEGER) AS "from", CAST(p."to" AS INTEGER) AS "to", count(y.v) AS n_years, round(avg(y.v), 6) AS mean
FROM s CROSS JOIN p LEFT JOIN y ON y.o_orderstatus = s.o_orderstatus AND y.year BETWEEN p."from" AND p."to" GROUP BY 1, 2, 3""",
)
def period_means_range_join(spark, sf):
    y = table(spark, sf, "orders").groupBy("o_orderstatus", F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("v"))
    return rounded(cl.period_means(y, "year", "v", [(1991, 1994), (1995, 1997), (1998, 2000), (2001, 2005)], ["o_orderstatus"]))


@query(
    "monthly_vs_daily_check",
    "C17",
    f"""WITH {DAILY_SQL}, own AS (SELECT user_id, event_type, avg(value) AS o FROM d GROUP BY 1, 2 HAVING count(*) >= 4),
pub AS (SELECT user_id, event_type, avg(value) AS p FROM events GROUP BY 1, 2),
x AS (SELECT abs(p - o) AS d FROM pub JOIN own USING (user_id, event_type))
SELECT count(*) AS n, round(max(d), 9) AS max_abs_diff, round(quantile_cont(d, 0.5), 9) AS median_abs_diff FROM x""",
)
def monthly_vs_daily_check(spark, sf):
    pub = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.avg("value").alias("value"))
    return rounded(cl.consistency_check(pub, daily_events(spark, sf), ["user_id", "event_type"], "value", 4), 9)


@query(
    "month_grid",
    "C14",
    ANOM_SQL + " SELECT year, month, round(avg(anom), 6) AS mean, count(DISTINCT entity) AS n FROM a GROUP BY 1, 2 HAVING count(DISTINCT entity) >= 5",
)
def month_grid(spark, sf):
    m = monthly(spark, sf)
    return rounded(cl.month_grid(cl.anomalies(m, normals(m), "diff", N), N))


@query(
    "top_periods",
    "C11",
    """WITH y AS (SELECT l_returnflag, CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS t, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY l_returnflag ORDER BY v DESC, t) AS INTEGER) AS rank FROM y) SELECT * FROM r WHERE rank <= 5""",
)
def top_periods(spark, sf):
    y = table(spark, sf, "lineitem").groupBy("l_returnflag", (F.year("l_shipdate") * 100 + F.month("l_shipdate")).alias("t")).agg(
        F.sum("l_quantity").alias("v")
    )
    return cl.top_periods(y, "t", "v", 5, ["l_returnflag"])


@query(
    "regime_bands",
    "H03 H04 J03",
    f"""WITH {MONTHLY_SQL}, b AS (SELECT *, max(year) OVER () AS cy FROM m),
r AS (SELECT *, row_number() OVER (PARTITION BY entity, month ORDER BY value) AS rn, count(*) OVER (PARTITION BY entity, month) AS n FROM b WHERE year < cy),
p AS (SELECT entity, month, max(CASE WHEN rn = round((n - 1) * 0.1) + 1 THEN value END) AS q10, median(value) AS median,
      max(CASE WHEN rn = round((n - 1) * 0.9) + 1 THEN value END) AS q90, count(*) AS n_years FROM r GROUP BY 1, 2),
c AS (SELECT entity, month, value AS current FROM b WHERE year = cy)
SELECT coalesce(p.entity, c.entity) AS entity, coalesce(p.month, c.month) AS month, q10, median, q90, coalesce(n_years, 0) AS n_years, current
FROM p FULL JOIN c ON p.entity = c.entity AND p.month = c.month""",
)
def regime_bands(spark, sf):
    return hy.regime(lines_by_month(spark, sf), entity="entity")


@query(
    "annual_runoff",
    "H05",
    f"""WITH {MONTHLY_SQL}, y AS (SELECT entity, year, avg(value) AS q_mean, count(*) AS n_days FROM m GROUP BY 1, 2 HAVING count(*) >= 11)
SELECT entity, year, round(q_mean, 6) AS q_mean, n_days, area, round(q_mean * 1000 / area, 6) AS specific_ls_km2,
       round(q_mean * 31557600.0 / (area * 1000), 4) AS runoff_mm
FROM y LEFT JOIN (SELECT s_suppkey, CASE WHEN s_nationkey <> 0 THEN CAST(s_nationkey AS DOUBLE) END AS area FROM supplier) ON entity = s_suppkey""",
)
def annual_runoff(spark, sf):
    area = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("entity"), F.col("s_nationkey").cast("double").alias("area"))
    out = hy.annual_runoff(lines_by_month(spark, sf), area, "entity", 11)
    return rounded(out.withColumn("runoff_mm", F.round("runoff_mm", 4)))


@query(
    "pct_of_own_mean",
    "H06",
    """WITH y AS (SELECT l_suppkey AS e, CAST(year(l_shipdate) AS INTEGER) AS year, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2),
p AS (SELECT year, 100.0 * v / avg(v) OVER (PARTITION BY e) AS pct FROM y),
r AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY pct) AS rn, count(*) OVER (PARTITION BY year) AS n FROM p)
SELECT year, round(avg(pct), 6) AS pct_of_mean, count(*) AS n, round(max(CASE WHEN rn = round((n - 1) * 0.1) + 1 THEN pct END), 6) AS p10,
       round(max(CASE WHEN rn = round((n - 1) * 0.9) + 1 THEN pct END), 6) AS p90
FROM r GROUP BY 1 HAVING count(*) >= 5""",
)
def pct_of_own_mean(spark, sf):
    y = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("e"), F.year("l_shipdate").alias("year")).agg(F.sum("l_quantity").alias("v"))
    return rounded(hy.percent_of_own_mean(y, "e", "year", "v"))


@query(
    "exceedance_curve",
    "H07",
    "WITH " + DAILY_SQL + " "
    + " UNION ALL ".join(
        f"SELECT event_type, {float(p)}::DOUBLE AS p, round(quantile_cont(value, {(100 - p) / 100}), 6) AS value, count(*) AS n_days FROM d GROUP BY 1 HAVING count(*) >= 100"
        for p in hy.EXCEEDANCE
    ),
)
def exceedance_curve(spark, sf):
    return rounded(hy.flow_duration(daily_events(spark, sf), None, ["event_type"], min_days=100))


@query(
    "rolling_min7",
    "H08",
    """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS date, max(value) AS value FROM events GROUP BY 1, 2),
w AS (SELECT event_type, avg(value) OVER w AS m, row_number() OVER (PARTITION BY event_type ORDER BY date) AS i
      FROM d WINDOW w AS (PARTITION BY event_type ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT event_type, round(min(m), 9) AS q7min FROM w WHERE i >= 7 GROUP BY 1""",
)
def rolling_min7(spark, sf):
    d = table(spark, sf, "events").groupBy("event_type", F.to_date("ts").alias("date")).agg(F.max("value").alias("value"))
    return rounded(hy.rolling_minimum(d, ["event_type"], "date", "value"), 9)


@query(
    "annual_extremes",
    "H08",
    f"""WITH {DAILY_SQL}, f AS (SELECT user_id, count(*) AS n FROM d WHERE event_type = 'view' GROUP BY 1 HAVING count(*) >= 10),
p AS (SELECT user_id, max(value) AS peak FROM d WHERE event_type = 'click' GROUP BY 1),
w AS (SELECT user_id, avg(value) OVER w AS m, row_number() OVER (PARTITION BY user_id ORDER BY date) AS i FROM d WHERE event_type = 'view'
      WINDOW w AS (PARTITION BY user_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)),
q AS (SELECT user_id, min(m) AS q7min FROM w WHERE i >= 7 GROUP BY 1)
SELECT f.user_id, CAST(2024 AS INTEGER) AS year, peak, round(q7min, 9) AS q7min FROM f LEFT JOIN p USING (user_id) LEFT JOIN q USING (user_id)""",
)
def annual_extremes(spark, sf):
    d = hy.valid_days(daily_events(spark, sf), None, 1)
    out = hy.annual_extremes(d.where(F.col("event_type") == "view"), d.where(F.col("event_type") == "click"), "user_id", 10)
    return rounded(out, 9)


@query(
    "seasonal_temperature",
    "H09",
    f"""WITH {MONTHLY_SQL} SELECT entity, year, round(avg(value), 6) AS annual_mean, count(*) AS n_days,
round(CASE WHEN count(*) FILTER (month BETWEEN 6 AND 8) >= 3 THEN avg(value) FILTER (month BETWEEN 6 AND 8) END, 6) AS summer_mean,
CAST(CASE WHEN count(*) FILTER (month BETWEEN 6 AND 8) >= 3 THEN count(*) FILTER (month BETWEEN 6 AND 8) END AS DOUBLE) AS n_summer
FROM m GROUP BY 1, 2 HAVING count(*) >= 10""",
)
def seasonal_temperature(spark, sf):
    out = hy.water_temperature(lines_by_month(spark, sf), "entity", 10, 3)
    return rounded(out.withColumn("n_summer", F.col("n_summer").cast("double")))


@query(
    "coverage_share",
    "H10 J05",
    f"""WITH {DAILY_SQL} SELECT user_id, CAST(2024 AS INTEGER) AS year, count(*) AS valid, round(least(greatest(count(*) / 30.0, 0), 1), 6) AS share FROM d GROUP BY 1""",
)
def coverage_share(spark, sf):
    return rounded(hy.coverage(hy.valid_days(daily_events(spark, sf), None, 1), "user_id", 30.0))


@query(
    "plausibility",
    "H11 J06",
    f"WITH {DAILY_SQL} SELECT round(min(value), 2) AS min, round(max(value), 2) AS max, round(quantile_cont(value, 0.5), 2) AS median FROM d",
)
def plausibility(spark, sf):
    return hy.plausibility(daily_events(spark, sf), "value")


@query(
    "own_mean_anomaly",
    "J04",
    """WITH y AS (SELECT l_suppkey AS entity, CAST(year(l_shipdate) AS INTEGER) AS year, avg(l_quantity) AS v FROM lineitem WHERE month(l_shipdate) BETWEEN 6 AND 8 GROUP BY 1, 2)
SELECT entity, year, round(v - m, 6) AS anomaly FROM (SELECT *, avg(v) OVER (PARTITION BY entity) AS m, count(*) OVER (PARTITION BY entity) AS k FROM y) WHERE k >= 5""",
)
def own_mean_anomaly(spark, sf):
    li = table(spark, sf, "lineitem").where(F.month("l_shipdate").between(6, 8))
    y = mg.gated_mean(li.select(F.col("l_suppkey").alias("entity"), F.year("l_shipdate").alias("year"), "l_quantity"), ["entity", "year"], "l_quantity")
    return rounded(hy.summer_anomaly(y, "entity", "value"))


@query(
    "index_to_base",
    "X17 X18 X28",
    """WITH y AS (SELECT o_orderstatus AS series, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS v FROM orders GROUP BY 1, 2)
SELECT y.series, y.year, y.v, round(100.0 * y.v / b.v, 6) AS index FROM y JOIN y b ON b.series = y.series AND b.year = 1996""",
)
def index_to_base(spark, sf):
    y = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("series"), F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("v"))
    return rounded(cl.index_to_base(y, "series", "year", "v", 1996))


@query(
    "index_first_common_year",
    "X29",
    """WITH y AS (SELECT 'orders' AS series, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS v FROM orders WHERE year(o_orderdate) >= 1996 GROUP BY 2
UNION ALL SELECT 'lines', CAST(year(l_shipdate) AS INTEGER), count(*) FROM lineitem GROUP BY 2
UNION ALL SELECT 'extra', CAST(year(l_shipdate) AS INTEGER), count(*) FROM lineitem WHERE l_returnflag = 'R' GROUP BY 2),
c AS (SELECT year FROM y WHERE series IN ('orders', 'lines') GROUP BY 1 HAVING count(DISTINCT series) = 2),
b AS (SELECT series, y.year AS base_year, v FROM y WHERE year = (SELECT min(year) FROM c))
SELECT y.series, y.year, y.v, base_year, round(100.0 * y.v / b.v, 6) AS index FROM y JOIN c ON y.year = c.year JOIN b ON b.series = y.series""",
)
def index_first_common_year(spark, sf):
    def yearly(df, ts, name):
        return df.groupBy(F.year(ts).alias("year")).agg(F.count(F.lit(1)).alias("v")).withColumn("series", F.lit(name))

    o, li = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    y = yearly(o.where(F.year("o_orderdate") >= 1996), "o_orderdate", "orders").unionByName(yearly(li, "l_shipdate", "lines"))
    y = y.unionByName(yearly(li.where(F.col("l_returnflag") == "R"), "l_shipdate", "extra"))
    return rounded(cl.index_to_first_common(y, "series", "year", "v", ["orders", "lines"]))


@query(
    "complete_years_only",
    "X14",
    """WITH m AS (SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS year, month(l_shipdate) AS mo, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2, 3)
SELECT l_returnflag, year, sum(v) AS total FROM m GROUP BY 1, 2 HAVING count(*) = 12""",
)
def complete_years_only(spark, sf):
    m = table(spark, sf, "lineitem").groupBy("l_returnflag", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("mo")).agg(F.sum("l_quantity").alias("v"))
    return cubes.complete_years(m, ["l_returnflag"], "year", "v")


@query(
    "recent_profiles",
    "X14",
    """WITH m AS (SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS year, month(l_shipdate) AS mo, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2, 3),
c AS (SELECT l_returnflag, year, dense_rank() OVER (PARTITION BY l_returnflag ORDER BY year DESC) AS r FROM m GROUP BY 1, 2 HAVING count(*) = 12)
SELECT m.l_returnflag, m.year, string_agg(CAST(CAST(v AS BIGINT) AS VARCHAR), ',' ORDER BY mo) AS months FROM m JOIN c USING (l_returnflag, year) WHERE r <= 3 GROUP BY 1, 2""",
)
def recent_profiles(spark, sf):
    m = table(spark, sf, "lineitem").groupBy("l_returnflag", F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("mo")).agg(F.sum("l_quantity").alias("v"))
    full = cubes.complete_years(m, ["l_returnflag"], "year", "v")
    out = cubes.recent_profiles(m, full, ["l_returnflag"], "year", "mo", "v")
    return out.withColumn("months", F.array_join(F.transform("months", lambda x: x.cast("bigint").cast("string")), ","))


@query(
    "sign_detection",
    "X01 X02 X03",
    """WITH y AS (SELECT year(l_shipdate) AS y, sum(l_quantity) FILTER (l_returnflag = 'A' AND l_linestatus = 'F') AS prod, sum(l_quantity) FILTER (l_returnflag = 'A' AND l_linestatus = 'O') AS imp,
  sum(l_quantity) FILTER (l_returnflag = 'R') AS exp, sum(l_quantity) FILTER (l_returnflag = 'N' AND l_linestatus = 'O') AS stk, sum(l_quantity) AS gae FROM lineitem GROUP BY 1),
c AS (SELECT * FROM (VALUES (0, -1, -1), (1, -1, 1), (2, 1, -1), (3, 1, 1)) t(i, a, b)),
r AS (SELECT i, a, b, sum(abs(gae - (prod + imp + a * exp + b * stk))) / sum(abs(gae)) AS res FROM y, c GROUP BY 1, 2, 3)
SELECT CAST(a AS INTEGER) AS sign_a, CAST(b AS INTEGER) AS sign_b, round(res, 6) AS residual_share FROM r ORDER BY res, i LIMIT 1""",
)
def sign_detection(spark, sf):
    li = table(spark, sf, "lineitem")
    flag, st, q = F.col("l_returnflag"), F.col("l_linestatus"), F.col("l_quantity")
    wide = li.groupBy(F.year("l_shipdate").alias("year")).agg(
        F.sum(F.when((flag == "A") & (st == "F"), q)).alias("prod"), F.sum(F.when((flag == "A") & (st == "O"), q)).alias("imp"),
        F.sum(F.when(flag == "R", q)).alias("exp"), F.sum(F.when((flag == "N") & (st == "O"), q)).alias("stk"), F.sum(q).alias("gae"),
    )
    return rounded(cubes.detect_signs(wide, "gae", ["prod", "imp"], ("exp", "stk")))


@query(
    "balance_rows",
    "X04 X07 X09 X21 X27",
    """WITH y AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, sum(l_quantity) FILTER (l_returnflag = 'A') AS imports, sum(l_quantity) FILTER (l_returnflag = 'R') AS exports,
  sum(l_quantity) FILTER (l_returnflag = 'N') AS gae FROM lineitem GROUP BY 1)
SELECT year, imports, exports, gae, imports - exports AS net_imports, round(100.0 * (imports - exports) / gae, 6) AS dependency_pct FROM y""",
)
def balance_rows(spark, sf):
    li = table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("y"), "l_returnflag").agg(F.sum("l_quantity").alias("v"))
    wide = cubes.align(li, "y", "l_returnflag", "v", {"A": "imports", "R": "exports", "N": "gae"})
    signs = spark.range(1).select(F.lit(-1).alias("sign_a"))
    return rounded(cubes.balance_rows(wide, signs))


@query(
    "remainder_pivot",
    "X05 X08 X13 X16 X19 X25",
    """WITH s AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, p_brand, sum(l_quantity) AS v FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
SELECT year, sum(v) AS total, coalesce(sum(v) FILTER (p_brand IN ('Brand#1', 'Brand#2')), 0) AS low, coalesce(sum(v) FILTER (p_brand IN ('Brand#3')), 0) AS mid,
  coalesce(sum(v) FILTER (p_brand IN ('Brand#2', 'Brand#3', 'Brand#9')), 0) AS renewable,
  greatest(0, sum(v) - coalesce(sum(v) FILTER (p_brand IN ('Brand#1', 'Brand#2')), 0) - coalesce(sum(v) FILTER (p_brand IN ('Brand#3')), 0)) AS other
FROM s GROUP BY 1""",
)
def remainder_pivot(spark, sf):
    s = brand_years(spark, sf)
    return cubes.group_pivot(
        s, "year", "p_brand", "v", {"low": ["Brand#1", "Brand#2"], "mid": ["Brand#3"]}, F.lit(True),
        subsets={"renewable": ["Brand#2", "Brand#3", "Brand#9"]},
    )


def brand_years(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part").select("p_partkey", "p_brand")
    per = li.groupBy("l_partkey", F.year("l_shipdate").alias("year")).agg(F.sum("l_quantity").alias("q"))
    return per.join(p, per.l_partkey == p.p_partkey).groupBy("year", "p_brand").agg(F.sum("q").alias("v"))


@query(
    "share_of_total",
    "X06",
    """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, sum(l_quantity) FILTER (p_brand IN ('Brand#2', 'Brand#9')) AS part, sum(l_quantity) AS total,
round(100.0 * sum(l_quantity) FILTER (p_brand IN ('Brand#2', 'Brand#9')) / sum(l_quantity), 6) AS share_pct FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def share_of_total(spark, sf):
    return rounded(cubes.share_of_total(brand_years(spark, sf), "year", "v", F.col("p_brand").isin("Brand#2", "Brand#9"), F.lit(True)))


@query(
    "map_by_year",
    "X12",
    """WITH s AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag, CAST(sum(l_quantity) AS BIGINT) AS v FROM lineitem GROUP BY 1, 2)
SELECT year, string_agg(l_returnflag || '=' || v, ';' ORDER BY l_returnflag) AS values FROM s GROUP BY 1""",
)
def map_by_year(spark, sf):
    s = table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year"), "l_returnflag").agg(F.sum("l_quantity").cast("bigint").alias("v"))
    m = cubes.map_of(s, ["year"], "l_returnflag", "v", "m")
    parts = F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return m.select("year", F.array_join(parts, ";").alias("values"))


@query(
    "with_and_without_chapters",
    "X23 X24",
    """WITH s AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(n_nationkey AS VARCHAR) AS code, l_returnflag AS item, sum(l_quantity) AS v,
  CASE WHEN n_nationkey < 20 THEN lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS ch
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2, 3, 5)
SELECT year, sum(v) FILTER (item = 'R') AS generated, coalesce(sum(v) FILTER (item = 'R' AND ch IN ('01', '10')), 0) AS generated_excluded,
  sum(v) FILTER (item = 'A') AS recovery, coalesce(sum(v) FILTER (item = 'A' AND ch IN ('01', '10')), 0) AS recovery_excluded,
  sum(v) FILTER (item = 'R') - coalesce(sum(v) FILTER (item = 'R' AND ch IN ('01', '10')), 0) AS generated_other,
  round(coalesce(sum(v) FILTER (item = 'R' AND ch IS NOT NULL), 0) / sum(v) FILTER (item = 'R'), 6) AS chapter_share
FROM s GROUP BY 1""",
)
def with_and_without_chapters(spark, sf):
    li, s, n = table(spark, sf, "lineitem"), table(spark, sf, "supplier"), table(spark, sf, "nation")
    per = li.groupBy("l_suppkey", "l_returnflag", F.year("l_shipdate").alias("year")).agg(F.sum("l_quantity").alias("q"))
    rows = per.join(s, per.l_suppkey == s.s_suppkey).groupBy(
        "year", F.col("s_nationkey").cast("string").alias("code"), F.col("l_returnflag").alias("item")
    ).agg(F.sum("q").alias("v"))
    total = rows.groupBy("year", "item").agg(F.sum("v").alias("v")).withColumn("code", F.lit("total"))
    labels = n.select(
        F.col("n_nationkey").cast("string").alias("code"),
        F.when(F.col("n_nationkey") < 20, F.format_string("%02d0000 %s", "n_nationkey", "n_name")).otherwise(F.col("n_name")).alias("label"),
    )
    chapters = cubes.chapter_codes(labels)
    out = cubes.with_and_without(
        rows.unionByName(total), chapters, "year", "code", "item", "v", {"R": "generated", "A": "recovery"}, "total", ["01", "10"]
    )
    return rounded(out)


@query(
    "labelled_activity",
    "X26",
    """SELECT CAST(year(l_shipdate) AS INTEGER) AS year, coalesce(CASE WHEN n_nationkey < 20 THEN n_name END, CAST(n_nationkey AS VARCHAR)) AS name, sum(l_quantity) AS v
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2""",
)
def labelled_activity(spark, sf):
    li, s, n = table(spark, sf, "lineitem"), table(spark, sf, "supplier"), table(spark, sf, "nation")
    per = li.groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(F.sum("l_quantity").alias("q"))
    rows = per.join(s, per.l_suppkey == s.s_suppkey).groupBy("year", F.col("s_nationkey").cast("string").alias("code")).agg(F.sum("q").alias("v"))
    labels = n.where(F.col("n_nationkey") < 20).select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("label"))
    return cubes.labelled(rows, labels, "code").select("year", "name", "v")


BIRDS_SQL = """
c0 AS (SELECT p_brand AS species, l_suppkey AS point, CAST(year(l_shipdate) AS INTEGER) AS year, max(l_quantity) AS v FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3),
st AS (SELECT year, row_number() OVER (ORDER BY year) - 1 AS step, count(*) OVER () AS steps FROM (SELECT DISTINCT year FROM c0)),
c AS (SELECT c0.*, step, steps FROM c0 JOIN st USING (year)),
sv AS (SELECT DISTINCT point, step FROM c),
bo AS (SELECT b.point, b.step FROM sv a JOIN sv b ON a.point = b.point AND b.step = a.step + 1)"""
CHAIN_SQL = """
gr AS (SELECT species, t.step FROM (SELECT DISTINCT species FROM lk) CROSS JOIN (SELECT step FROM st) t),
ch AS (SELECT gr.species, gr.step, CASE WHEN sum(CASE WHEN gr.step > 0 AND ratio IS NULL THEN 1 ELSE 0 END) OVER w = 0
         THEN 100.0 * exp(sum(CASE WHEN gr.step > 0 THEN ln(ratio) ELSE 0 END) OVER w) END AS idx
       FROM gr LEFT JOIN lk ON lk.species = gr.species AND lk.step = gr.step
       WINDOW w AS (PARTITION BY gr.species ORDER BY gr.step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ok AS (SELECT species FROM ch GROUP BY 1 HAVING bool_and(idx IS NOT NULL))"""
LINKS_SQL = """
np AS (SELECT step, count(*) AS points FROM bo GROUP BY 1),
ab AS (SELECT species, bo.step, sum(CASE WHEN c.step = bo.step - 1 THEN v ELSE 0 END) AS a, sum(CASE WHEN c.step = bo.step THEN v ELSE 0 END) AS b
       FROM c JOIN bo ON c.point = bo.point AND (c.step = bo.step OR c.step = bo.step - 1) GROUP BY 1, 2),
lk AS (SELECT species, step, points, a AS base, CASE WHEN a + b >= 10 AND a > 0 AND b > 0 AND points >= 5 THEN b / a END AS ratio FROM ab JOIN np USING (step))"""


def bird_rows(spark, sf):
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part").select("p_partkey", "p_brand")
    return li.join(p, li.l_partkey == p.p_partkey).select(
        "p_brand", "l_suppkey", F.year("l_shipdate").alias("year"), "l_quantity"
    )


@query(
    "chain_links",
    "N03 N04",
    f"WITH {BIRDS_SQL}, {LINKS_SQL} SELECT species, CAST(step AS INTEGER) AS step, points, base, round(ratio, 6) AS ratio FROM lk",
)
def chain_links(spark, sf):
    cube = ci.visit_maximum(bird_rows(spark, sf), "p_brand", "l_suppkey", "year", "l_quantity")
    return rounded(ci.links(cube, ci.surveyed_links(cube), None, 10.0, 5)).withColumn("step", F.col("step").cast("int"))


@query(
    "chain_index",
    "N05 N06 N07",
    f"""WITH {BIRDS_SQL}, {LINKS_SQL}, {CHAIN_SQL}
SELECT year, round(exp(avg(ln(idx / 100.0))) * 100.0, 6) AS index, count(*) AS species_used FROM ch JOIN ok USING (species) JOIN st ON st.step = ch.step GROUP BY 1""",
)
def chain_index(spark, sf):
    out = ci.chained_index(bird_rows(spark, sf), "p_brand", "l_suppkey", "year", "l_quantity", 10.0, 5, reps=0)
    return rounded(out["composite_all"])


@query(
    "chain_index_band",
    "B03 N07",
    f"""WITH {BIRDS_SQL}, {LINKS_SQL}, {CHAIN_SQL},
us AS (SELECT species FROM ch GROUP BY 1 HAVING bool_and(idx IS NOT NULL) AND NOT bool_or(coalesce(idx > 1000 OR idx < 10, false))),
e AS (SELECT point, row_number() OVER (ORDER BY md5(CAST(point AS VARCHAR)), point) - 1 AS pos, count(*) OVER () AS n FROM (SELECT DISTINCT point FROM c)),
w AS (SELECT rep, e2.point, count(*) AS wt FROM (SELECT rep, ('0x' || substr(md5('3|' || rep || '|' || pos), 1, 15))::BIGINT % n AS hit FROM e, range(0, 50) t(rep)) d JOIN e e2 ON e2.pos = d.hit GROUP BY 1, 2),
bw AS (SELECT rep, bo.point, bo.step, wt FROM bo JOIN w ON w.point = bo.point),
np2 AS (SELECT rep, step, count(*) AS points FROM bw GROUP BY 1, 2),
ab2 AS (SELECT rep, species, bw.step, sum(CASE WHEN c.step = bw.step - 1 THEN v * wt ELSE 0 END) AS a, sum(CASE WHEN c.step = bw.step THEN v * wt ELSE 0 END) AS b
        FROM c JOIN us USING (species) JOIN bw ON c.point = bw.point AND (c.step = bw.step OR c.step = bw.step - 1) GROUP BY 1, 2, 3),
l2 AS (SELECT rep, species, step, CASE WHEN a + b >= 10 AND a > 0 AND b > 0 AND points >= 5 THEN b / a END AS ratio FROM ab2 JOIN np2 USING (rep, step)),
g2 AS (SELECT rep, species, t.step FROM (SELECT DISTINCT rep, species FROM l2) CROSS JOIN (SELECT step FROM st) t),
c2 AS (SELECT g2.rep, g2.species, g2.step, CASE WHEN sum(CASE WHEN g2.step > 0 AND ratio IS NULL THEN 1 ELSE 0 END) OVER w = 0
       THEN 100.0 * exp(sum(CASE WHEN g2.step > 0 THEN ln(ratio) ELSE 0 END) OVER w) END AS idx
       FROM g2 LEFT JOIN l2 ON l2.rep = g2.rep AND l2.species = g2.species AND l2.step = g2.step
       WINDOW w AS (PARTITION BY g2.rep, g2.species ORDER BY g2.step ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
o2 AS (SELECT rep, species FROM c2 GROUP BY 1, 2 HAVING bool_and(idx IS NOT NULL)),
b2 AS (SELECT rep, step, exp(avg(ln(idx / 100.0))) * 100.0 AS idx FROM c2 JOIN o2 USING (rep, species) GROUP BY 1, 2),
bd AS (SELECT step, quantile_cont(idx, 0.025) AS lo, quantile_cont(idx, 0.975) AS hi FROM b2 GROUP BY 1),
mn AS (SELECT step, exp(avg(ln(idx / 100.0))) * 100.0 AS index, count(*) AS species_used FROM ch JOIN us USING (species) GROUP BY 1)
SELECT year, round(index, 6) AS index, species_used, round(lo, 6) AS lo, round(hi, 6) AS hi FROM mn JOIN bd USING (step) JOIN st USING (step)""",
)
def chain_index_band(spark, sf):
    out = ci.chained_index(bird_rows(spark, sf), "p_brand", "l_suppkey", "year", "l_quantity", 10.0, 5, reps=50, seed=3)
    return rounded(out["composite"])


@query(
    "chain_species",
    "N07",
    f"""WITH {BIRDS_SQL}, {LINKS_SQL}, {CHAIN_SQL}, tot AS (SELECT species, sum(v) AS pairs_total FROM c GROUP BY 1)
SELECT species, true AS chain_ok, bool_or(coalesce(idx > 1000 OR idx < 10, false)) AS extreme, round(arg_max(idx, step), 6) AS last, max(pairs_total) AS pairs_total
FROM ch JOIN ok USING (species) JOIN tot USING (species) GROUP BY 1""",
)
def chain_species(spark, sf):
    out = ci.chained_index(bird_rows(spark, sf), "p_brand", "l_suppkey", "year", "l_quantity", 10.0, 5, reps=0)
    return rounded(out["species"])


@query(
    "trend_variants",
    "C16",
    """WITH y AS (SELECT l_suppkey AS e, CAST(year(l_shipdate) AS INTEGER) AS year, sum(l_quantity) AS v FROM lineitem GROUP BY 1, 2),
core AS (SELECT e FROM y GROUP BY 1 HAVING count(*) >= 7),
s AS (SELECT 'all' AS variant, year, avg(v) AS m FROM y GROUP BY 2 UNION ALL SELECT 'core', year, avg(v) FROM y WHERE e IN (SELECT e FROM core) GROUP BY 2
      UNION ALL SELECT 'recent', year, avg(v) FROM y WHERE year >= 1997 GROUP BY 2),
n AS (SELECT variant, count(*) AS n FROM s GROUP BY 1)
SELECT a.variant, n.n, round(median((b.m - a.m) / (b.year - a.year)), 6) AS slope FROM s a JOIN s b ON a.variant = b.variant AND a.year < b.year JOIN n ON n.variant = a.variant GROUP BY 1, 2""",
)
def trend_variants(spark, sf):
    from tidemark.plans.climate import variant_series

    y = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("entity"), F.year("l_shipdate").alias("year")).agg(F.sum("l_quantity").alias("v"))
    return rounded(rs.theil_sen(variant_series(y, "entity", "year", "v", core_years=7, recent_from=1997), ["variant"], "year", "value"))
