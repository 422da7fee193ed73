"""Daily flow and water temperature: valid days, regimes, runoff, exceedance curves and extremes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import attach, join_same, ratio
from tidemark.functions.quantiles import LINEAR, NEAREST, bounded_nearest, group_quantiles, with_quantiles
from tidemark.operators.mergeable import gated_mean

MIN_HOURS, MIN_DAYS_MONTH, MIN_DAYS_YEAR, MIN_DAYS_SUMMER = 20, 25, 350, 80
SECONDS_PER_YEAR = 365.25 * 86400
#: Percent of time a flow is exceeded.
EXCEEDANCE = (0.5, 1, 2, 5, 10, 20, 30, 40, 50, 60, 70, 80, 90, 95, 98, 99, 99.5)


def valid_days(df: DataFrame, series: str | None = None, min_hours: int = MIN_HOURS) -> DataFrame:
    """Days with enough hours and a value, with year and month."""
    ok = (F.col("n_hours") >= min_hours) & F.col("value").isNotNull()
    if series is not None:
        ok = ok & (F.col("series") == series)
    return df.where(ok).withColumns({"year": F.year("date"), "month": F.month("date")})


def monthly_means(q: DataFrame, entity: str = "jaam_kood", min_days: int = MIN_DAYS_MONTH) -> DataFrame:
    return gated_mean(q, [entity, "year", "month"], "value", min_days)


def regime(
    monthly: DataFrame, current_year: int | Column | None = None, entity: str = "jaam_kood"
) -> DataFrame:
    """Per entity and calendar month: nearest-rank q10 and q90 and median over past years, and the current year.

    A group holds one value per year, so it is bounded by the calendar.
    """
    if current_year is None:
        last = monthly.agg(F.max("year").alias("__cy"))
        monthly = attach(monthly, last)
    else:
        monthly = monthly.withColumn("__cy", F.lit(current_year) if isinstance(current_year, int) else current_year)
    past = F.when(F.col("year") < F.col("__cy"), F.col("value"))
    return monthly.groupBy(entity, "month").agg(
        bounded_nearest(past, 0.1).alias("q10"),
        F.median(past).alias("median"),
        bounded_nearest(past, 0.9).alias("q90"),
        F.count(past).alias("n_years"),
        F.max(F.when(F.col("year") == F.col("__cy"), F.col("value"))).alias("current"),
    )


def annual_runoff(q: DataFrame, area: DataFrame, entity: str = "jaam_kood", min_days: int = MIN_DAYS_YEAR) -> DataFrame:
    """Annual mean flow, specific discharge (l/s/km²) and runoff depth (mm) using ``area(entity, area)``."""
    g = gated_mean(q, [entity, "year"], "value", min_days, out="q_mean", count="n_days")
    a = area.select(entity, F.when(F.col("area") != 0, F.col("area")).alias("area"))
    return g.join(a, entity, "left").withColumns(
        {
            "specific_ls_km2": F.col("q_mean") * 1000 / F.col("area"),
            "runoff_mm": F.col("q_mean") * SECONDS_PER_YEAR / (F.col("area") * 1000),
        }
    )


def percent_of_own_mean(
    annual: DataFrame, entity: str, year: str = "year", value: str = "runoff_mm", min_entities: int = 5
) -> DataFrame:
    """Per year: mean and spread over entities of the value as % of the entity's own mean."""
    own = annual.where(F.col(value).isNotNull())
    means = own.groupBy(entity).agg(F.avg(value).alias("__m"))
    pct = own.join(means, entity).select(year, (F.lit(100.0) * ratio(value, "__m")).alias("pct"))
    base = pct.groupBy(year).agg(F.avg("pct").alias("pct_of_mean"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_entities)
    return with_quantiles(base, pct, [year], "pct", {"p10": (0.1, NEAREST), "p90": (0.9, NEAREST)})


def flow_duration(
    q: DataFrame,
    area: DataFrame | None = None,
    keys: Sequence[str] = ("jaam_kood",),
    value: str = "value",
    exceedance: Sequence[float] = EXCEEDANCE,
    min_days: int = 3 * 365,
) -> DataFrame:
    """Exceedance curve in long form ``(keys…, p, value, n_days)``; specific discharge with ``area``."""
    keys = list(keys)
    enough = q.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_days")).where(F.col("n_days") >= min_days)
    probs = {f"e{i}": ((100 - p) / 100, LINEAR) for i, p in enumerate(exceedance)}
    wide = join_same(enough, group_quantiles(q, keys, value, probs), keys)
    points = F.array(*[F.struct(F.lit(float(p)).alias("p"), F.col(f"e{i}").alias("value")) for i, p in enumerate(exceedance)])
    long = wide.select(*keys, "n_days", F.explode(points).alias("x")).select(*keys, "n_days", "x.*")
    if area is None:
        return long
    a = area.where(F.col("area") > 0).select(keys[0], "area")
    return long.join(a, keys[0]).withColumn("value", F.col("value") * 1000 / F.col("area")).drop("area")


def rolling_minimum(
    days: DataFrame, keys: Sequence[str], order: str, value: str, width: int = 7, out: str = "q7min"
) -> DataFrame:
    """Lowest mean of ``width`` consecutive rows per key (a year of days, so bounded by the calendar)."""
    w = Window.partitionBy(*keys).orderBy(order)
    rolled = days.select(
        *keys,
        F.avg(value).over(w.rowsBetween(1 - width, 0)).alias("__m"),
        F.row_number().over(w).alias("__i"),
    )
    return rolled.where(F.col("__i") >= width).groupBy(*keys).agg(F.min("__m").alias(out))


def annual_extremes(
    q_avg: DataFrame, q_max: DataFrame, entity: str = "jaam_kood", min_days: int = MIN_DAYS_YEAR
) -> DataFrame:
    """Annual peak and lowest 7-day mean for years with enough valid days of the daily mean series."""
    keys = [entity, "year"]
    full = q_avg.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= min_days).drop("__n")
    peaks = q_max.groupBy(*keys).agg(F.max("value").alias("peak"))
    return full.join(peaks, keys, "left").join(rolling_minimum(q_avg, keys, "date", "value"), keys, "left")


def water_temperature(
    wt: DataFrame, entity: str = "jaam_kood", min_days: int = MIN_DAYS_YEAR, min_summer: int = MIN_DAYS_SUMMER
) -> DataFrame:
    """Annual and June–August mean in one pass; a summer without enough days is null."""
    summer = F.when(F.col("month").between(6, 8), F.col("value"))
    n_summer = F.count(summer)
    g = wt.groupBy(entity, "year").agg(
        F.avg("value").alias("annual_mean"),
        F.count(F.lit(1)).alias("n_days"),
        F.when(n_summer >= min_summer, F.avg(summer)).alias("summer_mean"),
        F.when(n_summer >= min_summer, n_summer).alias("n_summer"),
    )
    return g.where(F.col("n_days") >= min_days)


def coverage(q: DataFrame, entity: str = "jaam_kood", year_days: float = 365.25) -> DataFrame:
    """Valid days per entity and year, and their share of a year between 0 and 1."""
    g = q.groupBy(entity, "year").agg(F.count(F.lit(1)).alias("valid"))
    return g.withColumn("share", F.least(F.greatest(F.col("valid") / year_days, F.lit(0.0)), F.lit(1.0)))


def plausibility(df: DataFrame, value: str) -> DataFrame:
    """Median and range of a derived value: an order-of-magnitude check of its unit."""
    rows = df.where(F.col(value).isNotNull())
    base = rows.agg(F.round(F.min(value), 2).alias("min"), F.round(F.max(value), 2).alias("max"))
    return with_quantiles(base, rows, [], value, {"median": (0.5, LINEAR)}).withColumn("median", F.round("median", 2))


def link_series(
    left: DataFrame, right: DataFrame, year: str, x: str, y: str, min_years: int = 6, reps: int = 2000
) -> tuple[DataFrame, DataFrame]:
    """Two yearly series on their common years, and their rank correlation (none below ``min_years``)."""
    from tidemark.operators.resample import spearman

    both = left.select(year, x).join(right.select(year, y), year).where(F.col(x).isNotNull() & F.col(y).isNotNull())
    aligned = attach(both, both.agg(F.count(F.lit(1)).alias("__n"))).where(F.col("__n") >= min_years).drop("__n")
    return aligned, spearman(aligned, [], year, x, y, reps=reps, min_points=min_years)


def columns_by_entity(df: DataFrame, entity: str, year: str, cols: Sequence[str], digits: int = 3) -> DataFrame:
    """Per entity one ordered array of yearly records (bounded by the calendar)."""
    rec = F.struct(F.col(year), *[F.round(F.col(c), digits).alias(c) for c in cols])
    return df.groupBy(entity).agg(F.array_sort(F.collect_list(rec)).alias("series"))


def summer_anomaly(temp: DataFrame, entity: str = "jaam_kood", value: str = "summer_mean", min_years: int = 5) -> DataFrame:
    """Yearly value minus the entity's own mean, for entities with enough years."""
    rows = temp.where(F.col(value).isNotNull())
    own = rows.groupBy(entity).agg(F.avg(value).alias("__m"), F.count(F.lit(1)).alias("__n")).where(F.col("__n") >= min_years)
    return rows.join(own, entity).select(entity, "year", (F.col(value) - F.col("__m")).alias("anomaly"))


def specific_regime(regime_df: DataFrame, area: DataFrame, entity: str = "jaam_kood") -> DataFrame:
    """Monthly median as specific discharge, with the area for ordering."""
    a = area.where(F.col("area") > 0)
    return regime_df.join(a, entity).select(entity, "area", "month", (F.col("median") * 1000 / F.col("area")).alias("specific"))
