"""Aggregates that can be stored as partial results and merged later (incremental ingest)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import attach, distinct_with_null, sum0
from tidemark.functions.quantiles import LINEAR, NEAREST, with_quantiles

#: Last word of a series name -> how its hourly values become a day.
DAY_RULES = ("avg", "min", "max")


def partial_sums(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Sum, rows, negative rows and sum of negatives per key; null keys form their own group."""
    v = F.col(value)
    return df.groupBy(*keys).agg(
        sum0(v).alias(value),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(v < 0).alias("neg_rows"),
        F.coalesce(F.sum(F.when(v < 0, v)), F.lit(0)).alias("neg_sum"),
    )


def merge_sums(parts: Sequence[DataFrame], keys: Sequence[str], value: str) -> DataFrame:
    """Final result of :func:`partial_sums` over stored parts."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return union.groupBy(*keys).agg(
        *[sum0(c).alias(c) for c in (value, "rows", "neg_rows", "neg_sum")]
    )


def partial_range(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows, values, sum, minimum, maximum and negatives per key."""
    v = F.col(value)
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(v).alias("n_value"),
        F.sum(v).alias("v_sum"),
        F.min(v).alias("v_min"),
        F.max(v).alias("v_max"),
        F.count_if(v < 0).alias("n_negative"),
    )


def merge_range(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Final result of :func:`partial_range`: sum of sums, minimum of minima, maximum of maxima."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return union.groupBy(*keys).agg(
        F.sum("rows").alias("rows"),
        F.sum("n_value").alias("n_value"),
        F.sum("v_sum").alias("v_sum"),
        F.min("v_min").alias("v_min"),
        F.max("v_max").alias("v_max"),
        F.sum("n_negative").alias("n_negative"),
    )


def day_value(series: Column, value: Column) -> Column:
    """Mean, minimum or maximum by the last word of the series name; an unknown word fails the job."""
    rule = F.substring_index(series, " ", -1)
    first = F.min(rule)
    bad = F.raise_error(F.concat(F.lit("cannot aggregate series "), F.coalesce(F.min(series), F.lit("null"))))
    return (
        F.when(first == "avg", F.avg(value))
        .when(first == "min", F.min(value))
        .when(first == "max", F.max(value))
        .otherwise(bad.cast("double"))
    )


def daily(
    df: DataFrame,
    entity: str = "jaam_kood",
    series: str = "series",
    ts: str = "timeline_ts_utc",
    value: str = "vaartus",
) -> DataFrame:
    """Hourly rows of all series to UTC days with the number of hours; null values do not count."""
    day = F.to_date(F.substring(F.col(ts).cast("string"), 1, 10))
    return (
        df.where(F.col(value).isNotNull())
        .groupBy(entity, series, day.alias("date"))
        .agg(
            day_value(F.col(series), F.col(value)).alias("value"),
            F.count(F.lit(1)).cast("int").alias("n_hours"),
        )
    )


def summarise_series(
    days: DataFrame, keys: Sequence[str] = ("jaam_kood", "series"), full: int = 24
) -> DataFrame:
    """Coverage and value quantiles per series."""
    v = F.col("value")
    base = days.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("days"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
        F.count_if(F.col("n_hours") == full).alias("full_days"),
        F.min(v).alias("q00"),
        F.max(v).alias("q100"),
        F.count_if(v < 0).alias("n_negative"),
        F.count_if(v == 0).alias("n_zero"),
    )
    probs = {"q05": (0.05, NEAREST), "q50": (0.5, LINEAR), "q95": (0.95, NEAREST)}
    return with_quantiles(base, days, keys, "value", probs)


def gated_mean(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    at_least: int | None = None,
    exactly: int | None = None,
    out: str = "value",
    count: str | None = None,
) -> DataFrame:
    """Mean per key, kept only when the group has enough (or exactly the required) members."""
    g = df.groupBy(*keys).agg(F.avg(value).alias(out), F.count(F.lit(1)).alias("__n"))
    if at_least is not None:
        g = g.where(F.col("__n") >= at_least)
    if exactly is not None:
        g = g.where(F.col("__n") == exactly)
    return g.withColumnRenamed("__n", count) if count else g.drop("__n")


def reconcile(read: DataFrame, expected: DataFrame, key: str = "year") -> DataFrame:
    """Rows expected against rows read per partition key, with a status for every key of either side."""
    j = expected.select(key, "rows_expected").join(read.select(key, "rows_read"), key, "full")
    got, want = F.col("rows_read"), F.col("rows_expected")
    return j.withColumn(
        "status",
        F.when(got.isNull(), "missing")
        .when(want.isNull(), "unexpected")
        .when(got != want, "mismatch")
        .otherwise("ok"),
    )


def expected_years(spark, first: int, last: int, extra: Sequence[int] = ()) -> DataFrame:
    """Wanted years as rows; ``extra`` holds special buckets such as 0 (before the first year)."""
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    if extra:
        more = spark.createDataFrame([(int(y),) for y in extra], "year int")
        years = years.unionByName(more)
    return years


def completeness_report(reconciled: DataFrame, failed: DataFrame | None = None, key: str = "year") -> DataFrame:
    """One row: years present, missing and mismatching, row totals and the ``complete`` flag."""
    st = F.col("status")
    out = reconciled.agg(
        F.count_if(F.col("rows_read").isNotNull()).alias("years_present"),
        F.array_sort(F.collect_list(F.when(st == "missing", F.col(key)))).alias("years_missing"),
        F.array_sort(F.collect_list(F.when(st == "mismatch", F.col(key)))).alias("years_mismatch"),
        F.sum("rows_read").alias("rows_read"),
        F.sum("rows_expected").alias("rows_expected"),
        (F.count_if(st.isin("missing", "mismatch")) == 0).alias("complete"),
    )
    if failed is not None:
        n = failed.agg(F.count(F.lit(1)).alias("failed_parts"))
        out = attach(out, n).withColumn("complete", F.col("complete") & (F.col("failed_parts") == 0))
    return out


def catalogue_of(
    parts: DataFrame, keys: Sequence[str], year: str = "year", distinct: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows, year span and distinct members per key of a stored partial aggregate (null is a member)."""
    return parts.groupBy(*keys).agg(
        F.sum("rows").alias("rows"),
        F.min(year).alias("first_year"),
        F.max(year).alias("last_year"),
        *[distinct_with_null(c).alias(name) for name, c in (distinct or {}).items()],
    )
