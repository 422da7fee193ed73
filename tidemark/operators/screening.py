"""Unit conversion and rule-based screening.  Each operator returns what it keeps and what it left out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import any_of, col, join_same, lookup
from tidemark.functions.quantiles import LINEAR, NEAREST, group_quantiles


def flagged(df: DataFrame, keys: Sequence[str], flags: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows without any flag, and per key how many rows each rule dropped (keys with drops only)."""
    marked = df.select("*", *[F.coalesce(c, F.lit(False)).alias(f"__{n}") for n, c in flags.items()])
    names = [f"__{n}" for n in flags]
    report = (
        marked.groupBy(*keys)
        .agg(*[F.count_if(f"__{n}").alias(n) for n in flags], F.count(F.lit(1)).alias("n"))
        .where(sum((F.col(n) for n in flags), F.lit(0)) > 0)
    )
    return marked.where(~any_of(F.col(n) for n in names)).drop(*names), report


def screen_series(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    is_flow: Column,
    spike_factor: float = 15.0,
    valid_range: tuple[float, float] = (-1.0, 35.0),
) -> tuple[DataFrame, DataFrame]:
    """Flows: negatives and values far above the series' own 95th percentile; other series: a fixed range."""
    v = F.col(value)
    q95 = group_quantiles(df.where(is_flow & (v >= 0)), keys, value, {"__q95": (0.95, NEAREST)})
    joined = join_same(df, q95, keys, "left")
    kept, report = flagged(
        joined,
        keys,
        {
            "negative": is_flow & (v < 0),
            "spike": is_flow & (F.col("__q95") > 0) & (v > spike_factor * F.col("__q95")),
            "out_of_range": ~is_flow & ((v < valid_range[0]) | (v > valid_range[1])),
        },
    )
    return kept.drop("__q95"), report


def convert_units(
    df: DataFrame, value: str, unit: str, factors: Mapping[str, float], out: str = "amount"
) -> tuple[DataFrame, DataFrame]:
    """Value times the unit's factor; rows with an unknown unit are dropped and counted per unit."""
    d = df.withColumn(out, F.col(value).cast("double") * lookup(unit, factors))
    dropped = d.where(F.col(out).isNull()).groupBy(unit).agg(F.count(F.lit(1)).alias("rows_unknown_unit"))
    return d.where(F.col(out).isNotNull()), dropped


def target_unit_only(
    df: DataFrame, indicator: str, value: str, unit: str, targets: Mapping[str, str], out: str = "v"
) -> tuple[DataFrame, DataFrame]:
    """Rows in the indicator's own unit with a non-negative value; other rows counted by reason."""
    ok_unit = F.col(unit) == lookup(indicator, targets)
    d = df.withColumn(out, F.when(ok_unit, F.col(value)))
    left_out = d.groupBy(indicator).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(out).isNull()).alias("other_unit"),
        F.count_if(F.col(out) < 0).alias("negative_or_sentinel"),
    )
    return d.where(F.col(out) >= 0), left_out


def ratio_outliers(
    df: DataFrame,
    keys: Sequence[str],
    numerator: str,
    denominator: str,
    low: float = 0.1,
    high: float = 10.0,
) -> tuple[DataFrame, DataFrame]:
    """Flag rows whose ratio is far from their group's median ratio, or that lack a denominator.

    Returns all rows with ``ratio``, ``med_ratio``, ``no_base`` and ``off_ratio``, and the clean rows.
    """
    num, den = F.col(numerator), F.col(denominator)
    d = df.withColumn("ratio", F.when(den > 0, num / den))
    med = group_quantiles(d.where((num > 0) & F.col("ratio").isNotNull()), keys, "ratio", {"med_ratio": (0.5, LINEAR)})
    r, m = F.col("ratio"), F.col("med_ratio")
    marked = join_plain(d, med, keys).withColumns(
        {
            "no_base": F.coalesce((num > 0) & ~F.coalesce(den > 0, F.lit(False)), F.lit(False)),
            "off_ratio": F.coalesce((num > 0) & ((r > high * m) | (r < low * m)), F.lit(False)),
        }
    )
    return marked, marked.where(~(F.col("no_base") | F.col("off_ratio")))


def join_plain(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join where null keys never match."""
    return left.join(right, list(keys), "left")


def in_range(df: DataFrame, value: str, low: float, high: float, out: str = "v") -> tuple[DataFrame, DataFrame]:
    """Rows inside a closed range, and the number left out."""
    ok = F.col(value).between(low, high)
    left_out = df.agg(F.count_if(~F.coalesce(ok, F.lit(False))).alias("out_of_range"))
    return df.where(ok).withColumn(out, col(value)), left_out
