"""Normals, anomalies, seasons, completeness gates and threshold indices of station series.

Series stay in long form ``(by…, entity, period, value)``; ``by`` columns (variable, season) let one job
handle every variable at once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import attach, ratio, season, season_year
from tidemark.functions.quantiles import LINEAR, NEAREST, with_quantiles
from tidemark.functions.ranks import top_rows
from tidemark.operators.mergeable import gated_mean


@dataclass(frozen=True)
class Names:
    """Column names of a station series."""

    entity: str = "jaam_kood"
    year: str = "aasta"
    month: str = "kuu"
    value: str = "vaartus"
    by: tuple[str, ...] = ()

    @property
    def keys(self) -> list[str]:
        return [*self.by, self.entity]


BASELINE = (1991, 2020)
MIN_NORMAL_YEARS = 25
MIN_STATIONS = 5
MIN_DAYS_PER_YEAR = 355


def monthly_normals(
    df: DataFrame, names: Names = Names(), base: tuple[int, int] = BASELINE, min_years: int = MIN_NORMAL_YEARS
) -> DataFrame:
    """Mean and number of years per entity and calendar month over the baseline, with a minimum of years."""
    rows = df.where(F.col(names.year).between(*base) & F.col(names.value).isNotNull())
    return gated_mean(rows, [*names.keys, names.month], names.value, min_years, out="normal", count="n_years")


def anomalies(df: DataFrame, normals: DataFrame, kind: str = "diff", names: Names = Names()) -> DataFrame:
    """Value minus normal (``diff``) or 100 × value / normal where the normal is positive (``ratio``)."""
    if kind not in ("diff", "ratio"):
        raise ValueError(f"unknown anomaly kind: {kind}")
    joined = df.where(F.col(names.value).isNotNull()).join(normals, [*names.keys, names.month])
    if kind == "diff":
        return joined.withColumn("anom", F.col(names.value) - F.col("normal"))
    return joined.where(F.col("normal") > 0).withColumn("anom", F.lit(100.0) * F.col(names.value) / F.col("normal"))


def with_season(df: DataFrame, names: Names = Names()) -> DataFrame:
    return df.withColumns({"season": season(names.month), "season_year": season_year(names.year, names.month)})


def complete_periods(anom: DataFrame, period: Sequence[str], n_required: int, names: Names = Names()) -> DataFrame:
    """Mean anomaly per entity and period where exactly ``n_required`` members are present."""
    return gated_mean(anom, [*names.keys, *period], "anom", exactly=n_required, out="anom")


def period_ratio(
    df: DataFrame, normals: DataFrame, period: Sequence[str], n_required: int, names: Names = Names()
) -> DataFrame:
    """Total of a complete period as % of its normal total (ratio of sums, not mean of ratios)."""
    joined = df.where(F.col(names.value).isNotNull()).join(normals, [*names.keys, names.month])
    g = joined.groupBy(*names.keys, *period).agg(
        F.sum(names.value).alias("total"), F.sum("normal").alias("norm"), F.count(F.lit(1)).alias("__n")
    )
    return g.where((F.col("__n") == n_required) & (F.col("norm") > 0)).select(
        *names.keys, *period, (F.lit(100.0) * F.col("total") / F.col("norm")).alias("anom")
    )


def matrix(df: DataFrame, period: str, periods: Sequence[int], names: Names = Names(), value: str = "anom") -> DataFrame:
    """Entity × period pivot for the edge of the system; missing cells are null."""
    return df.groupBy(*names.keys).pivot(period, list(periods)).agg(F.first(value))


def completeness(df: DataFrame, names: Names = Names()) -> DataFrame:
    rows = df.where(F.col(names.value).isNotNull())
    return rows.groupBy(*names.keys, names.year).agg(F.count(F.lit(1)).alias("months"))


def top_periods(df: DataFrame, period: str, value: str, top: int = 5, by: Sequence[str] = ()) -> DataFrame:
    """The periods with the highest values."""
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return top_rows(rows, by, [F.desc(value), F.asc(period)], top, "rank" if by else None)


#: Index name -> (input, comparison, threshold); Rx1day is the largest value.
DAY_INDICES: Mapping[str, tuple[str, str, float]] = {
    "ID": ("tmax", "<", 0.0),
    "SU25": ("tmax", ">=", 25.0),
    "HD30": ("tmax", ">=", 30.0),
    "FD": ("tmin", "<", 0.0),
    "TR20": ("tmin", ">=", 20.0),
    "R10": ("prec", ">=", 10.0),
    "R20": ("prec", ">=", 20.0),
}


def day_indices(
    days: DataFrame,
    names: Names = Names(),
    variable: str = "variable",
    indices: Mapping[str, tuple[str, str, float]] = DAY_INDICES,
    maximum: Mapping[str, str] | None = None,
    min_days: int = MIN_DAYS_PER_YEAR,
) -> DataFrame:
    """Threshold day counts per entity and year from one long table ``(entity, year, variable, value)``.

    Each variable must have ``min_days`` days in the year for its own indices; one pass counts all of
    them, so the full outer alignment of the inputs needs no join.
    """
    maximum = {"Rx1day": "prec"} if maximum is None else maximum
    v, var = F.col(names.value), F.col(variable)
    used = sorted({x[0] for x in indices.values()} | set(maximum.values()))

    def hit(src: str, op: str, lim: float) -> Column:
        return (var == src) & ((v < lim) if op == "<" else (v >= lim))

    g = (
        days.where(v.isNotNull() & var.isin(used))
        .groupBy(*names.keys, names.year)
        .agg(
            *[F.count_if(var == u).alias(f"__n_{u}") for u in used],
            *[F.count_if(hit(*spec)).alias(name) for name, spec in indices.items()],
            *[F.max(F.when(var == src, v)).alias(name) for name, src in maximum.items()],
        )
    )
    source = {**{k: s[0] for k, s in indices.items()}, **maximum}
    gated = g.where(F.greatest(*[F.col(f"__n_{u}") for u in used], F.lit(0)) >= min_days)
    return gated.select(
        *names.keys,
        names.year,
        *[F.when(F.col(f"__n_{src}") >= min_days, F.col(name)).alias(name) for name, src in source.items()],
    )


def stack_inputs(inputs: Mapping[str, DataFrame], variable: str = "variable") -> DataFrame:
    """Separate input frames as one long table with a ``variable`` column."""
    out = None
    for name, df in inputs.items():
        part = df.withColumn(variable, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def index_series(
    idx: DataFrame, columns: Sequence[str], year: str = "aasta", min_stations: int = MIN_STATIONS
) -> DataFrame:
    """Across-station summary per index and year, for all indices in one pass."""
    long = idx.select(year, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot([year], list(columns), "index", "value")
    long = long.where(F.col("value").isNotNull())
    base = (
        long.groupBy("index", year)
        .agg(
            F.avg("value").alias("mean"),
            F.avg((F.col("value") > 0).cast("double")).alias("share_any"),
            F.count(F.lit(1)).alias("n"),
        )
        .where(F.col("n") >= min_stations)
    )
    probs = {"median": (0.5, LINEAR), "q10": (0.1, NEAREST), "q90": (0.9, NEAREST)}
    return with_quantiles(base, long, ["index", year], "value", probs)


def period_means(
    df: DataFrame, year: str, value: str, periods: Sequence[tuple[int, int]], by: Sequence[str] = ()
) -> DataFrame:
    """Mean and number of years per fixed period; a period without years stays with null.

    The period table is a constant, so a year is expanded to its periods in place and the empty ones come
    from the same constant: no range join.
    """
    table = F.array(*[F.struct(F.lit(a).alias("from"), F.lit(b).alias("to")) for a, b in periods])
    y = F.col(year)
    inside = F.transform(table, lambda p: F.struct(p["from"].alias("from"), p["to"].alias("to"), y.between(p["from"], p["to"]).alias("hit")))
    rows = df.select(*by, F.explode(inside).alias("p"), F.col(value).alias("__v"))
    hit = F.col("p.hit") & F.col("__v").isNotNull()
    return rows.groupBy(*by, F.col("p.from").alias("from"), F.col("p.to").alias("to")).agg(
        F.count_if(hit).alias("n_years"), F.avg(F.when(hit, F.col("__v"))).alias("mean")
    )


def consistency_check(
    published: DataFrame, days: DataFrame, keys: Sequence[str], value: str = "vaartus", min_days: int = 28
) -> DataFrame:
    """Published monthly value against the mean of its daily values: n, largest and median difference."""
    own = gated_mean(days.where(F.col(value).isNotNull()), keys, value, min_days, out="__own")
    diff = published.where(F.col(value).isNotNull()).join(own, list(keys)).select(F.abs(F.col(value) - F.col("__own")).alias("d"))
    base = diff.agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("max_abs_diff"))
    return with_quantiles(base, diff, [], "d", {"median_abs_diff": (0.5, LINEAR)})


def month_grid(anom: DataFrame, names: Names = Names(), min_stations: int = MIN_STATIONS) -> DataFrame:
    """Mean anomaly per year and month over at least ``min_stations`` entities."""
    return (
        anom.groupBy(*names.by, names.year, names.month)
        .agg(F.avg("anom").alias("mean"), F.count_distinct(names.entity).alias("n"))
        .where(F.col("n") >= min_stations)
    )


def index_to_base(df: DataFrame, series: str, year: str, value: str, base: int) -> DataFrame:
    """Series indexed to a base year (= 100); series without that year are left out."""
    b = df.where((F.col(year) == base) & (F.col(value) != 0)).select(series, F.col(value).alias("__b"))
    return df.where(F.col(value).isNotNull()).join(b, series).withColumn("index", F.lit(100.0) * ratio(value, "__b")).drop("__b")


def index_to_first_common(
    df: DataFrame, series: str, year: str, value: str, required: Sequence[str]
) -> DataFrame:
    """Series indexed to the first year in which all ``required`` series have a value, on common years."""
    rows = df.where(F.col(value).isNotNull())
    common = (
        rows.where(F.col(series).isin(*required))
        .groupBy(year)
        .agg(F.count_distinct(series).alias("k"))
        .where(F.col("k") == len(required))
        .select(year)
    )
    first = common.agg(F.min(year).alias("base_year"))
    aligned = rows.join(common, year, "left_semi")
    base = (
        attach(aligned, first)
        .where((F.col(year) == F.col("base_year")) & (F.col(value) != 0))
        .select(series, "base_year", F.col(value).alias("__b"))
    )
    return aligned.join(base, series).withColumn("index", F.lit(100.0) * ratio(value, "__b")).drop("__b")
