"""Theil–Sen slopes, rank correlation and bootstrap intervals with hash-derived draws.

Series are annual, monthly or daily values of one entity: their length is bounded by the calendar, so one
series fits in one row as an array.  Replicates are rows, which spreads even a single series over the
cluster.  Bootstrap over entities never gathers entities: every entity emits its own draws.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from tidemark.functions.columns import attach, join_same
from tidemark.functions.draws import draw
from tidemark.functions.quantiles import LINEAR, array_median, with_quantiles
from tidemark.functions.ranks import hash_positions, value_positions
from tidemark.functions.slopes import median_pairwise_slope
from tidemark.sources.staging import staged

REPS = 1000
BLOCK = 3
#: draws of a bootstrap over entities that one task makes or counts, about
TASK_DRAWS = 500_000
NATIONAL_SEED, TREND_SEED, RANK_SEED = 20260205, 7, 11


def as_points(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """One row per series with its ``(x, y)`` points ordered by ``x``; missing values left out."""
    ok = F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(F.col(y).cast("double"))
    pts = F.array_sort(F.collect_list(F.struct(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))))
    return df.where(ok).groupBy(*keys).agg(pts.alias("points")) if keys else df.where(ok).agg(pts.alias("points"))


def slopes(points: Column) -> Column:
    """Slopes of all point pairs with different ``x`` of one (calendar-bounded) series."""
    n = F.size(points)

    def later(p: Column, i: Column) -> Column:
        rest = F.filter(F.slice(points, i + 2, F.greatest(n - i - 1, F.lit(0))), lambda q: q["x"] != p["x"])
        return F.transform(rest, lambda q: (q["y"] - p["y"]) / (q["x"] - p["x"]))

    return F.flatten(F.transform(points, later))


def median_slope(points: Column, min_points: int = 3) -> Column:
    return F.when(F.size(points) >= min_points, array_median(slopes(points)))


def theil_sen(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Median of pairwise slopes per series; fewer than three points give null."""
    return as_points(df, keys, x, y).select(
        *keys, F.size("points").cast("bigint").alias("n"), median_slope(F.col("points")).alias("slope")
    )


def theil_sen_long(df: DataFrame, keys: Sequence[str], x: str, y: str, min_points: int = 3) -> DataFrame:
    """Median of pairwise slopes per series for series of many points: n log n, no list of pairs.

    Returns ``(keys…, n, slope)`` as :func:`theil_sen` does, which holds every pair of a series at once and is meant for
    years and months.  Here a task holds the points of one series, which the calendar bounds (a century of days is 36 525).
    Rows without ``x`` or ``y`` are left out, null keys form a series, fewer than ``min_points`` points or equal ``x``
    only give null, and an empty table gives no rows.
    """
    ok = F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(F.col(x).cast("double")) & ~F.isnan(F.col(y).cast("double"))
    names = [f"__k{i}" for i in range(len(keys))]
    rows = df.where(ok).select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y"))
    out = StructType([rows.schema[n] for n in names] + [StructField("n", LongType()), StructField("slope", DoubleType())])

    def fit(key: tuple, series: pa.Table) -> pa.Table:
        px, py = (series.column(c).to_numpy() for c in ("__x", "__y"))
        slope = median_pairwise_slope(px, py) if len(px) >= min_points else None
        held = {n: pa.array([k.as_py()], k.type) for n, k in zip(names, key)}
        return pa.table(held | {"n": pa.array([len(px)], pa.int64()), "slope": pa.array([slope], pa.float64())})

    found = rows.groupBy(*names).applyInArrow(fit, out)
    return found.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], "n", "slope")


def trend(
    df: DataFrame,
    keys: Sequence[str],
    x: str,
    y: str,
    reps: int = REPS,
    seed: int = TREND_SEED,
    block: int = BLOCK,
    min_points: int = 10,
    per: float = 10.0,
) -> DataFrame:
    """Theil–Sen slope per ``per`` time units with a moving-block bootstrap 95 % interval."""
    series = as_points(df, keys, x, y).withColumn("n", F.size("points").cast("bigint"))
    head = series.select(
        *keys, "n", F.when(F.col("n") >= min_points, per * median_slope(F.col("points"))).alias("slope_per_decade")
    )
    n, blocks = F.col("n"), F.ceil(F.col("n") / block)
    samples = (
        series.where(n >= min_points)
        .withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))))
        .repartition(*keys, "rep")
        .withColumn(
            "sample",
            F.slice(
                F.flatten(
                    F.transform(
                        F.sequence(F.lit(0).cast("bigint"), blocks - 1),
                        lambda b: F.slice(
                            F.col("points"),
                            (draw(seed, F.col("rep"), b, n - block + 1) + 1).cast("int"),
                            F.lit(block),
                        ),
                    )
                ),
                F.lit(1),
                n.cast("int"),
            ),
        )
        .select(*keys, "rep", "sample")
    )
    reps_slopes = samples.select(*keys, (per * median_slope(F.col("sample"))).alias("s"))
    # one value per replicate: bounded by ``reps``
    band = [F.percentile("s", F.lit(0.025)).alias("lo"), F.percentile("s", F.lit(0.975)).alias("hi")]
    if not keys:
        return attach(head, reps_slopes.agg(*band))
    return join_same(head, reps_slopes.groupBy(*keys).agg(*band), keys, "left")


def _placed(df: DataFrame, by: Sequence[str], entity: str) -> DataFrame:
    """Positions of the entities, written once: the draws and what is drawn both read them."""
    return staged(hash_positions(df.select(*by, entity).distinct(), entity, by))


def _drawn(placed: DataFrame, by: Sequence[str], reps: int, seed: int) -> DataFrame:
    """``(by…, rep, pos, weight)``: how often each position is drawn in each replicate.

    The few bytes of an entity become ``reps`` draws, which the planner does not foresee: tasks are numbered by draws,
    ``TASK_DRAWS`` each, when positions are dealt and again when draws are counted.
    """
    tasks = max(int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-placed.count() * reps // TASK_DRAWS))
    return (
        placed.select(*by, "pos", "n")
        .repartition(tasks, *by, "pos")
        .withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))))
        .select(*by, "rep", draw(seed, "rep", "pos", "n").alias("pos"))
        .repartition(tasks, *by, "pos")
        .groupBy(*by, "rep", "pos")
        .agg(F.count(F.lit(1)).alias("weight"))
    )


def _at_positions(drawn: DataFrame, rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Draws with the rows at their positions; without ``by`` the draws stay in the tasks that counted them."""
    return join_same(drawn, rows, [*by, "pos"]) if by else drawn.join(rows.hint("merge"), "pos")


def entity_weights(df: DataFrame, by: Sequence[str], entity: str, reps: int, seed: int) -> DataFrame:
    """``(by…, rep, entity, weight)``: how often each entity is drawn in each replicate.

    Position ``p`` emits draw number ``p`` of every replicate, so draws are spread like the entities and are
    counted by the position they hit; nothing grows with the square of the number of entities.
    """
    placed = _placed(df, by, entity)
    return _at_positions(_drawn(placed, by, reps, seed), placed.select(*by, "pos", entity), by).select(*by, "rep", "weight", entity)


def entity_bootstrap(
    df: DataFrame, by: Sequence[str], entity: str, period: str, value: str, reps: int = REPS, seed: int = NATIONAL_SEED
) -> DataFrame:
    """95 % interval of the mean over entities per period, entities resampled as a whole."""
    rows = df.where(F.col(value).isNotNull())
    placed = _placed(rows, by, entity)
    # rows go to their entity's position, so that the draws, which are many more, are not dealt again by entity
    own = join_same(rows.select(*by, entity, period, value), placed.select(*by, entity, "pos"), [*by, entity])
    means = (
        _at_positions(_drawn(placed, by, reps, seed), own.select(*by, "pos", period, value), by)
        .groupBy(*by, period, "rep")
        .agg((F.sum(F.col("weight") * F.col(value)) / F.sum("weight")).alias("m"))
    )
    # one mean per replicate: bounded by ``reps``
    return means.groupBy(*by, period).agg(
        F.percentile("m", F.lit(0.025)).alias("lo"), F.percentile("m", F.lit(0.975)).alias("hi")
    )


def national_series(
    df: DataFrame,
    entity: str,
    period: str,
    value: str,
    by: Sequence[str] = (),
    min_entities: int = 5,
    reps: int = REPS,
    seed: int = NATIONAL_SEED,
) -> DataFrame:
    """Unweighted mean over entities per period with its bootstrap interval and the spread between entities.

    Periods with fewer than ``min_entities`` entities keep their count but no value.
    """
    rows = df.where(F.col(value).isNotNull())
    keys = [*by, period]
    base = rows.groupBy(*keys).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"))
    out = with_quantiles(base, rows, keys, value, {"p10": (0.1, LINEAR), "p90": (0.9, LINEAR)})
    if reps:
        out = join_same(out, entity_bootstrap(rows, by, entity, period, value, reps, seed), keys, "left")
    cols = [c for c in ("mean", "lo", "hi", "p10", "p90") if c in out.columns]
    return out.select(*keys, *[F.when(F.col("n") >= min_entities, F.col(c)).alias(c) for c in cols], "n")


def _rank_corr(df: DataFrame, keys: Sequence[str], x: str, y: str, tie: str) -> DataFrame:
    w = Window.partitionBy(*keys)
    ranked = df.select(
        *keys,
        F.row_number().over(w.orderBy(x, tie)).alias("rx"),
        F.row_number().over(w.orderBy(y, tie)).alias("ry"),
    )
    return _corr_of_ranks(ranked, keys)


def _corr_of_ranks(ranked: DataFrame, keys: Sequence[str]) -> DataFrame:
    return ranked.groupBy(*keys).agg(
        F.corr(F.col("rx").cast("double"), F.col("ry").cast("double")).alias("rho"), F.count(F.lit(1)).alias("n")
    )


def spearman(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    x: str,
    y: str,
    reps: int = 2000,
    seed: int = RANK_SEED,
    min_points: int = 6,
) -> DataFrame:
    """Rank correlation (ordinal ranks, ties by position) per series with a pairs bootstrap interval.

    ``position`` orders the pairs of one series (a year or month), which bounds a group by the calendar.  Without keys
    the whole table is one series of any length, whose ranks come from ranges of values.
    """
    keys = list(keys)
    whole = not keys
    ok = F.col(x).isNotNull() & F.col(y).isNotNull()
    values = [F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")]
    if whole:
        keys = ["__one"]
        placed = value_positions(df.where(ok).select(F.lit(1).alias("__one"), F.col(position).alias("__at"), *values), ["__at"], "i")
        pairs = staged(placed.drop("__at"))
        ranked = value_positions(value_positions(pairs, ["x", "i"], "rx", "__n").drop("__n"), ["y", "i"], "ry", "__n")
        head = _corr_of_ranks(ranked, keys)
    else:
        w = Window.partitionBy(*keys)
        number = (F.row_number().over(w.orderBy(position)) - 1).cast("bigint").alias("i")
        pairs = df.where(ok).select(*keys, number, F.count(F.lit(1)).over(w).alias("n"), *values)
        head = _rank_corr(pairs, keys, "x", "y", "i")
    head = head.withColumn("rho", F.when(F.col("n") >= min_points, F.col("rho")))
    if reps:
        draws = (
            pairs.where(F.col("n") >= min_points)
            .select(*keys, "i", "n", F.explode(F.sequence(F.lit(0), F.lit(reps - 1))).alias("rep"))
            .withColumn("__hit", draw(seed, "rep", "i", "n"))
            .select(*keys, "rep", F.col("i").alias("at"), F.col("__hit").alias("i"))
        )
        boot = _rank_corr(
            join_same(draws, pairs.drop("n"), [*keys, "i"]), [*keys, "rep"], "x", "y", "at"
        )
        band = boot.groupBy(*keys).agg(
            F.percentile("rho", F.lit(0.025)).alias("lo"), F.percentile("rho", F.lit(0.975)).alias("hi")
        )
        head = join_same(head, band, keys, "left")
    return head.drop("__one") if whole else head
