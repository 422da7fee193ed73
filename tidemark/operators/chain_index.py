"""Chained index over species from repeated counts at fixed points.

Zeros are implied: a point surveyed in a year counts 0 for species not recorded there.  They add nothing
to the link sums, so they are never materialised; only the list of surveyed points matters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import attach, join_same
from tidemark.operators.resample import entity_weights
from tidemark.sources.staging import staged

MIN_LINK_COUNT, MIN_POINTS_LINK, MAX_FACTOR = 10.0, 20, 10.0
BOOTSTRAP, SEED = 300, 20260412


def year_steps(df: DataFrame, year: str = "year") -> DataFrame:
    """Observed years numbered 0, 1, 2 … with their count (bounded by the calendar)."""
    w = Window.partitionBy(F.lit(1))
    return df.select(year).distinct().select(
        year,
        (F.row_number().over(w.orderBy(year)) - 1).alias("step"),
        F.count(F.lit(1)).over(w).alias("steps"),
    )


def visit_maximum(df: DataFrame, species: str, point: str, year: str, value: str) -> DataFrame:
    """Largest of repeated visits per species, point and year step."""
    steps = F.broadcast(year_steps(df, year))
    return (
        df.groupBy(species, point, year)
        .agg(F.max(value).alias("v"))
        .join(steps, year)
        .select(F.col(species).alias("species"), F.col(point).alias("point"), F.col(year).alias("year"), "step", "steps", "v")
    )


def surveyed_links(cube: DataFrame) -> DataFrame:
    """``(point, step)``: the point was surveyed in this year step and in the one before."""
    surveyed = cube.select("point", "step").distinct()
    w = Window.partitionBy("point").orderBy("step")
    return surveyed.select("point", "step", F.lag("step").over(w).alias("__p")).where(F.col("__p") == F.col("step") - 1).drop("__p")


def links(
    cube: DataFrame,
    surveyed: DataFrame,
    weights: DataFrame | None = None,
    min_count: float = MIN_LINK_COUNT,
    min_points: int = MIN_POINTS_LINK,
) -> DataFrame:
    """Link ratio per species and year step over points surveyed in both years; null when a gate fails.

    ``surveyed`` comes from :func:`surveyed_links` over all species.  With ``weights(rep, point, weight)`` the same is computed for every replicate.
    """
    rep = ["rep"] if weights is not None else []
    both = surveyed
    if weights is not None:
        both = both.join(weights, "point")
    else:
        both = both.withColumn("weight", F.lit(1))
    n_points = both.groupBy(*rep, "step").agg(F.count(F.lit(1)).alias("points"))
    # a count is the later side of its own step and the earlier side of the next one
    sides = F.array(
        F.struct(F.col("step").alias("step"), F.lit(0.0).alias("a"), F.col("v").cast("double").alias("b")),
        F.struct((F.col("step") + 1).alias("step"), F.col("v").cast("double").alias("a"), F.lit(0.0).alias("b")),
    )
    emitted = cube.select("species", "point", F.explode(sides).alias("x")).select("species", "point", "x.*")
    sums = (
        emitted.join(both, ["point", "step"])
        .groupBy(*rep, "species", "step")
        .agg(F.sum(F.col("weight") * F.col("a")).alias("a"), F.sum(F.col("weight") * F.col("b")).alias("b"))
    )
    gated = sums.join(n_points, [*rep, "step"])
    a, b = F.col("a"), F.col("b")
    ok = (a + b >= min_count) & (a > 0) & (b > 0) & (F.col("points") >= min_points)
    return gated.select(*rep, "species", "step", "points", F.col("a").alias("base"), F.when(ok, b / a).alias("ratio"))


def chain(ratios: DataFrame, steps: DataFrame, keys: Sequence[str] = ("species",)) -> DataFrame:
    """Index 100 in the first year times the running product of ratios; null after the first invalid link."""
    keys = list(keys)
    span = steps.agg(F.max("steps").alias("steps"))
    grid = attach(ratios.select(*keys).distinct(), span).select(
        *keys, "steps", F.explode(F.sequence(F.lit(0), (F.col("steps") - 1).cast("int"))).alias("step")
    )
    full = join_same(grid, ratios.select(*keys, "step", "ratio"), [*keys, "step"], "left")
    w = Window.partitionBy(*keys).orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    broken = F.sum(F.when((F.col("step") > 0) & F.col("ratio").isNull(), 1).otherwise(0)).over(w)
    logs = F.sum(F.when(F.col("step") > 0, F.ln("ratio")).otherwise(F.lit(0.0))).over(w)
    return full.select(*keys, "step", F.when(broken == 0, F.exp(logs) * 100.0).alias("index"))


def species_state(chained: DataFrame, max_factor: float = MAX_FACTOR) -> DataFrame:
    """Per species: is the chain valid in every year, and does the index leave the plausible range?"""
    i = F.col("index")
    return chained.groupBy("species").agg(
        F.bool_and(i.isNotNull()).alias("chain_ok"),
        F.bool_or(F.coalesce((i > 100.0 * max_factor) | (i < 100.0 / max_factor), F.lit(False))).alias("extreme"),
        F.max_by("index", "step").alias("last"),
    )


def composite(chained: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Geometric mean over species whose chain is valid in every year."""
    keys = list(keys)
    valid = chained.groupBy(*keys, "species").agg(F.bool_and(F.col("index").isNotNull()).alias("__ok")).where("__ok")
    rows = join_same(chained, valid, [*keys, "species"])
    return rows.groupBy(*keys, "step").agg(
        (F.exp(F.avg(F.ln(F.col("index") / 100.0))) * 100.0).alias("index"), F.count(F.lit(1)).alias("species_used")
    )


def chained_index(
    df: DataFrame,
    species: str,
    point: str,
    year: str,
    value: str,
    min_count: float = MIN_LINK_COUNT,
    min_points: int = MIN_POINTS_LINK,
    max_factor: float = MAX_FACTOR,
    reps: int = BOOTSTRAP,
    seed: int = SEED,
) -> dict[str, DataFrame]:
    """Composite index with a bootstrap band over points, the species table and the points per link."""
    cube = staged(visit_maximum(df, species, point, year, value))
    steps = staged(cube.select(F.col("year").alias(year), "step", "steps").distinct())
    surveyed = surveyed_links(cube)
    link = links(cube, surveyed, None, min_count, min_points)
    chained = staged(chain(link, steps))
    state = species_state(chained, max_factor)
    used = state.where(F.col("chain_ok") & ~F.col("extreme")).select("species")
    main = composite(chained.join(used, "species", "left_semi"))
    everything = composite(chained)
    out = main
    if reps:
        weights = entity_weights(cube, [], "point", reps, seed)
        boot_links = links(cube.join(used, "species", "left_semi"), surveyed, weights, min_count, min_points)
        boot = composite(chain(boot_links, steps, ["rep", "species"]), ["rep"])
        band = boot.groupBy("step").agg(
            F.percentile("index", F.lit(0.025)).alias("lo"), F.percentile("index", F.lit(0.975)).alias("hi")
        )
        out = main.join(band, "step", "left")
    named = F.broadcast(steps.select("step", F.col(year).alias("year")))
    totals = cube.groupBy("species").agg(F.sum("v").alias("pairs_total"))
    return {
        "composite": out.join(named, "step").drop("step"),
        "composite_all": everything.join(named, "step").drop("step"),
        "species": state.where("chain_ok").join(totals, "species"),
        "points_per_link": link.groupBy("step").agg(F.max("points").alias("points")).join(named, "step").drop("step"),
    }

