"""Ranking operators that do not order an unbounded group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import join_same
from tidemark.sources.staging import staged


def hash_positions(df: DataFrame, ident: str, by: Sequence[str] = (), pos: str = "pos", n: str = "n") -> DataFrame:
    """Dense positions ``0..n-1`` of unique identifiers in md5 order, per group of ``by``.

    A global ``row_number`` would order everything in one task.  The md5 prefix splits a group into up to
    4096 even buckets; a row's position is the bucket's offset plus its place inside the bucket.
    """
    keys = list(by)
    h = df.withColumn("__h", F.md5(F.col(ident).cast("string"))).withColumn("__p", F.substring("__h", 1, 3))
    sizes = h.groupBy(*keys, "__p").agg(F.count(F.lit(1)).alias("__m"))
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    offsets = sizes.select(
        *keys,
        "__p",
        F.sum("__m").over(group).alias(n),
        (F.sum("__m").over(group.orderBy("__p")) - F.col("__m")).alias("__o"),
    )
    place = Window.partitionBy(*keys, "__p").orderBy("__h", ident)
    return (
        join_same(h, offsets, [*keys, "__p"])
        .withColumn(pos, F.col("__o") + F.row_number().over(place) - 1)
        .drop("__h", "__p", "__o")
    )


def value_positions(df: DataFrame, order: Sequence[str], pos: str = "pos", n: str = "n") -> DataFrame:
    """Dense positions ``0..n-1`` of all rows in the order of columns (null first), without ordering them in one task.

    Rows are cut into even ranges of the whole order, so ties of the first column part at the next ones; a row's
    position is the offset of its range plus its place in it.  The ranges are written once, as their edges come from
    samples.  Rows that are equal in all of ``order`` are placed in any order among themselves and stay in one range.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = staged(df.repartitionByRange(ranges, *[F.col(c) for c in order]).withColumn("__part", F.spark_partition_id()))
    sizes = cut.groupBy("__part").agg(F.count(F.lit(1)).alias("__m"))
    # a row per range
    all_ranges = Window.partitionBy(F.lit(1))
    offsets = sizes.select("__part", F.sum("__m").over(all_ranges).alias(n), (F.sum("__m").over(all_ranges.orderBy("__part")) - F.col("__m")).alias("__o"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return cut.withColumn(pos, place).join(F.broadcast(offsets), "__part").withColumn(pos, F.col("__o") + F.col(pos) - 1).drop("__part", "__o")


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """First ``n`` rows per group; Spark trims every partition to ``n`` rows before the shuffle."""
    if not keys and rank is None:
        return df.orderBy(*order).limit(n)
    name = rank or "__rn"
    w = Window.partitionBy(*keys).orderBy(*order) if keys else Window.orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out if rank else out.drop(name)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Last row per key in ``order`` (null sorts first), as a combinable aggregate instead of a window."""
    kept = [k for k in keep if k not in keys]
    best = F.max(F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], F.struct(*kept).alias("row")))
    return df.groupBy(*keys).agg(best.alias("__b")).select(*keys, *[F.col(f"__b.row.{k}").alias(k) for k in kept])


def earliest(df: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """First row per key in ``order``."""
    kept = [k for k in keep if k not in keys]
    best = F.min(F.struct(*[F.col(o).alias(f"o{i}") for i, o in enumerate(order)], F.struct(*kept).alias("row")))
    return df.groupBy(*keys).agg(best.alias("__b")).select(*keys, *[F.col(f"__b.row.{k}").alias(k) for k in kept])
