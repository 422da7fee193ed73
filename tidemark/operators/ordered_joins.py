"""Joins by order: the latest earlier row (as-of join) and membership in intervals (range join), without nested loops."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import attach, join_same

#: open ends of intervals, and the widest level of cells
FAR, LEVELS = 1 << 60, 62


def _number(df: DataFrame, name: str) -> Column:
    """A day, time or number as a long that keeps its order (rounded down)."""
    kind = df.schema[name].dataType.simpleString()
    c = F.col(name)
    if kind == "date":
        return F.unix_date(c).cast("bigint")
    if kind.startswith("timestamp"):
        return F.unix_micros(c.cast("timestamp"))
    return F.floor(c).cast("bigint")


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    at: str,
    right_at: str,
    keep: Sequence[str],
    tolerance: float | None = None,
    strict: bool = False,
    cells: int = 1024,
) -> DataFrame:
    """Rows of ``left`` with ``right_at`` and ``keep`` of the latest row of ``right`` at or before ``at`` (``strict``: before).

    Of right rows at one time the one with the greatest ``keep`` counts.  Beyond ``tolerance`` (days for dates, microseconds
    for timestamps, else the column's unit) there is no match.  Rows of ``left`` are kept once each; without a match, a key
    or a time their new columns are null.  Names of ``keep`` must not occur in ``left``.

    Both sides are put in one order by key and cell of time, ``cells`` equal cells over the whole range, so a key with
    very many rows is ordered cell by cell; what a cell hands on to the next ones is one row, and a key has ``cells`` of
    those at most.
    """
    keys, kept = list(keys), [right_at, *keep]
    rows = left.withColumns({"__t": _number(left, at), "__left": F.lit(True)})
    seen = right.where(F.col(right_at).isNotNull())
    for k in keys:
        seen = seen.where(F.col(k).isNotNull())
    seen = seen.select(*keys, _number(right, right_at).alias("__t"), F.struct(*[F.col(c).alias(f"f{i}") for i, c in enumerate(kept)]).alias("__r"), F.lit(False).alias("__left"))
    both = rows.unionByName(seen, allowMissingColumns=True)
    bounds = rows.select("__t").unionByName(seen.select("__t")).agg(F.min("__t").alias("__lo"), F.max("__t").alias("__hi"))
    cell = F.expr(f"coalesce(cast(floor((cast(__t as double) - __lo) / (cast(__hi as double) - __lo + 1) * {cells}) as int), -1)")
    both = attach(both, bounds).withColumn("__cell", cell).drop("__lo", "__hi")
    # at one time right rows come first, or last where only earlier ones count
    turn = F.col("__left") if not strict else ~F.col("__left")
    inside = Window.partitionBy(*keys, "__cell").orderBy("__t", turn, "__r").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("__in", F.last("__r", ignorenulls=True).over(inside)).where("__left")
    before = Window.partitionBy(*keys).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    ends = both.groupBy(*keys, "__cell").agg(F.max(F.when(~F.col("__left"), F.struct("__t", "__r"))).alias("__end"))
    carried = ends.select(*keys, "__cell", F.last("__end.__r", ignorenulls=True).over(before).alias("__carry"))
    joined = join_same(found, carried, [*keys, "__cell"], "left").withColumn("__m", F.when(F.col("__t").isNotNull(), F.coalesce("__in", "__carry")))
    if tolerance is not None:
        then = joined.select("*", F.col("__m.f0").alias("__then"))
        joined = then.withColumn("__m", F.when(F.col("__t") - _number(then, "__then") <= tolerance, F.col("__m")))
    return joined.select(*left.columns, *[F.col(f"__m.f{i}").alias(c) for i, c in enumerate(kept)])


def range_join(points: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, start: str, end: str) -> DataFrame:
    """Pairs of a point and an interval with equal keys and ``start <= at <= end``, each pair once.

    Intervals may overlap; a null end is open.  Points without a time or key, and intervals that end before they start,
    match nothing.  Columns other than the keys must have unlike names.

    An interval of length up to ``2 ** level`` lies in one or two cells of that width, and a point in one cell of each
    level that occurs (at most 63, typically few): an equi join on key, level and cell, then the exact test.  The join
    is a sort-merge join whatever the planner expects: it takes the size of compressed files for the size of their rows,
    and a broadcast of all intervals would fill the driver.
    """
    keys = list(keys)
    lo = F.coalesce(_number(intervals, start), F.lit(-FAR))
    hi = F.coalesce(_number(intervals, end), F.lit(FAR))
    rows = intervals.withColumns({"__lo": lo, "__hi": hi}).where("__lo <= __hi")
    # the number of digits of the length, so that the cell is wider than the interval
    rows = rows.withColumn("__level", F.expr(f"least({LEVELS}, length(bin(__hi - __lo)))"))
    levels = rows.agg(F.collect_set("__level").alias("__levels"))
    cells = F.array_distinct(F.expr("array(shiftright(__lo, __level), shiftright(__hi, __level))"))
    dealt = rows.withColumn("__cell", F.explode(cells)).drop("__lo", "__hi")
    dealt = dealt.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *[c for c in dealt.columns if c not in keys])
    own = points.withColumn("__t", _number(points, at))
    probes = attach(own, levels).withColumn("__level", F.explode("__levels")).withColumn("__cell", F.expr("shiftright(__t, __level)")).drop("__levels", "__t")
    same = [F.col(k) == F.col(f"__k_{k}") for k in keys]
    p, i = probes.alias("p"), dealt.hint("merge").alias("i")
    cond = (F.col("p.__level") == F.col("i.__level")) & (F.col("p.__cell") == F.col("i.__cell"))
    for s in same:
        cond = cond & s
    inside = (F.col(start).isNull() | (F.col(start) <= F.col(at))) & (F.col(end).isNull() | (F.col(at) <= F.col(end)))
    others = [c for c in intervals.columns if c not in keys]
    met = p.join(i, cond & inside)
    return met.select(*points.columns, *others)
