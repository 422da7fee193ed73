"""Two quantile flavours, each for bounded groups and for groups of any size.

``linear`` interpolates between neighbours; ``nearest`` returns an observed value.  Aggregates that keep
one group in one buffer are used only where the calendar bounds the group (years, months or days of one
entity).  :func:`group_quantiles` is exact for groups of any size: no task ever holds more than one range of
values of a group, so a group with a third of all rows is spread over the cluster.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import ColumnLike, attach, join_same, let

LINEAR, NEAREST = "linear", "nearest"


def bounded_nearest(value: ColumnLike, q: float) -> Column:
    """Aggregate: nearest-rank quantile of a group bounded by the calendar."""
    ordered = F.sort_array(F.collect_list(value))
    return F.try_element_at(ordered, (F.round((F.count(value) - 1) * F.lit(q)) + 1).cast("int"))


def bounded_linear(value: ColumnLike, q: float) -> Column:
    """Aggregate: interpolated quantile of a group bounded by the calendar."""
    return F.percentile(value, F.lit(q))


def array_median(values: Column) -> Column:
    """Median of an array column (mean of the two middle values); null when empty."""

    def middle(s: Column) -> Column:
        n = F.size(s)
        hi = F.element_at(s, (F.floor(n / 2) + 1).cast("int"))
        lo = F.element_at(s, F.ceil(n / 2).cast("int"))
        return F.when(n > 0, (lo + hi) / 2)

    return let(F.sort_array(values), middle)


#: Ranges of values between a number and its double; fixed, so that ranges need no pass over the data.
RANGES = 4096


def value_range(v: str) -> str:
    """Number of the range of a double: sign, exponent and leading digits, in the order of the values.

    The logarithm never falls as its argument grows, so ranges follow the values even where it rounds.
    """
    size = f"cast(floor({RANGES} * (log2(abs({v})) + 1075)) as bigint) + 1"
    return (
        f"case when isnan({v}) then {1 << 40} when {v} = 0 then 0 when abs({v}) = double('infinity') then {(1 << 40) - 1} * cast(sign({v}) as bigint) "
        f"else cast(sign({v}) as bigint) * ({size}) end"
    )


def _ranks(q: float, flavour: str, n: str) -> list[str]:
    pos = f"{q!r}D * ({n} - 1)"
    return [f"cast(round({pos}) as bigint)"] if flavour == NEAREST else [f"floor({pos})", f"ceil({pos})"]


def _pick(keys: Sequence[str], ranked: DataFrame, probs: Mapping[str, tuple[float, str]]) -> DataFrame:
    """Quantiles from rows ``(keys, __v, __c, __hi, __n)``: value, its count, last rank + 1, group size."""

    def at(rank: str) -> str:
        return f"max(case when __hi - __c <= {rank} and {rank} < __hi then __v end)"

    outs = []
    for name, (q, flavour) in probs.items():
        ends = [at(r) for r in _ranks(q, flavour, "__n")]
        if flavour == NEAREST:
            text = ends[0]
        else:
            pos = f"{q!r}D * (max(__n) - 1)"
            text = f"{ends[0]} + ({ends[1]} - {ends[0]}) * ({pos} - floor({pos}))"
        outs.append(F.expr(text).alias(name))
    return ranked.groupBy(*keys).agg(*outs)


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, tuple[float, str]],
    weight: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Exact quantiles per group, one column per entry of ``probs`` (``name -> (q, flavour)``).

    With ``weight`` a row stands for that many equal values; ``unique`` says that every value already occurs
    once per group, so counting is skipped.  Null values are left out.

    One way for groups of every size, all groups at once:

    1. equal values are counted, spread by key *and* value and combined before the shuffle;
    2. counts per group and range of values (:func:`value_range`) tell which ranges hold the wanted ranks;
    3. only the values of those ranges are ordered, each range on its own.

    A large group is spread over its ranges, so its size meets no task; what is summed per group is its
    ranges, however many rows it has.
    """
    keys = list(keys)
    whole = not keys
    if whole:
        keys, df = ["__all"], df.withColumn("__all", F.lit(1))
    part = ", ".join(f"`{k}`" for k in keys)
    names = [f"`{k}`" for k in keys]
    rows = df.where(F.col(value).isNotNull())
    v = F.col(value).cast("double").alias("__v")
    if unique:
        counted = rows.select(*keys, v, (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("__c"))
    else:
        counted = rows.groupBy(*keys, v).agg(F.expr(f"sum(`{weight}`)" if weight else "count(*)").alias("__c"))
    placed = counted.selectExpr(*names, "__v", "__c", f"{value_range('__v')} as __b")
    totals = placed.groupBy(*keys, "__b").agg(F.expr("sum(__c)").alias("__m")).selectExpr(
        *names, "__b", "__m", f"sum(__m) over (partition by {part}) as __n", f"sum(__m) over (partition by {part} order by __b) as __end"
    )
    wanted = ", ".join(r for q, fl in probs.values() for r in _ranks(q, fl, "__n"))
    needed = totals.where(f"exists(array({wanted}), r -> r >= __end - __m and r < __end)").selectExpr(
        *names, "__b", "__n", "__end - __m as __start"
    )
    inside = f"partition by {part}, __b order by __v"
    ordered = join_same(placed, needed, [*keys, "__b"]).selectExpr(
        *names, "__v", "__c", f"__start + sum(__c) over ({inside}) as __hi", "__n"
    )
    out = _pick(keys, ordered, probs)
    return out.drop("__all") if whole else out


def column_quantiles(
    df: DataFrame, keys: Sequence[str], specs: Mapping[str, tuple[str, float, str]], weight: str | None = None
) -> DataFrame:
    """Quantiles of several columns in one pass; ``specs`` maps a name to ``(column, q, flavour)``."""
    cols = sorted({c for c, _, _ in specs.values()})
    if len(cols) == 1:
        return group_quantiles(df, keys, cols[0], {n: (q, fl) for n, (_, q, fl) in specs.items()}, weight=weight)
    kept = [*keys, *([weight] if weight else [])]
    typed = df.select(*kept, *[F.col(c).cast("double").alias(c) for c in cols])
    long = typed.unpivot(kept, cols, "__col", "__x")
    wanted = sorted({(q, fl) for _, q, fl in specs.values()})
    probs = {f"__p{i}": p for i, p in enumerate(wanted)}
    wide = group_quantiles(long, [*keys, "__col"], "__x", probs, weight=weight)

    def pick(c: str, q: float, fl: str) -> Column:
        return F.max(F.when(F.col("__col") == c, F.col(f"__p{wanted.index((q, fl))}")))

    picks = [pick(*spec).alias(n) for n, spec in specs.items()]
    return wide.groupBy(*keys).agg(*picks) if keys else wide.agg(*picks)


def with_quantiles(
    summary: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    value: str | None,
    probs: Mapping[str, tuple],
    weight: str | None = None,
) -> DataFrame:
    """A per-group summary with quantiles of ``rows`` added; without ``value`` every entry names its column."""
    specs = probs if value is None else {n: (value, *p) for n, p in probs.items()}
    found = column_quantiles(rows, keys, specs, weight)
    if not keys:
        return attach(summary, found)
    return join_same(summary, found, keys, "left")
