"""Published estimates with a relative sampling error: exact-shape selection and error propagation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import all_of, attach, col, join_same, nan_to_null, ratio
from tidemark.functions.quantiles import NEAREST, with_quantiles


@dataclass(frozen=True)
class Shape:
    """One level of a cube: ``select`` equalities, ``fixed`` classifiers, classifiers in ``over`` filled, all
    other classifiers empty."""

    select: Mapping[str, object]
    fixed: Mapping[str, str] = field(default_factory=dict)
    over: tuple[str, ...] = ()

    def condition(self, dims: Sequence[str]) -> Column:
        parts = [F.col(c) == F.lit(v) for c, v in self.select.items()]
        for d in dims:
            if d in self.over:
                parts.append(F.col(d).isNotNull())
            elif d in self.fixed:
                parts.append(F.col(d) == self.fixed[d])
            else:
                parts.append(F.col(d).isNull())
        return all_of(parts)

    def steps(self, dims: Sequence[str]) -> list[tuple[str, Column]]:
        """The same selection as named steps, in order, for a filter trace."""
        out = [(f"{c} = {v}", F.col(c) == F.lit(v)) for c, v in self.select.items()]
        out += [(f"{d} filled", F.col(d).isNotNull()) for d in self.over]
        for d in dims:
            if d in self.over:
                continue
            if d in self.fixed:
                out.append((f"{d} = {self.fixed[d]}", F.col(d) == self.fixed[d]))
            else:
                out.append((f"{d} empty", F.col(d).isNull()))
        return out


def exact(df: DataFrame, dims: Sequence[str], shape: Shape) -> DataFrame:
    return df.where(shape.condition(dims))


def series(
    df: DataFrame, keys: Sequence[str] = (), year: str = "aasta", value: str = "arvvaartus", err: str = "suhteline_viga"
) -> DataFrame:
    """``(keys…, year, value, err)``; rows without a value are left out, a NaN error is unknown."""
    return df.where(F.col(value).isNotNull()).select(
        *keys,
        F.col(year).cast("int").alias("year"),
        F.col(value).cast("double").alias("value"),
        nan_to_null(F.col(err).cast("double")).alias("err"),
    )


def label_metrics(df: DataFrame, dims: Sequence[str], metrics: Mapping[str, Shape]) -> DataFrame:
    """Rows of several shapes labelled with their metric, from one pass over the cube."""
    hits = F.filter(
        F.array(*[F.when(s.condition(dims), F.lit(n)) for n, s in metrics.items()]), lambda m: m.isNotNull()
    )
    return df.withColumn("metric", F.explode(hits))


def total_over(
    parts: DataFrame, keys: Sequence[str], value: str = "value", err: str = "err"
) -> DataFrame:
    """Sum of parts with errors as a root sum of squares.

    The error of the sum is unknown when a positive part has no error or when the sum is 0; a part of 0
    without an error adds nothing.
    """
    v, e = F.col(value), F.col(err)
    g = parts.where(v.isNotNull()).groupBy(*keys).agg(
        F.sum(v).alias("value"),
        F.sqrt(F.sum(F.pow(v * F.coalesce(e, F.lit(0.0)), F.lit(2)))).alias("__abs"),
        F.bool_or(e.isNull() & (v > 0)).alias("__unknown"),
    )
    return g.select(
        *keys, "value", F.when((F.col("value") != 0) & ~F.col("__unknown"), F.col("__abs") / F.col("value")).alias("err")
    )


def _common(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    left = a.select(*keys, F.col("value").alias("va"), F.col("err").alias("ea"))
    right = b.select(*keys, F.col("value").alias("vb"), F.col("err").alias("eb"))
    return join_same(left, right, keys)


def add(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("year",)) -> DataFrame:
    """Sum of two series on common years; absolute errors combined as a root sum of squares."""
    total = F.col("va") + F.col("vb")
    err = F.when(total != 0, F.hypot(F.col("va") * F.col("ea"), F.col("vb") * F.col("eb")) / total)
    return _common(a, b, keys).select(*keys, total.alias("value"), err.alias("err"))


def ratio_of(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("year",)) -> DataFrame:
    """Ratio of two series on common years; relative errors in quadrature, a zero denominator is skipped."""
    return (
        _common(a, b, keys)
        .where(F.col("vb") != 0)
        .select(*keys, (F.col("va") / F.col("vb")).alias("value"), F.hypot("ea", "eb").alias("err"))
    )


def change_columns(first: ColumnPair, last: ColumnPair) -> list[Column]:
    """Difference, its share of the first value, combined half-width and whether it is distinguishable."""
    (v0, e0), (v1, e1) = first, last
    half = F.hypot(v0 * e0, v1 * e1)
    diff = v1 - v0
    return [
        diff.alias("diff"),
        ratio(diff, v0).alias("pct"),
        half.alias("half_width"),
        (F.abs(diff) > half).alias("distinguishable"),
    ]


ColumnPair = tuple[Column, Column]


def changes(df: DataFrame, keys: Sequence[str] = ("metric",), span: int = 10) -> DataFrame:
    """Change from the first year and from the latest year at least ``span`` years back to the last year."""
    rec = F.struct("year", "value", "err")
    ends = df.groupBy(*keys).agg(
        F.min_by(rec, "year").alias("first"), F.max_by(rec, "year").alias("last"), F.count(F.lit(1)).alias("__n")
    ).where(F.col("__n") >= 2)
    earlier = (
        join_same(df, ends.select(*keys, F.col("last.year").alias("__ly")), keys)
        .where(F.col("year") <= F.col("__ly") - span)
        .groupBy(*keys)
        .agg(F.max_by(rec, "year").alias("earlier"))
    )
    both = join_same(ends, earlier, keys, "left")
    start = both.select(*keys, F.lit("since_start").alias("period"), F.col("first").alias("f"), F.col("last").alias("l"))
    recent = both.where(F.col("earlier").isNotNull()).select(
        *keys, F.lit(f"last_{span}_years").alias("period"), F.col("earlier").alias("f"), F.col("last").alias("l")
    )
    pairs = start.unionByName(recent)
    return pairs.select(
        *keys,
        "period",
        F.col("f.year").alias("from"),
        F.col("l.year").alias("to"),
        *change_columns((col("f.value"), col("f.err")), (col("l.value"), col("l.err"))),
    )


def age_class_set(df: DataFrame, label: str, width: int = 20) -> DataFrame:
    """One age-class scheme out of mixed labels, chosen by the numbers in the labels.

    Two-number labels spanning ``width`` years are the core; an open lower class ends at ``width``; an open
    upper class starts right after the last core class.  Returns ``(label, lower)``.
    """
    nums = F.transform(F.regexp_extract_all(F.col(label), F.lit(r"(\d+)"), 1), lambda s: s.cast("int"))
    names = df.where(F.col(label).isNotNull()).select(label).distinct().select(
        label, nums.alias("n"), F.col(label).rlike(r"^\d").alias("starts")
    )
    lo, hi = F.try_element_at("n", F.lit(1)), F.try_element_at("n", F.lit(2))
    is_core = (F.size("n") == 2) & (hi - lo + 1 == width)
    marked = attach(names, names.agg((F.max(F.when(is_core, lo)) + width - 1).alias("__top")))
    single = F.size("n") == 1
    lower = (
        F.when(is_core, lo)
        .when(single & ~F.col("starts") & (lo == width) & F.col("__top").isNotNull(), 0)
        .when(single & F.col("starts") & (lo == F.col("__top") + 1), lo)
    )
    return marked.select(label, lower.alias("lower")).where(F.col("lower").isNotNull())


def latest_values(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Value of the last year per key."""
    return df.groupBy(*keys).agg(F.max_by("value", "year").alias("value"), F.max("year").alias("year"))


def shares_check(parts: DataFrame, total: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sum of parts divided by the stated total (about 1 when the classes tile it)."""
    if keys:
        s = parts.groupBy(*keys).agg(F.sum("value").alias("__p"))
        return join_same(s, total.select(*keys, F.col("value").alias("__t")), keys).select(*keys, ratio("__p", "__t").alias("share"))
    s = parts.agg(F.sum("value").alias("__p"))
    return attach(s, total.agg(F.max("value").alias("__t"))).select(ratio("__p", "__t").alias("share"))


def error_summary(df: DataFrame, err: str = "suhteline_viga", limit: float = 0.5) -> DataFrame:
    """Null share, nearest-rank quantiles and the share of large relative errors."""
    e = F.col(err)
    base = df.agg(
        F.count(F.lit(1)).alias("rows"),
        ratio(F.count_if(e.isNull()), F.count(F.lit(1))).alias("null_error_share"),
        ratio(F.count_if(e > limit), F.count(e)).alias("share_over_50pct"),
    )
    return with_quantiles(base, df, [], err, {f"p{q}": (q / 100, NEAREST) for q in (10, 50, 90, 99)})
