"""Status snapshots, latest rows and like-for-like (paired) comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import attach, join_same, ratio
from tidemark.functions.quantiles import LINEAR, NEAREST, group_quantiles, with_quantiles
from tidemark.functions.ranks import latest
from tidemark.sources.staging import staged

CLASSES = ("1", "2", "3", "4", "5")
GOOD = ("1", "2")


def class_or_null(code: str, classes: Sequence[str] = CLASSES) -> Column:
    return F.when(F.col(code).isin(*classes), F.col(code))


def latest_after(df: DataFrame, key: str, year: str, after: int, keep: Sequence[str]) -> DataFrame:
    """Most recent row per key made after a year."""
    return latest(df.where(F.col(year) > after), [key], [year], [year, *keep])


def distribution(
    df: DataFrame, keys: Sequence[str] = (), cls: str = "cls", classes: Sequence[str] = CLASSES, good: Sequence[str] = GOOD
) -> DataFrame:
    """Counts per class, not classified, and the share of good classes among classified rows."""
    c = F.col(cls)
    classified = F.count_if(c.isin(*classes))
    aggs = [
        F.count(F.lit(1)).alias("n"),
        classified.alias("classified"),
        (F.count(F.lit(1)) - classified).alias("not_classified"),
        *[F.count_if(c == k).alias(f"class_{k}") for k in classes],
        ratio(F.count_if(c.isin(*good)), classified).alias("share_good"),
    ]
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def with_fixed_groups(df: DataFrame, group: str, wanted: Sequence[str]) -> DataFrame:
    """Fixed groups in the result even when a group has no rows (counts become 0)."""
    table = df.sparkSession.createDataFrame([(g,) for g in wanted], f"`{group}` string")
    out = F.broadcast(table).join(df, group, "left")
    counts = [c for c, t in df.dtypes if t in ("bigint", "int") and c != group]
    return out.na.fill(0, counts)


def paired_classes(
    base: DataFrame, later: DataFrame, key: str, before: str = "cls0", after: str = "cls_later", group: str | None = None,
    good: Sequence[str] = GOOD,
) -> DataFrame:
    """Improved / same / worsened between two snapshots of the same keys, with totals and per group."""
    j = base.join(later, key).where(F.col(before).isNotNull() & F.col(after).isNotNull())
    delta = F.col(after).try_cast("int") - F.col(before).try_cast("int")
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.count_if(delta < 0).alias("improved"),
        F.count_if(delta == 0).alias("same"),
        F.count_if(delta > 0).alias("worsened"),
        F.count_if(F.col(before).isin(*good)).alias("good_before"),
        F.count_if(F.col(after).isin(*good)).alias("good_after"),
    ]
    return j.rollup(group).agg(*aggs) if group else j.agg(*aggs)


def transition_matrix(pairs: DataFrame, before: str, after: str, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Zero-filled class × class counts."""
    counted = (
        pairs.where(F.col(before).isin(*classes) & F.col(after).isin(*classes))
        .groupBy(before)
        .agg(*[F.count_if(F.col(after) == c).alias(f"to_{c}") for c in classes])
    )
    return with_fixed_groups(counted, before, classes)


def status_targets(states: DataFrame, flag: str, achieved: str) -> DataFrame:
    """Objective rows, flagged rows, achieved and not achieved."""
    f = F.col(flag)
    return states.agg(
        F.count(F.lit(1)).alias("objective_rows"),
        F.count(f).alias("flagged"),
        F.count_if(f == achieved).alias("achieved"),
        F.count_if(f != achieved).alias("not_achieved"),
    )


def share_with_condition(
    df: DataFrame, entity: str, condition: Column, group: str | None = None
) -> DataFrame:
    """Distinct entities with at least one row meeting a condition, out of all entities present."""
    keys = [entity] + ([group] if group else [])
    per = df.groupBy(*keys).agg(F.max(F.coalesce(condition, F.lit(False)).cast("int")).alias("__hit"))
    aggs = [
        F.count(F.lit(1)).alias("assessed"),
        F.coalesce(F.sum("__hit"), F.lit(0)).alias("with_condition"),
        ratio(F.sum("__hit"), F.count(F.lit(1))).alias("share"),
    ]
    return per.groupBy(group).agg(*aggs) if group else per.agg(*aggs)


def by_attribute(df: DataFrame, attribute: str, entity: str) -> DataFrame:
    """Distinct entities and rows per non-null attribute value."""
    return (
        df.where(F.col(attribute).isNotNull())
        .groupBy(F.col(attribute).alias("name"))
        .agg(F.count_distinct(entity).alias("bodies"), F.count(F.lit(1)).alias("pressures"))
    )


def class_counts_by_year(df: DataFrame, year: str, statuses: Sequence[str], classes: Sequence[str]) -> DataFrame:
    """Rows per year and class for several status columns at once."""
    long = df.select(year, *statuses).unpivot([year], list(statuses), "status", "cls")
    return long.groupBy(year, "status").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("cls") == c).alias(f"class_{c}") for c in classes]
    )


def first_and_last(df: DataFrame, key: str, year: str, value: str) -> DataFrame:
    """Value of every key in the first and in the last year of the table (keys present in both)."""
    ends = df.agg(F.min(year).alias("__a"), F.max(year).alias("__b"))
    marked = attach(df, ends).where((F.col(year) == F.col("__a")) | (F.col(year) == F.col("__b")))
    g = marked.groupBy(key).agg(
        F.min("__a").alias("from"),
        F.min("__b").alias("to"),
        F.max(F.when(F.col(year) == F.col("__a"), F.struct(F.col(value).alias("v")))).alias("__x"),
        F.max(F.when(F.col(year) == F.col("__b"), F.struct(F.col(value).alias("v")))).alias("__y"),
    )
    both = g.where((F.col("from") < F.col("to")) & F.col("__x").isNotNull() & F.col("__y").isNotNull())
    return both.select(key, "from", "to", F.col("__x.v").alias("a"), F.col("__y.v").alias("b"))


def change_counts(pairs: DataFrame, before: str = "a", after: str = "b", keys: Sequence[str] = ()) -> DataFrame:
    """How many pairs fell, stayed or rose (a lower class is better)."""
    a, b = F.col(before).try_cast("double"), F.col(after).try_cast("double")
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.count_if(b < a).alias("improved"),
        F.count_if(b == a).alias("same"),
        F.count_if(b > a).alias("worsened"),
    ]
    return pairs.groupBy(*keys).agg(*aggs) if keys else pairs.agg(*aggs)


def end_years(df: DataFrame, by: Sequence[str], year: str, span: int) -> DataFrame:
    """First and last ``span`` observed years per group; only groups with at least ``2 * span`` years."""
    years = df.select(*by, year).distinct()  # bounded by the calendar from here on
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    ranked = years.select(
        *by,
        year,
        F.row_number().over(w.orderBy(year)).alias("__up"),
        F.row_number().over(w.orderBy(F.desc(year))).alias("__down"),
        F.count(F.lit(1)).over(w).alias("__k"),
    ).where(F.col("__k") >= 2 * span)
    return ranked.where((F.col("__up") <= span) | (F.col("__down") <= span)).select(
        *by, year, F.when(F.col("__up") <= span, "first").otherwise("last").alias("end")
    )


def paired_ends(
    df: DataFrame, by: Sequence[str], entity: str, year: str, value: str, span: int = 3, min_entities: int = 3
) -> DataFrame:
    """Entities present in both the first and the last years: medians, median % change, share decreased."""
    ends = end_years(df, by, year, span)
    tagged = join_same(df, ends, [*by, year])
    first, last = F.col("end") == "first", F.col("end") == "last"
    per = staged(
        tagged.groupBy(*by, entity)
        .agg(F.avg(F.when(first, F.col(value))).alias("a"), F.avg(F.when(last, F.col(value))).alias("b"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull())
        .withColumn("pct", F.lit(100.0) * (ratio("b", "a") - 1))
    )
    base = (
        (per.groupBy(*by) if by else per.groupBy())
        .agg(
            F.count(F.lit(1)).alias("stations"),
            ratio(F.count_if(F.col("b") < F.col("a")), F.count(F.lit(1))).alias("share_decreased"),
            F.bool_and(F.col("a") > 0).alias("__pos"),
        )
        .where(F.col("stations") >= min_entities)
    )
    medians = {"median_first": "a", "median_last": "b", "median_change_pct": "pct"}
    out = with_quantiles(base, per, by, None, {n: (c, 0.5, LINEAR) for n, c in medians.items()})
    span_years = (ends.groupBy(*by) if by else ends.groupBy()).agg(
        *[f(F.when(F.col("end") == e, F.col(year))).alias(f"{e}_{n}") for e in ("first", "last") for n, f in (("from", F.min), ("to", F.max))]
    )
    out = join_same(out, span_years, by) if by else attach(out, span_years)
    return out.withColumn("median_change_pct", F.when(F.col("__pos"), F.col("median_change_pct"))).drop("__pos")


def paired_periods(
    df: DataFrame, by: Sequence[str], entity: str, period: str, value: str, min_entities: int = 20
) -> DataFrame:
    """Entity medians in the first and last period that have enough entities, and their change."""
    per = staged(group_quantiles(df, [*by, entity, period], value, {"v": (0.5, LINEAR)}))
    sizes = per.groupBy(*by, period).agg(F.count(F.lit(1)).alias("__k")).where(F.col("__k") >= min_entities)
    ends = (sizes.groupBy(*by) if by else sizes.groupBy()).agg(F.min(period).alias("from"), F.max(period).alias("to"))
    ends = ends.where(F.col("from") < F.col("to"))
    tagged = join_same(per, ends, by) if by else attach(per, ends).where(F.col("from").isNotNull())
    wide = (
        tagged.groupBy(*by, entity, "from", "to")
        .agg(
            F.max(F.when(F.col(period) == F.col("from"), F.col("v"))).alias("a"),
            F.max(F.when(F.col(period) == F.col("to"), F.col("v"))).alias("b"),
        )
        .where(F.col("a").isNotNull() & F.col("b").isNotNull())
        .withColumn("diff", F.col("b") - F.col("a"))
    )
    keys = [*by, "from", "to"]
    base = wide.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("plots"), ratio(F.count_if(F.col("diff") > 0), F.count(F.lit(1))).alias("share_increased")
    )
    medians = {"median_first": "a", "median_last": "b", "median_change": "diff"}
    return with_quantiles(base, wide, keys, None, {n: (c, 0.5, LINEAR) for n, c in medians.items()})


def period_summary(
    df: DataFrame, keys: Sequence[str], value: str, entity: str, mark: str | None = None,
    quantiles: tuple[float, float] = (0.1, 0.9), min_rows: int = 1,
) -> DataFrame:
    """Samples, distinct entities, median and two nearest-rank quantiles per key (rows have a value)."""
    cells = counted_cells(df, [*keys, entity], value, mark)
    aggs = [F.sum("__n").alias("samples"), F.count_distinct(entity).alias("plots")]
    if mark:
        aggs.append(F.sum("__marks").alias("below_loq_mark"))
    base = cells.where("__marks >= 0").groupBy(*keys).agg(*aggs).where(F.col("samples") >= min_rows)
    lo, hi = quantiles
    names = {f"p{round(lo * 100)}": (lo, NEAREST), f"p{round(hi * 100)}": (hi, NEAREST), "median": (0.5, LINEAR)}
    return with_quantiles(base, cells.where("__marks >= 0"), keys, value, names, "__n")


def counted_cells(df: DataFrame, keys: Sequence[str], value: str, mark: str | None = None) -> DataFrame:
    """Rows and marked rows per key and value: one pass that several statistics share.

    Users that need only ``__n`` also filter on ``__marks``, so all of them read the same exchange.
    """
    marks = F.count(mark) if mark else F.count_if(F.isnull(F.col(value)))
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"), marks.alias("__marks"))


def two_level_limit(
    df: DataFrame, keys: Sequence[str], entity: str, value: str, limit: float, mark: str | None = None
) -> DataFrame:
    """Per key: samples, entities, median, p90, share of samples over a limit and share of entities whose
    median is over it."""
    cells = counted_cells(df, [*keys, entity], value, mark)
    shared = cells.where("__marks >= 0")
    over = F.sum(F.when(F.col(value) > limit, F.col("__n")).otherwise(0))
    aggs = [F.sum("__n").alias("samples"), ratio(over, F.sum("__n")).alias("share_over_limit")]
    if mark:
        aggs.append(ratio(F.sum("__marks"), F.sum("__n")).alias("share_below_loq_mark"))
    base = cells.where("__marks >= 0").groupBy(*keys).agg(*aggs)
    med = group_quantiles(shared, [*keys, entity], value, {"__med": (0.5, LINEAR)}, weight="__n", unique=True)
    sites = med.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sites"),
        ratio(F.count_if(F.col("__med") > limit), F.count(F.lit(1))).alias("site_share_over_limit"),
    )
    out = with_quantiles(base, shared, keys, value, {"median": (0.5, LINEAR), "p90": (0.9, NEAREST)}, "__n")
    return join_same(out, sites, keys, "left")
