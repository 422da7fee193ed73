"""Totals, shares, top lists with a folded remainder, concentration and overlapping streams."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import any_of, join_same, ratio, sum0, sum_where
from tidemark.functions.ranks import earliest, top_rows


def flow_totals(df: DataFrame, keys: Sequence[str], value: str = "maht") -> DataFrame:
    """Net total, negative total, rows and negative rows of a stored partial aggregate."""
    return df.groupBy(*keys).agg(
        sum0(value).alias("total"),
        sum0("neg_sum").alias("negative_total"),
        sum0("rows").alias("rows"),
        sum0("neg_rows").alias("negative_rows"),
    )


def group_totals(
    df: DataFrame, keys: Sequence[str], value: str, out: str = "total", distinct: str | None = None
) -> DataFrame:
    """Sum per key, optionally with the number of distinct members and rows."""
    extra = [F.count_distinct(distinct).alias("reports"), F.count(F.lit(1)).alias("rows")] if distinct else []
    return df.groupBy(*keys).agg(sum0(value).alias(out), *extra)


def flagged_share(df: DataFrame, keys: Sequence[str], value: str, flag: Column) -> DataFrame:
    """Total, flagged total and its share where the total is positive."""
    g = df.groupBy(*keys).agg(sum0(value).alias("total"), sum_where(value, flag).alias("flagged"))
    return g.withColumn("share", F.when(F.col("total") > 0, F.col("flagged") / F.col("total")))


def top_types(df: DataFrame, types: Sequence[str], value: str, n: int = 12) -> DataFrame:
    """Largest types by total; ties by type."""
    g = df.groupBy(*types).agg(sum0(value).alias("total"))
    return g.orderBy(F.desc("total"), *[F.asc(t) for t in types]).limit(n)


def top_members(df: DataFrame, member: str, value: str, n: int) -> DataFrame:
    """The ``n`` members with the largest total (a top-k report of at most ``n`` rows)."""
    return df.groupBy(member).agg(sum0(value).alias("__t")).orderBy(F.desc("__t"), F.asc(member)).limit(n)


def top_member_series(df: DataFrame, keys: Sequence[str], member: str, value: str, n: int = 10) -> DataFrame:
    """Series of the ``n`` members with the largest all-time total."""
    sums = df.where(F.col(member).isNotNull()).groupBy(*keys, member).agg(sum0(value).alias("total"))
    top = top_members(sums, member, "total", n)
    return sums.join(F.broadcast(top), member, "left_semi")


def fold_rest(
    df: DataFrame, keys: Sequence[str], member: str, value: str, n: int = 8, other: str = "other", missing: str | None = None,
    positive_only: bool = False,
) -> DataFrame:
    """Series of the ``n`` largest members, everything else folded into ``other``.

    Rows are summed per key and member first; the ranking and the fold work on that aggregate.  A null member is a member
    like any other (or ``missing``, where that is given); one of the name ``other`` is counted with the rest.
    """
    m = F.coalesce(F.col(member), F.lit(missing)) if missing else F.col(member)
    sums = df.groupBy(*keys, m.alias("__member")).agg(sum0(value).alias("total"))
    ranked = sums.groupBy("__member").agg(F.sum("total").alias("__t"))
    if positive_only:
        ranked = ranked.where(F.col("__t") > 0)
    top = ranked.orderBy(F.desc("__t"), F.asc("__member")).limit(n).select("__member", F.lit(True).alias("__keep"))
    named = join_same(sums, F.broadcast(top), ["__member"], "left").withColumn(
        member, F.when(F.col("__keep"), F.col("__member")).otherwise(other)
    )
    return named.groupBy(*keys, member).agg(F.sum("total").alias("total"))


def concentration(
    df: DataFrame, keys: Sequence[str], member: str, value: str, tops: Sequence[int] = (1, 5, 10)
) -> DataFrame:
    """Share of a total that comes from its largest 1, 5, 10 … members.

    Only the largest ``max(tops)`` members of a group reach the ranking; the total is a plain aggregate.
    """
    per = df.groupBy(*keys, member).agg(sum0(value).alias("__v"))
    base = per.groupBy(*keys).agg(F.count(F.lit(1)).alias("reports"), F.sum("__v").alias("total"))
    ranked = top_rows(per, keys, [F.desc("__v"), F.asc(member)], max(tops), "__rn")
    sums = ranked.groupBy(*keys).agg(*[F.sum(F.when(F.col("__rn") <= n, F.col("__v"))).alias(f"__s{n}") for n in tops])
    out = join_same(base, sums, keys, "left")
    return out.select(
        *keys,
        "reports",
        "total",
        *[F.when(F.col("total") > 0, F.col(f"__s{n}") / F.col("total")).alias(f"top{n}_share") for n in tops],
    )


def dedup_gap(
    df: DataFrame, keys: Sequence[str], groups: Sequence[str], value: str, order: Sequence[str]
) -> DataFrame:
    """All-rows total against the total of the first row per key, and the relative gap."""
    all_t = df.groupBy(*groups).agg(sum0(value).alias("all_total"))
    first = earliest(df, keys, order, [*[g for g in groups if g not in keys], value])
    one = first.groupBy(*groups).agg(sum0(value).alias("first_total"))
    out = join_same(all_t, one, groups, "left")
    return out.withColumn("gap_share", ratio(F.col("all_total") - F.col("first_total"), "all_total"))


def stock_continuity(df: DataFrame, year: str, value: str, opening: Column, closing: Column) -> DataFrame:
    """Closing stock of a year against the opening stock of the next one."""
    per = df.groupBy(year).agg(
        F.sum(F.when(opening, F.col(value))).alias("opening"), F.sum(F.when(closing, F.col(value))).alias("closing")
    )
    nxt = per.select((F.col(year) - 1).alias(year), F.col("opening").alias("next_opening")).where(F.col("next_opening").isNotNull())
    out = per.where(F.col("closing").isNotNull()).select(year, "closing").join(nxt, year)
    return out.withColumn("ratio", ratio("next_opening", "closing"))


def longest_name(df: DataFrame, code: str, name: str) -> DataFrame:
    """Longest observed label per code; ties go to the last in text order."""
    best = F.max(F.struct(F.length(name).alias("n"), F.col(name).alias("name")))
    return df.where(F.col(name).isNotNull()).groupBy(code).agg(best["name"].alias(name))


def stream_flows(df: DataFrame, streams: Mapping[str, Column], keys: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """Totals per predicate-defined stream; a row counts in every stream it matches."""
    ids = F.filter(F.array(*[F.when(p, F.lit(n)) for n, p in streams.items()]), lambda x: x.isNotNull())
    return (
        df.withColumn("stream", F.explode(ids))
        .groupBy("stream", *keys)
        .agg(*[sum0(c).alias(n) for n, c in sums.items()])
    )


def stream_top(df: DataFrame, streams: Mapping[str, Column], types: Sequence[str], value: str, n: int = 8) -> DataFrame:
    """The largest types within every stream."""
    totals = stream_flows(df, streams, types, {"total": value})
    return top_rows(totals, ["stream"], [F.desc("total"), *[F.asc(t) for t in types]], n, "rank")


def wide_to_long(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Column totals per key as rows: the wide table is summed before it is unpivoted."""
    sums = df.groupBy(*keys).agg(*[sum0(c).alias(c) for c in columns])
    return sums.unpivot(list(keys), list(columns), name, value)


def limit_exceedance(
    df: DataFrame, keys: Sequence[str], checks: Mapping[str, tuple[str, Sequence[str]]]
) -> DataFrame:
    """Rows with a limit and rows whose largest reading is above it, for several substances in one pass."""
    items = F.array(
        *[F.struct(F.lit(n).alias("substance"), F.col(lim).alias("lim"), F.greatest(*[F.col(c) for c in cols]).alias("top")) for n, (lim, cols) in checks.items()]
    )
    rows = df.select(*keys, F.explode(items).alias("x")).where(F.col("x.lim") > 0)
    return rows.groupBy(F.col("x.substance").alias("substance"), *keys).agg(
        F.count(F.lit(1)).alias("with_limit"), F.count_if(F.col("x.top") > F.col("x.lim")).alias("over_limit")
    )


def running_totals(df: DataFrame, year: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Yearly rows and totals with their running totals (the window sees one row per year)."""
    per = df.groupBy(*by, year).agg(F.count(F.lit(1)).alias("n"), sum0(value).alias("total"))
    w = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))).orderBy(year).rowsBetween(Window.unboundedPreceding, 0)
    return per.withColumns({"cum_n": F.sum("n").over(w), "cum_total": F.sum("total").over(w)})


def ratio_of_totals(left: DataFrame, right: DataFrame, key: str, left_value: str, right_value: str) -> DataFrame:
    """Total of the right table against the total of the left one per key of the left."""
    a = left.groupBy(key).agg(sum0(left_value).alias("left_total"))
    b = right.groupBy(key).agg(sum0(right_value).alias("right_total"))
    j = a.join(b, key, "left").withColumn("right_total", F.coalesce("right_total", F.lit(0)).cast("double"))
    return j.withColumn("ratio", ratio("right_total", "left_total"))


def status_summary(df: DataFrame, group: str, status: str, weight: str, statuses: Sequence[str], uncovered: str) -> DataFrame:
    """Per group and in total: rows and weight per status, and the uncovered share of the weight."""
    s = F.col(status)
    return df.rollup(group).agg(
        F.count(F.lit(1)).alias("n"),
        sum0(weight).alias("weight"),
        *[F.count_if(s == x).alias(f"n_{x}") for x in statuses],
        *[sum_where(weight, s == x).alias(f"weight_{x}") for x in statuses],
        ratio(sum_where(weight, s == uncovered), F.sum(weight)).alias("share_uncovered"),
    )


def extreme_rows(df: DataFrame, keys: Sequence[str], value: str, keep: Sequence[str], tie: str) -> DataFrame:
    """Row with the highest and row with the lowest value per key; the first in ``tie`` order wins."""
    rec = F.struct(*[F.col(k) for k in keep])
    ok = F.col(value).isNotNull()
    return (
        df.where(ok)
        .groupBy(*keys)
        .agg(
            F.max_by(rec, F.struct(F.col(value), -F.col(tie))).alias("highest"),
            F.min_by(rec, F.struct(F.col(value), F.col(tie))).alias("lowest"),
        )
    )


def class_percentages(df: DataFrame, counts: Sequence[str], total: str) -> DataFrame:
    """Class counts as percentages of the sample size."""
    return df.select("*", *[(F.lit(100.0) * ratio(c, total)).alias(f"pct_{c}") for c in counts])


def any_keyword(text: str, words: Sequence[str]) -> Column:
    return any_of(F.lower(F.col(text)).contains(w) for w in words)
