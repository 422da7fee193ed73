"""Official-statistics cubes in long form: slices, group pivots with a remainder, identities and gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import all_of, attach, join_same, ratio, sum0, sum_where


def clean_names(df: DataFrame) -> DataFrame:
    """Plain spaces instead of non-breaking spaces in column names."""
    return df.toDF(*[c.replace("\u00a0", " ") for c in df.columns])


def slice_series(df: DataFrame, where: Mapping[str, str], year: str, value: str = "value") -> DataFrame:
    """``(year, value)`` of one cube slice, null values left out."""
    cond = all_of([F.col(c) == v for c, v in where.items()] + [F.col(value).isNotNull()])
    return df.where(cond).select(F.col(year).try_cast("int").alias("year"), F.col(value).cast("double").alias("value"))


def align(df: DataFrame, year: str, code: str, value: str, names: Mapping[str, str]) -> DataFrame:
    """One column per code (``code -> name``) and one row per year: the full outer alignment as a pivot."""
    rows = df.where(F.col(code).isin(*names) & F.col(value).isNotNull())
    return rows.groupBy(F.col(year).try_cast("int").alias("year")).agg(
        *[F.max(F.when(F.col(code) == c, F.col(value).cast("double"))).alias(n) for c, n in names.items()]
    )


def group_pivot(
    df: DataFrame,
    year: str,
    code: str,
    value: str,
    groups: Mapping[str, Sequence[str]],
    total: Column,
    rest: str = "other",
    subsets: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Per year: total, one column per group of codes, the remainder and further code subsets.

    ``total`` is the condition of the rows that make up the total (the stated total row, or all rows).  The
    remainder is never negative.
    """
    v, c = F.col(value).cast("double"), F.col(code)
    g = df.where(F.col(value).isNotNull()).groupBy(F.col(year).try_cast("int").alias("year")).agg(
        F.sum(F.when(total, v)).alias("total"),
        *[sum_where(v, c.isin(*codes)).alias(n) for n, codes in groups.items()],
        *[sum_where(v, c.isin(*codes)).alias(n) for n, codes in (subsets or {}).items()],
    )
    used = sum((F.col(n) for n in groups), F.lit(0.0))
    return g.where(F.col("total").isNotNull()).withColumn(rest, F.greatest(F.lit(0.0), F.col("total") - used))


def column_pivot(df: DataFrame, year: str, code: str, value: str, names: Mapping[str, str], total: str, rest: str = "other") -> DataFrame:
    """Per year of the total: one nullable column per code and the non-negative remainder."""
    wide = align(df, year, code, value, {**names, total: "total"}).where(F.col("total").isNotNull())
    used = sum((F.coalesce(F.col(n), F.lit(0.0)) for n in names.values()), F.lit(0.0))
    return wide.withColumn(rest, F.greatest(F.lit(0.0), F.col("total") - used))


def detect_signs(wide: DataFrame, target: str, fixed: Sequence[str], signed: tuple[str, str]) -> DataFrame:
    """Signs of two items that make ``target = sum(fixed) + s1·a + s2·b`` fit best, in one aggregate.

    All four candidates are sums over the same rows; ties go to the first in (−,−), (−,+), (+,−), (+,+).
    """
    rows = wide.where(all_of(F.col(c).isNotNull() for c in (target, *fixed, *signed)))
    base = F.col(target) - sum((F.col(c) for c in fixed), F.lit(0.0))
    a, b = (F.col(c) for c in signed)
    options = [(-1, -1), (-1, 1), (1, -1), (1, 1)]
    sums = rows.agg(
        *[F.sum(F.abs(base - (s * a + t * b))).alias(f"r{i}") for i, (s, t) in enumerate(options)],
        F.sum(F.abs(F.col(target))).alias("scale"),
    )
    scale = F.when(F.col("scale") > 0, F.col("scale")).otherwise(1.0)
    cands = F.array(
        *[
            F.struct(
                (F.coalesce(F.col(f"r{i}"), F.lit(0.0)) / scale).alias("residual_share"),
                F.lit(i).alias("rank"),
                F.lit(s).alias("sign_a"),
                F.lit(t).alias("sign_b"),
            )
            for i, (s, t) in enumerate(options)
        ]
    )
    return sums.select(F.array_min(cands).alias("x")).select("x.sign_a", "x.sign_b", "x.residual_share")


def balance_rows(wide: DataFrame, signs: DataFrame) -> DataFrame:
    """Net imports and import dependency per year from aligned balance items and the detected sign."""
    net = F.col("imports") + F.col("sign_a") * F.col("exports")
    return attach(wide.where(F.col("gae").isNotNull()), signs.select("sign_a")).withColumns(
        {"net_imports": net, "dependency_pct": F.lit(100.0) * ratio(net, "gae")}
    ).drop("sign_a")


def share_of_total(df: DataFrame, year: str, value: str, part: Column, total: Column, name: str = "share_pct") -> DataFrame:
    """Sum over a subset as % of the stated total, for years with a total."""
    v = F.col(value).cast("double")
    g = df.groupBy(F.col(year).try_cast("int").alias("year")).agg(
        sum_where(v, part).alias("part"), sum_where(v, total).alias("total")
    )
    return g.where(F.col("total") != 0).withColumn(name, F.lit(100.0) * F.col("part") / F.col("total"))


def complete_years(df: DataFrame, keys: Sequence[str], year: str, value: str, members: int = 12) -> DataFrame:
    """Totals of years with exactly ``members`` values."""
    g = df.where(F.col(value).isNotNull()).groupBy(*keys, year).agg(F.count(F.lit(1)).alias("__n"), F.sum(value).alias("total"))
    return g.where(F.col("__n") == members).drop("__n")


def recent_profiles(df: DataFrame, complete: DataFrame, keys: Sequence[str], year: str, month: str, value: str, last: int = 3) -> DataFrame:
    """Monthly profile (ordered array) of the last complete years per key."""
    w = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(1))
    years = complete.select(*keys, year).withColumn("__r", F.dense_rank().over(w.orderBy(F.desc(year)))).where(F.col("__r") <= last).drop("__r")
    rows = join_same(df.where(F.col(value).isNotNull()), years, [*keys, year])
    ordered = F.array_sort(F.collect_list(F.struct(F.col(month).alias("m"), F.col(value).alias("v"))))
    return rows.groupBy(*keys, year).agg(F.transform(ordered, lambda x: x["v"]).alias("months"))


def map_of(df: DataFrame, keys: Sequence[str], name: str, value: str, out: str) -> DataFrame:
    """Per key a map ``name -> value`` over a code list."""
    rec = F.struct(F.col(name), F.col(value))
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(rec))).alias(out))


def chapter_codes(labels: DataFrame, code: str = "code", label: str = "label", pattern: str = r"^(\d{2})0000 ") -> DataFrame:
    """Codes whose label opens with a chapter number, and that two-digit chapter."""
    ch = F.regexp_extract(F.col(label), pattern, 1)
    return labels.select(code, ch.alias("chapter")).where(F.col("chapter") != "").distinct()


def with_and_without(
    df: DataFrame, chapters: DataFrame, year: str, code: str, item: str, value: str, items: Mapping[str, str],
    total_code: str, excluded: Sequence[str],
) -> DataFrame:
    """Per year and item: stated total, the part in excluded chapters, and the share all chapters cover.

    ``chapters`` is a code list, so it is joined as a small dimension by size; rows are pre-aggregated first.
    """
    rows = df.where(F.col(value).isNotNull() & F.col(item).isin(*items))
    sums = rows.groupBy(F.col(year).try_cast("int").alias("year"), code, item).agg(sum0(F.col(value).cast("double")).alias("v"))
    j = sums.join(chapters.withColumnRenamed("code", code), code, "left")
    is_total, ch = F.col(code) == total_code, F.col("chapter")
    aggs = []
    for c, name in items.items():
        it = F.col(item) == c
        aggs += [
            F.sum(F.when(it & is_total, F.col("v"))).alias(name),
            sum_where("v", it & ch.isin(*excluded)).alias(f"{name}_excluded"),
            sum_where("v", it & ch.isNotNull()).alias(f"__{name}_chapters"),
        ]
    g = j.groupBy("year").agg(*aggs)
    first = next(iter(items.values()))
    return g.where(F.col(first).isNotNull()).select(
        "year",
        *[c for n in items.values() for c in (n, f"{n}_excluded")],
        (F.col(first) - F.col(f"{first}_excluded")).alias(f"{first}_other"),
        ratio(f"__{first}_chapters", first).alias("chapter_share"),
    )


def labelled(df: DataFrame, labels: DataFrame, code: str, out: str = "name") -> DataFrame:
    """Label of a code, or the code itself when it has none."""
    lab = labels.select(F.col("code").alias(code), F.col("label").alias("__label"))
    return df.join(lab, code, "left").withColumn(out, F.coalesce("__label", code)).drop("__label")
