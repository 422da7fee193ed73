"""Profiles and grain diagnostics: what is in a table and what one of its rows means."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import all_of, join_same, ratio
from tidemark.functions.ranks import top_rows


def unpivot_text(df: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """``(keys…, column, value)`` with every value as text."""
    cols = [c for c in (columns or df.columns) if c not in keys]
    text = df.select(*keys, *[F.col(c).cast("string").alias(c) for c in cols])
    return text.unpivot(list(keys), cols, "column", "value")


def value_counts(df: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] | None = None) -> DataFrame:
    """Rows per ``(keys…, column, value)``; the base of every profile below (one pass, one shuffle)."""
    return unpivot_text(df, keys, columns).groupBy(*keys, "column", "value").agg(F.count(F.lit(1)).alias("rows"))


def describe(
    df: DataFrame, keys: Sequence[str] = (), columns: Sequence[str] | None = None, empty_is_null: bool = False
) -> DataFrame:
    """Per column: rows, null share, distinct values (null counts as one), numeric range, text range."""
    counts = value_counts(df, keys, columns)
    v = F.col("value")
    absent = v.isNull() | (v == "") if empty_is_null else v.isNull()
    num = v.try_cast("double")
    numeric = {c for c, t in df.dtypes if t in ("double", "float", "int", "bigint", "smallint", "tinyint") or t.startswith("decimal")}
    is_num = F.col("column").isin(*numeric) if numeric else F.lit(False)
    return counts.groupBy(*keys, "column").agg(
        F.sum("rows").alias("rows"),
        ratio(F.coalesce(F.sum(F.when(absent, F.col("rows"))), F.lit(0)), F.sum("rows")).alias("null_share"),
        F.count(F.lit(1)).alias("distinct"),
        F.min(F.when(is_num & ~absent, num)).alias("v_min"),
        F.max(F.when(is_num & ~absent, num)).alias("v_max"),
        F.min(F.when(~is_num & ~absent, v)).alias("text_min"),
        F.max(F.when(~is_num & ~absent, v)).alias("text_max"),
    )


def top_values(
    df: DataFrame,
    keys: Sequence[str] = (),
    columns: Sequence[str] | None = None,
    max_distinct: int | None = None,
    top: int | None = None,
) -> DataFrame:
    """Value counts of all columns, or of those with at most ``max_distinct`` values; all counts, or the ``top`` largest."""
    kept = value_counts(df, keys, columns)
    if max_distinct is not None:
        few = kept.groupBy(*keys, "column").agg(F.count(F.lit(1)).alias("__d")).where(F.col("__d") <= max_distinct)
        kept = join_same(kept, few.drop("__d"), [*keys, "column"], "left_semi")
    if top is None:
        return kept
    return top_rows(kept, [*keys, "column"], [F.desc("rows"), F.asc_nulls_first("value")], top)


def counts(df: DataFrame, cols: Sequence[str], top: int | None = None) -> DataFrame:
    """Rows per column tuple; a listing may ask for the ``top`` largest."""
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("rows"))
    order = [F.desc("rows"), *[F.asc_nulls_first(c) for c in cols]]
    return g.orderBy(*order).limit(top) if top else g


def duplicates(df: DataFrame, keys: Sequence[str], value: str | None = None) -> DataFrame:
    """Key groups, groups with several rows and (with ``value``) groups whose amounts differ."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        # "differs" needs only two of the values, so no distinct set is built per key
        aggs += [
            ((F.min(value) != F.max(value)) | ((F.count(value) > 0) & (F.count(value) < F.count(F.lit(1))))).alias("differs")
        ]
    g = df.groupBy(*keys).agg(*aggs)
    outs = [F.count(F.lit(1)).alias("key_groups"), F.count_if(F.col("n") > 1).alias("groups_with_multiple_rows")]
    if value:
        outs.append(F.count_if(F.coalesce(F.col("differs"), F.lit(False))).alias("groups_with_different_values"))
    return g.agg(*outs)


def rows_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys have 1, 2, 3 … rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).groupBy("n").agg(F.count(F.lit(1)).alias("keys"))


def join_coverage(df: DataFrame, key: str, register: DataFrame, register_key: str) -> DataFrame:
    """Distinct keys of a table and how many of them the register holds."""
    ids = df.select(F.col(key).alias("__k")).distinct()
    reg = register.select(F.col(register_key).alias("__k")).distinct().withColumn("__hit", F.lit(1))
    return ids.join(reg, "__k", "left").agg(
        F.count(F.lit(1)).alias("keys"), F.count("__hit").alias("found_in_register")
    )


def table_shapes(
    df: DataFrame, dims: Sequence[str], by: Sequence[str] = (), year: str | None = None
) -> DataFrame:
    """Which nullable classifiers are filled: rows, year range and distinct values per shape."""
    shape = F.concat_ws("+", *[F.when(F.col(d).isNotNull(), F.lit(d)) for d in dims]).alias("shape")
    span = [F.min(year).alias("first_year"), F.max(year).alias("last_year")] if year else []
    return df.groupBy(*by, shape).agg(
        F.count(F.lit(1)).alias("rows"),
        *span,
        *[F.count_distinct(d).alias(f"n_{d}") for d in dims],
    )


def shape_values(df: DataFrame, dims: Sequence[str], by: Sequence[str] = (), max_values: int = 40) -> DataFrame:
    """How many values every filled classifier has per shape, and a sorted list of them where they are at most ``max_values``.

    Values are counted first; only lists that are short enough are gathered.
    """
    shaped = df.select(
        *by, F.concat_ws("+", *[F.when(F.col(d).isNotNull(), F.lit(d)) for d in dims]).alias("shape"), *dims
    )
    vals = unpivot_text(shaped, [*by, "shape"]).where(F.col("value").isNotNull()).distinct()
    keys = [*by, "shape", "column"]
    sized = vals.groupBy(*keys).agg(F.count(F.lit(1)).alias("distinct"))
    short = join_same(vals, sized.where(F.col("distinct") <= max_values).select(*keys), keys, "left_semi")
    lists = short.groupBy(*keys).agg(F.array_sort(F.collect_list("value")).alias("values"))
    return join_same(sized, lists, keys, "left")


def shape_examples(
    df: DataFrame, dims: Sequence[str], by: Sequence[str], year: str, value: str, n: int = 3
) -> DataFrame:
    """Largest rows of the latest year per shape."""
    shaped = df.withColumn("shape", F.concat_ws("+", *[F.when(F.col(d).isNotNull(), F.lit(d)) for d in dims]))
    recent = shaped.where(F.col(year) == df.agg(F.max(year)).scalar())
    order = [F.desc_nulls_last(value), *[F.asc_nulls_last(d) for d in dims]]
    return top_rows(recent, [*by, "shape"], order, n, "example")


def filter_trace(df: DataFrame, steps: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows left after each selection step, from one pass over the table."""
    conds, aggs = [], []
    for i, (_, cond) in enumerate(steps):
        conds.append(cond)
        aggs.append(F.count_if(F.coalesce(all_of(conds), F.lit(False))).alias(f"s{i}"))
    row = df.agg(*aggs)
    items = F.array(
        *[F.struct(F.lit(i + 1).alias("step_no"), F.lit(n).alias("step"), F.col(f"s{i}").alias("rows")) for i, (n, _) in enumerate(steps)]
    )
    return row.select(F.explode(items).alias("x")).select("x.*")


def additivity(df: DataFrame, key: str, measures: Sequence[str], version: str | None = None) -> DataFrame:
    """Is a measure constant within a key (then it must not be summed over the key's rows)?"""
    aggs = [F.count(F.lit(1)).alias("n")]
    for m in measures:
        aggs += [F.max(m).alias(f"max_{m}"), ((F.min(m) == F.max(m)) & (F.count(m) == F.count(F.lit(1)))).alias(f"const_{m}")]
    if version:
        aggs.append((F.min(version) != F.max(version)).alias("versions"))
    multi = df.groupBy(key).agg(*aggs)
    many = F.col("n") > 1
    outs = [F.count(F.lit(1)).alias("keys"), F.count_if(many).alias("multi_row_keys")]
    for m in measures:
        pos, const = F.col(f"max_{m}") > 0, F.coalesce(F.col(f"const_{m}"), F.lit(False))
        outs += [
            F.count_if(many & const).alias(f"constant_{m}"),
            F.count_if(many & pos).alias(f"nonzero_{m}"),
            F.count_if(many & pos & const).alias(f"nonzero_constant_{m}"),
        ]
    if version:
        outs.append(F.count_if(many & F.coalesce(F.col("versions"), F.lit(False))).alias("keys_with_several_versions"))
    return multi.agg(*outs)


def per_key_totals(df: DataFrame, key: str, group: str, measures: Sequence[str]) -> DataFrame:
    """Maximum per key first, then the sum over keys per group (for measures repeated within a key)."""
    per = df.groupBy(key, group).agg(*[F.max(m).alias(m) for m in measures])
    return per.groupBy(group).agg(*[F.sum(m).alias(m) for m in measures], F.count(F.lit(1)).alias("keys"))


def repeats(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Key groups, groups with several rows, and those of them with a single amount."""
    g = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        (F.min(value).eqNullSafe(F.max(value)) & ((F.count(value) == F.count(F.lit(1))) | (F.count(value) == 0))).alias("one"),
    )
    return g.agg(
        F.count(F.lit(1)).alias("groups"),
        F.count_if(F.col("n") > 1).alias("groups_with_multiple_rows"),
        F.count_if((F.col("n") > 1) & F.col("one")).alias("multi_row_groups_with_single_amount"),
    )


def repeated_key_differences(
    df: DataFrame, keys: Sequence[str], amount: str, attributes: Mapping[str, str], order: Sequence[str]
) -> DataFrame:
    """For keys with several rows: which attributes differ and what keeping only the first row would lose."""
    first = F.min(F.struct(*order, F.col(amount).alias("__first")))["__first"]

    def differs(c: str) -> Column:
        return F.coalesce((F.min(c) != F.max(c)), F.lit(False)) | ((F.count(c) > 0) & (F.count(c) < F.count(F.lit(1))))

    g = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        (~differs(amount)).alias("same_amount"),
        *[differs(c).alias(name) for name, c in attributes.items()],
        F.sum(amount).alias("total"),
        first.alias("first"),
    )
    many = F.col("n") > 1
    gap = F.coalesce(F.sum(F.when(many, F.coalesce(F.col("total") - F.col("first"), F.lit(0)))), F.lit(0))
    return g.agg(
        F.count_if(many).alias("groups_n_gt_1"),
        F.count_if(many & F.col("same_amount")).alias("identical_amounts"),
        *[F.count_if(many & F.col(name)).alias(name) for name in attributes],
        gap.alias("excess_if_first_row_only"),
        ratio(gap, F.sum("total")).alias("share_of_all"),
    )


def tiling(df: DataFrame, total: str, parts: Sequence[str], tolerance: float = 0.01) -> DataFrame:
    """Share of rows whose parts add up to the total within a relative tolerance."""
    added = sum((F.coalesce(F.col(p), F.lit(0)) for p in parts), F.lit(0.0))
    rows = df.where(F.col(total) > 0).select((F.abs(added - F.col(total)) / F.col(total) <= tolerance).alias("ok"))
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if("ok").alias("within_tolerance"),
        ratio(F.count_if("ok"), F.count(F.lit(1))).alias("share"),
    )


def predicate_counts(df: DataFrame, predicates: Mapping[str, Column]) -> DataFrame:
    """Rows per named predicate in one pass."""
    row = df.agg(*[F.count_if(p).alias(f"p{i}") for i, p in enumerate(predicates.values())])
    items = F.array(
        *[F.struct(F.lit(n).alias("predicate"), F.col(f"p{i}").alias("rows")) for i, n in enumerate(predicates)]
    )
    return row.select(F.explode(items).alias("x")).select("x.*")


def descriptive_columns(df: DataFrame, measures: Sequence[str]) -> list[str]:
    """Names of the columns that are neither measures nor floating point numbers."""
    return [c for c, t in df.dtypes if c not in measures and t not in ("double", "float")]


def even_sample(df: DataFrame, ident: str, blocks: int = 5, block_rows: int = 400) -> DataFrame:
    """Evenly spread blocks of rows in the hash order of a unique key (the sampling operator)."""
    from tidemark.functions.ranks import hash_positions

    placed = hash_positions(df, ident, pos="__pos", n="__n")
    step = F.greatest(F.floor(F.col("__n") / blocks), F.lit(1))
    block = F.least(F.floor(F.col("__pos") / step), F.lit(blocks - 1))
    small = F.col("__n") <= blocks * block_rows
    start = F.least(block * step, F.col("__n") - block_rows)
    return placed.where(small | ((F.col("__pos") >= start) & (F.col("__pos") < start + block_rows))).drop("__pos", "__n")
