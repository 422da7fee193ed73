"""Linking registers by noisy codes, allocating amounts to units, and balances."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import attach, norm_key, ratio, sum0, sum_where
from tidemark.functions.ranks import latest


def _codes(df: DataFrame, columns: Sequence[str], out: str, amount: str | None = None) -> DataFrame:
    """Distinct normalised codes per code column, with the amount on each."""
    present = [c for c in columns if c in df.columns]
    amt = F.col(amount).cast("double") if amount else F.lit(0.0)
    keyed = df.select(amt.alias("__a"), *[norm_key(c).alias(c) for c in present])
    long = keyed.unpivot(["__a"], present, out, "__k").where(F.col("__k").isNotNull())
    return long.groupBy(out, "__k").agg(sum0("__a").alias("__a"))


def link_report(
    left: DataFrame, right: DataFrame, left_codes: Sequence[str], right_codes: Sequence[str], amount: str
) -> DataFrame:
    """For every pair of code columns: distinct codes, matching codes and the share of the amount they carry.

    Codes are reduced to one row each before the join, so all pairs come from a single equi join on the code.
    """
    a = _codes(left, left_codes, "left_column", amount)
    b = _codes(right, right_codes, "right_column").drop("__a")
    total = left.agg(sum0(F.col(amount).cast("double")).alias("__total"))
    n_a = a.groupBy("left_column").agg(F.count(F.lit(1)).alias("distinct_left"))
    n_b = b.groupBy("right_column").agg(F.count(F.lit(1)).alias("distinct_right"))
    hits = a.join(b, "__k").groupBy("left_column", "right_column").agg(
        F.count(F.lit(1)).alias("__m"), F.sum("__a").alias("__v")
    )
    spark = left.sparkSession
    present = [(x, y) for x in left_codes if x in left.columns for y in right_codes if y in right.columns]
    pairs = spark.createDataFrame(present, "left_column string, right_column string")
    out = (
        pairs.join(n_a, "left_column", "left")
        .join(n_b, "right_column", "left")
        .join(hits, ["left_column", "right_column"], "left")
    )
    return attach(out, total).select(
        "left_column",
        "right_column",
        F.coalesce("distinct_left", F.lit(0)).alias("distinct_left"),
        F.coalesce("distinct_right", F.lit(0)).alias("distinct_right"),
        F.coalesce("__m", F.lit(0)).alias("matching_codes"),
        ratio(F.coalesce("__v", F.lit(0.0)), "__total").alias("matching_volume_share"),
    )


def registry_report(
    amounts: DataFrame,
    register: DataFrame,
    links: DataFrame,
    amount_code: str,
    amount: str,
    register_codes: Sequence[str],
    register_id: str,
    link_id: str,
    link_target: str,
) -> DataFrame:
    """Codes of an amount table matched to a register and from there to units with a link target."""
    a = _codes(amounts, [amount_code], "code_column", amount).drop("code_column")
    total = amounts.agg(sum0(F.col(amount).cast("double")).alias("__total"))
    n_a = a.agg(F.count(F.lit(1)).alias("distinct_amount_codes"))
    present = [c for c in register_codes if c in register.columns]
    reg = (
        register.select(F.col(register_id).alias("__id"), *[norm_key(c).alias(c) for c in present])
        .unpivot(["__id"], present, "register_column", "__k")
        .where(F.col("__k").isNotNull())
    )
    reg_n = reg.groupBy("register_column").agg(F.count_distinct("__k").alias("distinct_register_codes"))
    matched = reg.join(a, "__k")
    per_code = (
        matched.groupBy("register_column", "__k")
        .agg(F.max("__a").alias("__a"))
        .groupBy("register_column")
        .agg(F.count(F.lit(1)).alias("matching_codes"), F.sum("__a").alias("__v"))
    )
    with_target = links.where(F.col(link_target).isNotNull()).select(F.col(link_id).alias("__id")).distinct().withColumn("__t", F.lit(1))
    ids = (
        matched.select("register_column", "__id")
        .distinct()
        .join(with_target, "__id", "left")
        .groupBy("register_column")
        .agg(F.count(F.lit(1)).alias("matched_ids"), F.count("__t").alias("matched_ids_with_target"))
    )
    out = reg_n.join(per_code, "register_column", "left").join(ids, "register_column", "left")
    out = attach(attach(out, n_a), total)
    return out.select(
        "register_column",
        "distinct_amount_codes",
        "distinct_register_codes",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("matching_codes", "matched_ids", "matched_ids_with_target")],
        ratio(F.coalesce("__v", F.lit(0.0)), "__total").alias("matching_volume_share"),
    )


def code_units(
    register: DataFrame, links: DataFrame, code: str, register_id: str, link_id: str, unit: str
) -> DataFrame:
    """Per normalised code: register rows, largest number of units behind one row, distinct units, the unit.

    ``units`` is 0 for codes without any unit; a code is unambiguous when ``units`` and ``unit_n`` are 1.
    """
    per_id = links.where(F.col(unit).isNotNull()).groupBy(link_id).agg(
        F.count_distinct(unit).alias("units"), F.min(unit).alias("unit")
    )
    k = register.select(F.col(register_id).alias("__id"), norm_key(code).alias("code")).where(F.col("code").isNotNull())
    j = k.join(per_id, k["__id"] == per_id[link_id], "left")
    return j.groupBy("code").agg(
        F.count(F.lit(1)).alias("entries"),
        F.coalesce(F.max("units"), F.lit(0)).alias("units"),
        F.min("unit").alias("unit"),
        # more than one unit behind a code is all that matters, no distinct set is kept
        F.when(F.min("unit").isNull(), 0).when(F.min("unit") == F.max("unit"), 1).otherwise(2).alias("unit_n"),
    )


def allocate(amounts: DataFrame, units: DataFrame, code: str) -> DataFrame:
    """Amount rows with ``class`` none / multiple / single and the unit."""
    g = amounts.withColumn("code", norm_key(code)).join(units, "code", "left")
    return g.withColumn(
        "class",
        F.when(F.coalesce("unit_n", F.lit(0)) == 0, "none")
        .when((F.col("units") > 1) | (F.col("unit_n") > 1), "multiple")
        .otherwise("single"),
    )


def class_shares(
    df: DataFrame, keys: Sequence[str], cls: str, amount: str, classes: Sequence[str] = ("single", "multiple", "none")
) -> DataFrame:
    """Total, rows and the share of the amount per class."""
    c = F.col(cls)
    total = F.sum(amount)
    return df.groupBy(*keys).agg(
        sum0(amount).alias("total"),
        F.count(F.lit(1)).alias("rows"),
        *[ratio(sum_where(amount, c == k), total).alias(k) for k in classes],
    )


def reserves_per_unit(df: DataFrame, unit: str, amount: str) -> DataFrame:
    """Records, total and number of records with an amount per unit."""
    return df.where(F.col(unit).isNotNull()).groupBy(unit).agg(
        F.count(F.lit(1)).alias("deposits"), sum0(amount).alias("reserve"), F.count(amount).alias("n_with_reserve")
    )


def latest_status(df: DataFrame, unit: str, order: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Last row per unit in ``order``; missing order values count as oldest."""
    return latest(df, [unit], order, keep)


def balance_by_unit(
    amounts: DataFrame, reserves: DataFrame, status: DataFrame | None, unit: str, amount: str, per_day: float = 365.0
) -> DataFrame:
    """Daily amount per unit against its reserve: a full join, so units of either side stay."""
    a = amounts.groupBy(unit).agg(F.sum(amount).alias("__m"), F.count_distinct("code").alias("intakes"))
    j = a.join(reserves, unit, "full")
    if status is not None:
        j = j.join(status, unit, "left")
    day = F.col("__m") / per_day
    return j.withColumn("per_day", day).withColumn(
        "ratio", F.when((day > 0) & (F.col("reserve") > 0), ratio(day, "reserve"))
    ).drop("__m")


def balance_summary(balance: DataFrame) -> DataFrame:
    """Ratio bands and totals of :func:`balance_by_unit`."""
    r, day, res = F.col("ratio"), F.col("per_day"), F.col("reserve")
    both = r.isNotNull()
    return balance.agg(
        F.count("intakes").alias("units_with_amount"),
        F.count("deposits").alias("units_with_reserve"),
        F.count_if(both).alias("units_with_both"),
        sum_where("per_day", res.isNull() | (res <= 0)).alias("per_day_without_reserve"),
        F.count_if(r > 1).alias("ratio_gt1"),
        F.count_if((r > 0.5) & (r <= 1)).alias("ratio_05_1"),
        F.count_if(r <= 0.5).alias("ratio_lt05"),
        sum_where("per_day", both).alias("per_day_in_both"),
        sum_where("reserve", both).alias("reserve_in_both"),
    )


def by_register_type(
    allocated: DataFrame, register: DataFrame, code: str, kind: str, amount: str, missing: str
) -> DataFrame:
    """Amount by a register attribute, with the part on unambiguous codes (one register row per code)."""
    t = register.groupBy(norm_key(code).alias("code")).agg(F.min(kind).alias("__kind"))
    j = allocated.join(t, "code", "left").withColumn("kind", F.coalesce("__kind", F.lit(missing)))
    return j.groupBy("kind").agg(
        sum0(amount).alias("total"),
        F.count_distinct("code").alias("codes"),
        sum_where(amount, F.col("class") == "single").alias("total_single"),
    )


def missing_links(links: DataFrame, column: str, targets: DataFrame, target: str) -> DataFrame:
    """Links that point to nothing (dangling references)."""
    return links.join(targets.select(F.col(target).alias(column)), column, "left_anti")


def require_empty(df: DataFrame, message: str, cols: Mapping[str, str] | Sequence[str]) -> None:
    """Raise with an example when a check table has rows (reads at most one row)."""
    bad = df.select(*list(cols)).head()
    if bad is not None:
        raise ValueError(f"{message}: {bad.asDict()}")
