"""Column expressions shared by the operators (all of them native, none is a Python UDF)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce
from itertools import chain
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def all_of(parts: Iterable[Column]) -> Column:
    return reduce(and_, parts, F.lit(True))


def any_of(parts: Iterable[Column]) -> Column:
    return reduce(or_, parts, F.lit(False))


def ratio(a: ColumnLike, b: ColumnLike) -> Column:
    """``a / b``; null when ``b`` is zero or either side is null."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def sum0(x: ColumnLike) -> Column:
    """Sum that is 0 over no or only null values."""
    return F.coalesce(F.sum(x), F.lit(0))


def sum_where(x: ColumnLike, cond: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, col(x))), F.lit(0))


def distinct_with_null(x: ColumnLike) -> Column:
    """Distinct values where null counts as one value."""
    return F.count_distinct(x) + F.coalesce(F.max(col(x).isNull().cast("int")), F.lit(0))


def nan_to_null(x: ColumnLike) -> Column:
    return F.when(~F.isnan(col(x)), col(x))


def clean_round(x: ColumnLike, digits: int = 3) -> Column:
    return F.round(nan_to_null(x), digits)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind an expression once and use it several times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def literal_map(mapping: Mapping[str, object]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def lookup(key: ColumnLike, mapping: Mapping[str, object], default: object | None = None) -> Column:
    """Value of a small constant table; null (or ``default``) for unlisted keys."""
    found = F.try_element_at(literal_map(mapping), col(key))
    return found if default is None else F.coalesce(found, F.lit(default))


def norm_key(x: ColumnLike) -> Column:
    """Join key as trimmed upper-case text."""
    return F.upper(F.trim(col(x).cast("string")))


def text_year(x: ColumnLike) -> Column:
    """Year of an ISO text; null when malformed."""
    return F.substring(col(x), 1, 4).try_cast("int")


def text_day(x: ColumnLike) -> Column:
    return F.substring(col(x), 1, 10)


def year_bucket(ts: ColumnLike, year: int, first: int = 1995) -> Column:
    """Half-open calendar-year predicate; year 0 stands for everything before ``first``."""
    if year == 0:
        return col(ts) < F.lit(f"{first}-01-01")
    return (col(ts) >= F.lit(f"{year}-01-01")) & (col(ts) < F.lit(f"{year + 1}-01-01"))


def season(month: ColumnLike) -> Column:
    m = col(month)
    return (
        F.when(m.isin(12, 1, 2), "DJF")
        .when(m.between(3, 5), "MAM")
        .when(m.between(6, 8), "JJA")
        .when(m.between(9, 11), "SON")
    )


def season_year(year: ColumnLike, month: ColumnLike) -> Column:
    """December belongs to the winter of the next year."""
    return col(year) + F.when(col(month) == 12, 1).otherwise(0)


def period_start(year: ColumnLike, first: int, width: int) -> Column:
    y = col(year)
    return (F.floor((y - F.lit(first)) / F.lit(width)) * width + first).cast("int")


def period_label(year: ColumnLike, first: int = 2002, width: int = 5) -> Column:
    start = period_start(year, first, width)
    return F.concat(start.cast("string"), F.lit("-"), (start + width - 1).cast("string"))


def found_year(text: ColumnLike) -> Column:
    """First 19xx or 20xx in a text; null when there is none."""
    return F.nullif(F.regexp_extract(col(text), r"(?:19|20)\d{2}", 0), F.lit(""))


def version_label(text: ColumnLike) -> Column:
    return F.coalesce(found_year(text), F.lit("?"))


def registration_year(text: ColumnLike) -> Column:
    return found_year(text).try_cast("int")


def upper_bound(label: ColumnLike, unassessed: str = "hindamata") -> Column:
    """Upper end of a percentage class such as ``>20-25%``; null when not assessed."""
    lab = col(label)
    span = F.nullif(F.regexp_extract(lab, r">?\s*(\d+)\s*[-–]\s*(\d+)\s*%", 2), F.lit(""))
    point = F.nullif(F.regexp_extract(lab, r"^\s*(\d+)\s*%", 1), F.lit(""))
    skipped = F.lower(F.trim(lab)).startswith(unassessed)
    return F.when(~skipped, F.coalesce(span, point).try_cast("double"))


def bin_of(x: ColumnLike, edges: Sequence[tuple[float, str]], above: str) -> Column:
    """Label of the first edge not below the value; ``above`` beyond the last edge, null for null."""
    val = col(x)
    out = F.when(val.isNull(), F.lit(None).cast("string"))
    for edge, label in edges:
        out = out.when(val <= edge, label)
    return out.otherwise(above)


def keyword_label(text: ColumnLike, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """Label of the first rule with a keyword contained in the lower-cased text."""
    low = F.lower(F.coalesce(col(text), F.lit("")))
    out = None
    for label, words in rules:
        hit = any_of(low.contains(w) for w in words)
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def keyword_tags(text: ColumnLike, rules: Mapping[str, str]) -> Column:
    """Array with the name of every rule whose pattern occurs in the lower-cased text."""
    low = F.lower(col(text))
    tags = F.array(*[F.when(low.rlike(rx), F.lit(name)) for name, rx in rules.items()])
    return F.filter(tags, lambda t: t.isNotNull())


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Columns of a one-row aggregate on every row, as a scalar subquery (null when there is no row)."""
    names = one_row.columns
    packed = one_row.select(F.struct(*names).alias("__one")).scalar()
    kept = [F.col(c) for c in df.columns]
    return df.withColumn("__one", packed).select(*kept, *[F.col(f"__one.{n}").alias(n) for n in names])


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join on ``keys`` where null equals null (group keys may be null)."""
    r = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys], *[x for x in right.columns if x not in keys]
    )
    cond = all_of(F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys)
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])
