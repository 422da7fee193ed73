"""Reading landed files: declared schemas, partition pruning, privacy guards, count checks and part logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import all_of, year_bucket


class RowCountMismatch(RuntimeError):
    """The rows read are not the rows expected."""


#: Columns of the main sources (all nullable, one declared type each).
CLIMATE = "jaam_kood string, jaam_nimi string, aasta int, kuu int, vaartus double, element_kood string"
CLIMATE_DAILY = CLIMATE + ", paev int"
HYDRO_HOURLY = "jaam_kood bigint, series string, timeline_ts_utc string, vaartus double"
HYDRO_DAILY = "jaam_kood bigint, series string, date date, value double, n_hours int"
MEASUREMENT_VALUE = "vaartus_arv_moodetud"
WASTE_KEYS = (
    "aasta",
    "maht_liik",
    "pohigrupp",
    "alamgrupp",
    "jaatmeliik",
    "jaatmeliik_nimi",
    "pohigrupp_nimi",
    "ohtlik_lipp",
    "biojaatmed_lipp",
    "reoveesetted_lipp",
    "metallijaatmed_lipp",
    "probleemtooted_lipp",
    "partner_riik_nimi",
    "riik",
    "materjali_kood",
    "materjali_nimetus",
)


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    fmt: str = "parquet",
    schema: str | T.StructType | None = None,
    columns: Sequence[str] | None = None,
    where: Column | None = None,
    **options: str,
) -> DataFrame:
    """Landed files with a declared schema, the wanted columns and a predicate (both reach the scan)."""
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.format(fmt).load(list(path) if not isinstance(path, str) else path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def read_or_empty(spark: SparkSession, path: str | None, schema: str, fmt: str = "json", where: Column | None = None) -> DataFrame:
    """Declared columns even when nothing has landed yet."""
    if path is None:
        return spark.createDataFrame([], schema)
    return read_table(spark, path, fmt, schema, where=where)


def read_years(df: DataFrame, ts: str, years: Sequence[int], first: int = 1995) -> DataFrame:
    """Rows of the given calendar years (0 = before ``first``) as one half-open range predicate each."""
    cond = year_bucket(ts, years[0], first)
    for y in years[1:]:
        cond = cond | year_bucket(ts, y, first)
    return df.where(cond)


def equals(filters: Mapping[str, object]) -> Column:
    return all_of(F.col(k) == F.lit(v) for k, v in filters.items())


def normalise(df: DataFrame, value: str = MEASUREMENT_VALUE, text: Sequence[str] | None = None) -> DataFrame:
    """One value column as double and every other listed column as text, so parts share one schema."""
    cols = [c for c in (text or df.columns) if c in df.columns and c != value]
    out = [F.col(c).cast("string").alias(c) for c in cols]
    if value in df.columns:
        out.insert(0, F.col(value).try_cast("double").alias(value))
    return df.select(*out)


def drop_private(df: DataFrame, prefixes: Sequence[str] = (), names: Sequence[str] = ()) -> DataFrame:
    """Drop personal columns by name or prefix before anything is stored."""
    gone = [c for c in df.columns if c in names or any(c.startswith(p) for p in prefixes)]
    return df.drop(*gone)


def only_allowed(df: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Fail when an output carries a column that is not on the allow-list."""
    extra = sorted(set(df.columns) - set(allowed))
    if extra:
        raise ValueError(f"columns not allowed in an output: {extra}")
    return df


def require_count(df: DataFrame, expected: int, label: str) -> DataFrame:
    """The frame itself, or an error when its row count is not the expected one."""
    got = df.count()
    if got != expected:
        raise RowCountMismatch(f"{label}: expected {expected} rows, read {got}")
    return df


def discover(df: DataFrame, column: str, keep: Sequence[str]) -> DataFrame:
    """One representative row per distinct value of a column."""
    rec = F.min(F.struct(*keep))
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(rec.alias("__r")).select(column, "__r.*")


def series_coverage(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Rows and first and last time per series."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.min(ts).alias("first"), F.max(ts).alias("last"))


def select_stations(catalogue: DataFrame, series: str, min_rows: int) -> DataFrame:
    """Stations of a nested catalogue that list a series with enough rows."""
    st = catalogue.select(F.explode("stations").alias("s")).select("s.jaam_kood", F.explode("s.series").alias("x"))
    return st.where((F.col("x.series") == series) & (F.col("x.rows") >= min_rows)).select("jaam_kood").distinct()


def year_counts(df: DataFrame, year: str | Column = "year") -> DataFrame:
    y = F.col(year) if isinstance(year, str) else year
    return df.groupBy(y.alias("year")).agg(F.count(F.lit(1)).alias("rows_read"))


def read_parts(spark: SparkSession, root: str, schema: str, fmt: str = "parquet", leave_damaged: bool = False) -> DataFrame:
    """All stored parts below a folder with their file name.

    A damaged file fails the job.  With ``leave_damaged`` what can't be read of it is left out; then
    :func:`broken_parts` has to name such files for the report.
    """
    reader = spark.read.schema(schema).option("ignoreCorruptFiles", str(leave_damaged).lower()).option("recursiveFileLookup", "true")
    return reader.format(fmt).load(root).withColumn("part_file", F.input_file_name())


def broken_parts(parts: DataFrame, expected_files: DataFrame) -> DataFrame:
    """Expected files ``(file, rows_expected)`` from which other rows than those were read, with ``rows_read``.

    Without known row counts (null) a file is broken if nothing was read from it.
    """
    seen = parts.groupBy(F.substring_index("part_file", "/", -1).alias("file")).agg(F.count(F.lit(1)).alias("rows_read"))
    both = expected_files.join(seen, "file", "left").withColumn("rows_read", F.coalesce("rows_read", F.lit(0)))
    return both.where(F.coalesce(F.col("rows_read") != F.col("rows_expected"), F.col("rows_read") == 0))


def profile_tables(
    spark: SparkSession, tables: Mapping[str, str], skip_suffixes: Sequence[str] = ("_isik",), fmt: str = "parquet"
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Profile per table and an index; tables with a person-data suffix are skipped, failures are listed.

    Each profile is written at once, so that a table that can't be read fails here and not in a later job.
    """
    from tidemark.operators.profile import describe
    from tidemark.sources.staging import staged

    found: dict[str, DataFrame] = {}
    index: list[tuple[str, int | None, str]] = []
    for name, path in tables.items():
        if name.endswith(tuple(skip_suffixes)):
            index.append((name, None, "skipped"))
            continue
        try:
            df = read_table(spark, path, fmt)
            found[name] = staged(describe(df, empty_is_null=True))
            index.append((name, len(df.columns), "ok"))
        except Exception as exc:  # noqa: BLE001 - one unreadable table must not stop the others
            index.append((name, None, f"failed: {type(exc).__name__}"))
    return found, spark.createDataFrame(index, "table_name string, columns int, status string")
