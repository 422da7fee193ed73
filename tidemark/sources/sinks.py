"""Writing results: partitioned Parquet, CSV with a fixed column order, one JSON document per theme."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def read_csv(spark, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header; missing text is an empty string, unnamed columns are dropped."""
    reader = spark.read.option("header", "true")
    df = (reader.schema(schema) if schema else reader).csv(path)
    named = [c for c in df.columns if c and not c.startswith("_c")]
    return df.select(*[F.col(f"`{c}`") for c in named]).na.fill("")


def write_csv(df: DataFrame, path: str, fields: Sequence[str], mode: str = "errorifexists") -> None:
    """Columns in the given order; further columns are ignored, absent ones stay empty."""
    cols = [F.col(c) if c in df.columns else F.lit("").alias(c) for c in fields]
    df.select(*cols).write.mode(mode).option("header", "true").csv(path)


def write_series(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], mode: str = "errorifexists") -> None:
    """Series clustered by key ranges and ordered inside each file."""
    df.repartitionByRange(*keys).sortWithinPartitions(*keys, *order).write.mode(mode).parquet(path)


def write_by_year(df: DataFrame, path: str, year: str = "year", mode: str = "overwrite") -> None:
    """One folder per year; with dynamic overwrite only the years present are replaced.

    Tasks write the years they hold, so a large year is not gathered in one task.
    """
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(year).parquet(path)


def write_sections(sections: Mapping[str, DataFrame], path: str, mode: str = "overwrite") -> None:
    """Every section of a theme as JSON lines below one folder."""
    for name, df in sections.items():
        df.write.mode(mode).json(f"{path}/{name.replace('.', '/')}")


def series_document(df: DataFrame, keys: Sequence[str], year: str, cols: Sequence[str], digits: int = 3) -> DataFrame:
    """Per key one JSON text with an ordered array of yearly records (bounded by the calendar)."""
    rec = F.struct(F.col(year), *[F.round(c, digits).alias(c) for c in cols])
    rows = F.array_sort(F.collect_list(rec))
    return df.groupBy(*keys).agg(F.to_json(rows).alias("document"))
