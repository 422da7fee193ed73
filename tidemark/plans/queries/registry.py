"""Named queries over the test tables, each with an independent SQL form where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Runner
    sql: str | None
    ids: str


REGISTRY: dict[str, Query] = {}


def query(name: str, ids: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    """Register a query; ``ids`` names the operators of the survey it shows."""

    def wrap(fn: Runner) -> Runner:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(name, fn, sql, ids)
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6, skip: Sequence[str] = ()) -> DataFrame:
    """Floating point columns rounded for comparison."""
    return df.select(
        *[F.round(F.col(c), digits).alias(c) if t == "double" and c not in skip else F.col(c) for c, t in df.dtypes]
    )


def lines_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly quantity per supplier as a station series ``(entity, year, month, value)``."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(
        F.col("l_suppkey").alias("entity"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
    ).agg(F.sum("l_quantity").alias("value"))


MONTHLY_SQL = """
m AS (SELECT l_suppkey AS entity, CAST(year(l_shipdate) AS INTEGER) AS year,
             CAST(month(l_shipdate) AS INTEGER) AS month, sum(l_quantity) AS value
      FROM lineitem GROUP BY 1, 2, 3)"""


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a daily series ``(user_id, event_type, date, value, n_hours)`` with whole cents."""
    ev = table(spark, sf_dir, "events")
    return ev.groupBy("user_id", "event_type", F.to_date("ts").alias("date")).agg(
        F.max("value").alias("value"), F.count(F.lit(1)).cast("int").alias("n_hours")
    )


DAILY_SQL = """
d AS (SELECT user_id, event_type, CAST(ts AS DATE) AS date, max(value) AS value,
             CAST(count(*) AS INTEGER) AS n_hours
      FROM events GROUP BY 1, 2, 3)"""
