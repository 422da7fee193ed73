"""Daily aggregates of a measurement stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.mergeable import day_value


def stream_daily(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    series: str | None = None,
    watermark: str = "2 days",
) -> DataFrame:
    """UTC-day value and number of members per key; the watermark bounds the state.

    The value is the mean, or follows the last word of the series name when ``series`` is given.
    """
    t = stream.where(F.col(value).isNotNull()).withColumn("__ts", F.col(ts).cast("timestamp"))
    agg = day_value(F.col(series), F.col(value)) if series else F.avg(value)
    days = (
        t.withWatermark("__ts", watermark)
        .groupBy(F.window("__ts", "1 day").alias("__w"), *keys)
        .agg(agg.alias("value"), F.min(value).alias("v_min"), F.max(value).alias("v_max"), F.count(F.lit(1)).cast("int").alias("n_hours"))
    )
    return days.select(*keys, F.to_date("__w.start").alias("date"), "value", "v_min", "v_max", "n_hours")
