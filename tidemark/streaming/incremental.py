"""Incremental partial aggregates: every micro-batch stores its own part, parts are merged when read."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.mergeable import merge_range, merge_sums, partial_range, partial_sums
from tidemark.sources.staging import staging_dir


def store_parts(
    stream: DataFrame,
    keys: Sequence[str],
    value: str,
    parts_dir: str,
    kind: str = "sums",
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Write the partial aggregate of each batch to its own folder.

    A batch that is replayed after a failure overwrites its folder, so every row counts once.
    """
    partial: Callable[..., DataFrame] = partial_sums if kind == "sums" else partial_range

    def write(batch: DataFrame, batch_id: int) -> None:
        partial(batch, keys, value).write.mode("overwrite").parquet(f"{parts_dir}/batch={batch_id}")

    place = checkpoint or f"{staging_dir(stream.sparkSession)}/stream-{hashlib.md5(parts_dir.encode()).hexdigest()}"
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", place)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def merged_parts(spark: SparkSession, parts_dir: str, keys: Sequence[str], value: str, kind: str = "sums") -> DataFrame:
    """Final aggregate over all stored parts."""
    parts = spark.read.parquet(parts_dir).drop("batch")
    return merge_sums([parts], keys, value) if kind == "sums" else merge_range([parts], keys)


def compact(spark: SparkSession, parts_dir: str, out_dir: str, keys: Sequence[str], value: str, kind: str = "sums") -> None:
    """Replace many small parts by one merged part in a new folder."""
    merged_parts(spark, parts_dir, keys, value, kind).write.mode("overwrite").parquet(f"{out_dir}/batch=0")
