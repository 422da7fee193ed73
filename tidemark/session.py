"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that decide results or plan shape; sizes are left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # no call-site capture per column expression: plans are built faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; keys in ``extra`` use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, val in SETTINGS.items():
        builder = builder.config(key, val)
    for key, val in extra.items():
        builder = builder.config(key.replace("_", "."), val)
    return builder.getOrCreate()
