"""Intermediate tables in the shared folder of the cluster: lineage is cut and executors may be lost."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
#: Spark gives back the shuffle files of a statement as soon as it has ended
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staging_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``; a temporary one only for a local master without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL[app]


def staged(df: DataFrame) -> DataFrame:
    """Write an aggregate that later steps read several times, and read it back.

    Shuffle files of the write are given back at its end: nothing reads them again, and a job of many steps would
    otherwise keep those of every step until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{staging_dir(spark)}/stage-{uuid.uuid4().hex}"
    before = spark.conf.get(_RELEASE, "false")
    spark.conf.set(_RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)
