"""A corpus pipeline: toxic documents go, one of each group of near copies stays, test passages go, the rest is encoded."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, jaccard_join, queries, toxicity
from tidemark.llm._common import staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the calibrated toxicity of their language."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), queries.usable_for_training())
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at 0.8 or more, the one with the smallest id."""
    return jaccard_join.keep_one(docs, size=5, threshold="0.8")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of ten words of a benchmark item."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of the encoded and decoded texts."""
    return queries.digests(docs, public_tokenizers.path(queries.VOCABULARY))


STAGES = [("toxicity", drop_toxic), ("jaccard join", drop_near_copies), ("decontamination", drop_leaks), ("bpe", encode)]

#: Training and byte-pair merging have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another on ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
