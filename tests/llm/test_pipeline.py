"""The pipeline's stages, each on its own input, and what they leave."""

from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontaminate, jaccard_join

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 4 and corpus_pipeline.ORACLE_SQL is None
    near = corpus_pipeline.drop_near_copies(spark, docs, SF)
    groups = jaccard_join.link_groups(docs)
    assert near.columns == docs.columns and near.count() == groups.select("component_id").distinct().count()
    clean = corpus_pipeline.drop_leaks(spark, docs, SF)
    hit = decontaminate.find_overlap(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).where(F.size("spans") > 0)
    assert clean.columns == docs.columns and clean.count() == docs.count() - hit.count()
    assert corpus_pipeline.drop_toxic(spark, docs, SF).columns == docs.columns
    assert {"doc_id", "n_tokens", "ids_sha256"} <= set(corpus_pipeline.encode(spark, docs, SF).columns)
