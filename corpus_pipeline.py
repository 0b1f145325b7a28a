"""Corpus pipeline: stages over ``documents``, each written and read again.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor
kept and returns a DataFrame; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import pipeline_stages as stages
from ledgerline.session import scratch_path

STAGES = [
    ("quality_rules", stages.quality_rules_stage),
    ("ngram_join", stages.ngram_join_stage),
    ("decontamination", stages.decontamination_stage),
    ("mixing", stages.mixing_stage),
    ("sharding", stages.sharding_stage),
]

#: The stages hash and cluster in ways SQL cannot express; tests compare each
#: one with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
