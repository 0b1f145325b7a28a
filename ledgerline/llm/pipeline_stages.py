"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from . import decontamination, mixing, ngram_join, quality_rules, sharding

MIX_SHARE, MIX_SEED = 0.9, 17


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.filter_documents(docs)


def ngram_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, and all others."""
    return ngram_join.distinct_documents(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than a trace of a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontamination.clean_documents(docs, benchmark)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents inside the budgets of their sources, one epoch at most."""
    levels = mixing.corpus_levels()
    plan = mixing.plan_mixture(docs, levels, budget_share=MIX_SHARE, max_epochs=1, seed=MIX_SEED)
    return mixing.mixed_documents(docs, plan, levels, seed=MIX_SEED)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and place in the shard of every document that is left."""
    return sharding.shard_documents(docs, scratch_path(spark, "pipeline-slot_map"))
