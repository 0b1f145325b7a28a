"""Registered queries of the subpackage: each applies one operator to its
whole table with production parameters and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import (decontamination, filter_audit, html_blocks, license_scan, mixing, ngram_join, oracles,
               preferences, quality_rules, sharding, simhash_join, source_audit, suffix_dedup,
               url_rules)


MIX_EPOCHS, MIX_SEED = 3, 17


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    return url_rules.judge_pages(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"),
                                 bad)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.label_documents(_table(spark, sf_dir, "documents"))


def op3_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = preferences.ordered_turns(_table(spark, sf_dir, "conversations"))
    return preferences.format_preferences(turns, preferences.neighbour_pairs(turns))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(_table(spark, sf_dir, "documents"),
                                      scratch_path(spark, "slot_map"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op5_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract_pages(_table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontamination.judge_documents(_table(spark, sf_dir, "documents"),
                                             _table(spark, sf_dir, "benchmark"))
    return judged.select("doc_id", "n_words", "n_hit",
                         F.size("items").cast("long").alias("n_items"),
                         F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                         "contaminated")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge_documents(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.dedup_documents(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed",
                      F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = mixing.corpus_levels()
    plan = mixing.plan_mixture(_table(spark, sf_dir, "documents"), levels, budget_share=1.0,
                               max_epochs=MIX_EPOCHS, seed=MIX_SEED)
    return mixing.epochs_of(plan, levels, seed=MIX_SEED)


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_join.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
                        .alias("fingerprint"), "component_id")


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit_sources(_table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(_table(spark, sf_dir, "documents"),
                                        _table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_url_filter": op1_url_filter,
        "op2_license_scan": op2_license_scan,
        "op3_preferences": op3_preferences,
        "op4_sharding": op4_sharding,
        "op5_html_blocks": op5_html_blocks,
        "op6_decontamination": op6_decontamination,
        "op7_quality_rules": op7_quality_rules,
        "op8_ngram_join": op8_ngram_join,
        "op9_mixing": op9_mixing,
        "op10_suffix_dedup": op10_suffix_dedup,
        "op11_simhash_dedup": op11_simhash_dedup,
        "op12_source_audit": op12_source_audit,
        "op13_filter_audit": op13_filter_audit,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the queries that SQL can express on whole tables."""
    return dict(oracles.ORACLES)
