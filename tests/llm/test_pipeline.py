"""The corpus pipeline against the plain versions of its stages."""

import brute
import corpus_pipeline
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__ as E
from ledgerline.llm import pipeline_stages, quality_rules, queries

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _rows(frame):
    return [(r.doc_id, r.text) for r in frame.collect()]


def test_stages_follow_the_plain_versions(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r.doc_id for r in quality_rules.judge_documents(docs).where("kept").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    expected = {
        "quality_rules": lambda rows: kept,
        "ngram_join": lambda rows: {d for d, _, c in brute.near_duplicates(rows) if d == c},
        "decontamination": lambda rows: {x[0] for x in brute.contamination(rows, items) if not x[-1]},
    }
    for name, stage in corpus_pipeline.STAGES[:3]:
        before = _rows(docs)
        docs = spark.createDataFrame(stage(spark, docs, sf).collect(), docs.schema)
        assert docs.columns == DOCUMENT_COLUMNS
        assert {r.doc_id for r in docs.collect()} == expected[name](before), name
        assert docs.count() < len(before), name


def test_run_returns_every_document_that_is_left(spark):
    out = E.queries()["pipeline"](spark, SF_SMALL).collect()
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    ids = {r.doc_id for r in out}
    assert len(ids) == len(out) and ids <= {d for d, _ in _rows(docs)} and ids
    by_shard = {}
    for r in out:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert set(by_shard) <= set(range(40))


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_on_no_documents(spark, name, stage):
    none = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(0)
    assert stage(spark, none, SF_SMALL).count() == 0


def test_mixing_stage_keeps_columns_and_budget(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn(
        "tokens", F.lit("clash"))
    kept = pipeline_stages.mixing_stage(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns

    def words(frame):
        return sum(len(brute.blank_words(t)) for _, t in _rows(frame))
    share = words(kept) / words(docs)
    assert 0.85 < share <= pipeline_stages.MIX_SHARE


def test_every_operator_has_a_query():
    names = {n.split("_")[0] for n in queries.queries()}
    assert names == {f"op{i}" for i in range(1, 14)}
    assert set(queries.oracle_sql()) <= set(queries.queries())
