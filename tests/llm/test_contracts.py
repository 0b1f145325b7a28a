"""Registered queries against plain Python, on the smallest tables and on a
fixture with nulls, empty and long texts, ties, repeated texts and clashing
columns."""

import hashlib
import random
import time

import brute
import pytest
from conftest import SF_SMALL
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerline.llm import (decontamination, html_blocks, license_scan, mixing, ngram_join,
                            preferences, quality_rules, queries, sharding, suffix_dedup, tables,
                            url_rules)

LICENSE = "Released under the MIT License. Licensed under CC BY-NC 4.0."


def fixture_rows():
    """(doc_id, text) with awkward texts and planted copies."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    base = prose(300)
    edited = base.split(" ")
    edited[20] = edited[150] = "Änderung"
    half = base.split(" ")[:150]
    passage = prose(60)
    texts = [None, "", " \t\n", "one", "one two three", "ONE two THREE", base, base, base.upper(),
             " ".join(edited), " ".join(half) + " " + prose(150), prose(40) + " " + passage,
             passage + "\n" + prose(200), prose(30) + passage + prose(30), LICENSE,
             "x " * 30, ("la li lu " * 400), prose(9000), "é" * 250, "é" * 250 + "z", "a" * 99,
             "a" * 100, "a" * 101, "\x00\x01 nul \x00", "a|b|c #tag 100% & <b>", "Apache License, "
             "Version 2.0, under the MIT license under the mit license cc by nc cc by nc",
             "line one\nline one\n\n\nline two\nline one", "日本語 テキスト 日本語 テキスト " * 20,
             prose(25) + " " + " ".join(edited[40:120])]
    return list(enumerate(texts, 1))


DOCS_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows():
    return fixture_rows()


@pytest.fixture(scope="module")
def documents(spark, rows):
    made = [(i, t, None if i % 7 == 0 else "en", None if i % 9 == 0 else f"src{i % 3}",
             None if t is None else len(t)) for i, t in rows]
    frame = spark.createDataFrame(made, DOCS_SCHEMA)
    # names that the operators use themselves
    for name in ("label", "size", "hash", "n", "row", "slot", "shard", "words", "token", "set", "node"):
        frame = frame.withColumn(name, F.lit("clash"))
    return frame.repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS_SCHEMA)


def small_docs(spark):
    return [(r.doc_id, r.text) for r in
            spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]


def got(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


def same(frame, expected):
    assert sorted((tuple(r) for r in frame.collect()), key=repr) == sorted(expected, key=repr)


# -- 7 -----------------------------------------------------------------------

QUALITY = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
           "base_failed")


def test_quality_on_table(spark):
    same(queries.op7_quality_rules(spark, SF_SMALL).select(*QUALITY),
         [(d, *brute.quality(t)) for d, t in small_docs(spark)])


def test_quality_on_fixture(documents, rows):
    judged = quality_rules.judge_documents(documents)
    same(judged.select(*QUALITY), [(d, *brute.quality(t)) for d, t in rows])
    kept = {r.doc_id for r in judged.where("kept").collect()}
    filtered = quality_rules.filter_documents(documents)
    assert filtered.columns == documents.columns
    assert {r.doc_id for r in filtered.collect()} == kept


def test_quality_keeps_good_labels(spark):
    judged = queries.op7_quality_rules(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    wrong = judged.join(labels, "doc_id").where(
        (F.col("quality") == 1) & ~F.col("base_failed") & ~F.col("kept"))
    assert wrong.count() == 0


def test_quality_empty(nothing):
    assert quality_rules.judge_documents(nothing).count() == 0
    assert quality_rules.filter_documents(nothing).count() == 0


def test_quality_cascade_works_out_what_is_undecided(spark, monkeypatch):
    # a metric that fails on documents the base rules have decided
    plain = quality_rules.METRICS["n_exclamations"]
    monkeypatch.setitem(quality_rules.METRICS, "n_exclamations", lambda t: F.when(
        F.length(t) < 20, F.raise_error(F.lit("decided before")).cast("long")).otherwise(plain(t)))
    monkeypatch.setattr(quality_rules, "estimate_rules", lambda d, rules, *_: {
        r.name: (1.0, 0.1) for r in rules})
    frame = spark.createDataFrame([(1, "short"), (2, " ".join(f"word{i}!!" for i in range(40)))],
                                  "doc_id long, text string")
    judged = quality_rules.judge_documents(frame).collect()
    assert {r.doc_id: r.failed_rule for r in judged} == {1: "too_few_words", 2: "exclamations"}


def test_rules_run_by_rejection_per_cost():
    rules = quality_rules.RULES
    estimates = {r.name: (10.0, 0.1) for r in rules}
    estimates["capitals"] = (10.0, 0.5)
    estimates["word_length"] = (1.0, 0.1)
    names = [r.name for r in quality_rules.order_rules(rules, estimates)]
    assert names[:2] == ["word_length", "capitals"]


# -- 4 -----------------------------------------------------------------------

def check_shards(placed, rows, n_shards):
    by_id = {d: brute.record(t) for d, t in rows}
    assert {(r.doc_id, r.size, r.text_crc32) for r in placed} == {
        (d, *x) for d, x in by_id.items()}
    loads = {i: 0 for i in range(n_shards)}
    slots = {}
    for r in placed:
        loads[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    return loads


def test_sharding_on_table(spark):
    placed = queries.op4_sharding(spark, "/root/testdata/sf0.01").collect()
    rows = [(r.doc_id, r.text) for r in
            spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    loads = check_shards(placed, rows, 40)
    mean = sum(loads.values()) / 40
    assert max(loads.values()) <= 1.02 * mean and min(loads.values()) >= 0.98 * mean
    assert {(r.law, r.grown_shard) for r in placed} == {("bytes", None)}


def test_sharding_on_fixture(documents, rows, nothing, tmp_dir):
    placed = sharding.shard_documents(documents, tmp_dir, n_shards=3, n_slots=64).collect()
    check_shards(placed, rows, 3)
    assert sharding.shard_documents(nothing, tmp_dir + "/e", n_shards=3, n_slots=64).count() == 0


def test_rebalancing_moves_only_what_overfills(spark, tmp_dir):
    weights = spark.range(64).select(F.col("id").cast("int").alias("vslot"),
                                     (F.col("id") + 1).alias("bytes"), F.lit(1).alias("rows"))
    v0 = sharding.initial_map(spark, 64, 4)
    v1 = sharding.store_map(sharding.rebalanced_map(v0, weights, 4), tmp_dir)
    v2 = sharding.store_map(sharding.rebalanced_map(v1.drop("bytes"), weights, 4), tmp_dir)
    assert [r.version for r in v2.select("version").distinct().collect()] == [2]
    moved = v0.select("vslot", F.col("shard").alias("old")).join(v1, "vslot").where("old <> shard")
    assert moved.count() <= 8
    loads = [r.b for r in v1.groupBy("shard").agg(F.sum("bytes").alias("b")).collect()]
    assert max(loads) - min(loads) <= 64
    assert v1.select("vslot").distinct().count() == 64
    assert spark.read.parquet(tmp_dir).select("version").distinct().count() == 2


def test_sharding_edits_the_stored_map(spark, tmp_dir):
    path = tmp_dir + "/slots"
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(
        F.lit("x"), (F.col("id") % 97).cast("int")).alias("text"))
    shard = lambda d: {r.virtual_slot: (r.shard, r.map_version) for r in sharding.shard_documents(
        d, path, n_shards=4, n_slots=64).collect()}
    first = shard(docs)
    stored = {r.version for r in spark.read.parquet(path).select("version").distinct().collect()}
    assert stored == {0, 1} and {v for _, v in first.values()} == {1}
    heavy = docs.withColumn("text", F.when(F.col("doc_id") < 40, F.repeat(F.lit("y"), 500))
                            .otherwise(F.col("text")))
    second = shard(heavy)
    v1 = spark.read.parquet(f"{path}/version=1").withColumn("version", F.lit(1)).drop("bytes")
    weights = sharding.slot_bytes(sharding.records_of(heavy, n_slots=64))
    expected = {r.vslot: (r.shard, 2)
                for r in sharding.rebalanced_map(v1, weights, 4).collect()}
    assert second == {k: expected[k] for k in second}
    with pytest.raises(ValueError):
        sharding.shard_documents(docs, path, n_shards=4, n_slots=32)


def test_sharding_hot_key(spark, tmp_dir):
    """A key that holds most rows, equal and unequal ones, and null keys."""
    docs = spark.range(4000).select(
        F.when(F.col("id") % 10 == 0, F.col("id")).when(F.col("id") % 10 < 3, F.lit(None))
        .otherwise(F.lit(7)).cast("long").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, F.lit("same text")).otherwise(
            F.concat(F.lit("text "), F.col("id") % 300)).alias("text")).repartition(5)
    placed = sharding.shard_documents(docs, tmp_dir, n_shards=3, n_slots=64)
    out = placed.collect()
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    expected = docs.groupBy("doc_id", F.octet_length("text") + 16).count().collect()
    got = placed.groupBy("doc_id", "size").count().collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, map(tuple, expected)))
    assert len({r.shard for r in out if r.doc_id == 7}) == 1


def test_sharding_map_version_is_written_once(spark, tmp_dir):
    v0 = sharding.store_map(sharding.initial_map(spark, 64, 4), tmp_dir)
    weights = spark.range(64).select(F.col("id").cast("int").alias("vslot"), (F.col("id") + 1).alias("bytes"))
    first = sharding.store_map(sharding.rebalanced_map(v0, weights, 4), tmp_dir).collect()
    with pytest.raises(AnalysisException):
        sharding.store_map(sharding.rebalanced_map(v0, weights, 4), tmp_dir)
    assert spark.read.parquet(f"{tmp_dir}/version=1").count() == len(first) == 64


# -- 2 -----------------------------------------------------------------------

LICENSE_COLUMNS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def test_license_scan_on_table(spark):
    found = queries.op2_license_scan(spark, "/root/testdata/sf0.01")
    rows = [(r.doc_id, r.text) for r in
            spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    same(found.select(*LICENSE_COLUMNS),
         [(d, *brute.licenses(t, license_scan.BASE_PHRASES)) for d, t in rows])
    gpl = {d for d, t in rows if "GNU General Public License, version 3" in t}
    assert gpl and gpl == {r.doc_id for r in found.where("labels like '%gpl-3%'").collect()}


def test_license_scan_on_fixture(documents, rows, nothing):
    found = license_scan.label_documents(documents)
    same(found.select(*LICENSE_COLUMNS),
         [(d, *brute.licenses(t, license_scan.BASE_PHRASES)) for d, t in rows])
    assert found.where("score < 0 or score > 1 or n_base > 0 and score < 1").count() == 0
    assert license_scan.label_documents(nothing).count() == 0


def test_license_scan_merges_neighbouring_diagonals(spark):
    text = ("permission is hereby granted free of charge to any kind person obtaining a copy of "
            "this software and associated documentation files")
    frame = spark.createDataFrame([(1, text), (2, "permission is hereby granted free")],
                                  "doc_id long, text string")
    labels = {r.doc_id: (r.labels, r.n_base) for r in license_scan.label_documents(frame).collect()}
    assert labels == {1: ("mit", 0), 2: ("", 0)}


def test_license_scan_standard_notices(spark):
    notices = {
        "it under the terms of the GNU General Public License as published by the Free Software "
        "Foundation, either version 3 of the License": "gpl-3",
        "it under the terms of the GNU General Public License as published by the Free Software "
        "Foundation; either version 2 of the License": "gpl-2",
        "it under the terms of the GNU Lesser General Public License as published by the Free "
        "Software Foundation, either version 3 of the License": "lgpl",
        "is subject to the terms of the Mozilla Public License, v. 2.0.": "mpl-2",
        "under a Creative Commons Attribution 4.0 International License": "cc-by",
        "under a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc",
        "Licensed under the GNU Lesser General Public License, version 3": "lgpl",
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.": "mit",
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.": "bsd",
        # words put into or left out of a short template
        "licensed under the well known Apache License, Version 2.0": "apache-2",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "the GNU General Public in its License": "",
        "Creative Commons and attribution of works": ""}
    frame = spark.createDataFrame(list(enumerate(notices)), "doc_id long, text string")
    found = {r.doc_id: r.labels for r in license_scan.label_documents(frame).collect()}
    assert found == dict(enumerate(notices.values()))


def test_license_scan_bounds(spark, monkeypatch):
    page = spark.createDataFrame([(1, "Copyright 2001 Site. All rights reserved.")],
                                 "doc_id long, text string")
    assert [r.labels for r in license_scan.label_documents(page).collect()] == [""]
    monkeypatch.setattr(license_scan, "BROADCAST_ROWS", 3)
    with pytest.raises(ValueError):
        license_scan.label_documents(page)


def test_license_scan_with_templates_of_a_table(spark):
    frame = spark.createDataFrame(
        [(1, "use it as the house \\' rules of our own say"), (2, "licensed under CC BY 4.0")],
        "doc_id long, text string")
    own = spark.createDataFrame([("o'wn", "the house rules of our own", "rules of our"),
                                 ("own", "x", None)], "label string, text string, keys string")
    found = license_scan.label_documents(frame, templates=own).collect()
    assert {r.doc_id: r.labels for r in found} == {1: "o'wn", 2: ""}
    none = license_scan.label_documents(frame, templates=own.limit(0)).collect()
    assert {r.labels for r in none} == {""}


# -- 1 -----------------------------------------------------------------------

URLS = [None, "", "no scheme", "http://Example.ORG/es/1?x=1", "https://a.example.org/en/12#t",
        "https://example.org", "http://notexample.org/en/1", "ftp://b.com/fr/", "http://b.com/de/9",
        "http://b.com/de", "x://h?q=/fr/", "http://u.net/a//b/?k&k=2&=3", "http://u.net/a//b/?k&k=2&=3",
        "http://" + "a." * 300 + "org/" + "p/" * 500]


def test_url_parts_and_rules(spark):
    rules = [(r.verdict, r.text) for r in url_rules.PATH_RULES]
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    labels = spark.createDataFrame([(11, 0, 0), (12, 1, 0)], "doc_id long, quality int, toxic int")
    out = url_rules.judge_pages(pages, labels, F.col("quality") == 0).collect()
    assert len(out) == len(URLS)
    for r in out:
        host, path = brute.url_parts(URLS[r.page_id])
        rule = brute.url_rule(host, path, rules)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule[0])
        assert r.verdict == rule[1] if rule else r.verdict in ("allow", "block")


def test_url_rules_on_table(spark):
    rules = [(r.verdict, r.text) for r in url_rules.PATH_RULES]
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    out = queries.op1_url_filter(spark, SF_SMALL).collect()
    assert {r.page_id for r in out} == set(pages) and len(out) == len(pages)
    for r in out:
        host, path = brute.url_parts(pages[r.page_id])
        rule = brute.url_rule(host, path, rules)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule[0])


def test_mined_rules_match_brute_force(spark):
    rng = random.Random(3)
    hosts = ["spam.net", "good.net", "mixed.net"]
    data = []
    for i in range(300):
        host = rng.choice(hosts)
        path = rng.choice(["a", "b", "c"])
        bad = host == "spam.net" and path != "c" or host == "mixed.net" and path == "b"
        data.append((i, f"http://{host}/{path}/{i % 5}", bad))
    pages = spark.createDataFrame([(i, u) for i, u, _ in data], "page_id long, url string")
    labels = spark.createDataFrame([(i, int(b)) for i, _, b in data], "doc_id long, bad int")
    rules = url_rules.mine_rules(pages, labels, "url", F.col("bad") == 1, min_support=0.02,
                                 min_confidence=0.7)
    mined = [(frozenset(r.tokens), r.verdict, r.confidence, r.support) for r in rules.collect()]
    tokens = {r.url: set(r.t) for r in pages.select(
        "url", url_rules.url_tokens(F.col("url")).alias("t")).collect()}
    for part, verdict, confidence, support in mined:
        held = [b for _, u, b in data if part <= tokens[u]]
        right = sum(b == (verdict == "block") for b in held)
        assert abs(right / len(held) - confidence) < 1e-9 and abs(right / 300 - support) < 1e-9
        assert not any(p < part and v == verdict and c >= confidence for p, v, c, _ in mined)
    best = {r.url: (r.verdict, r.confidence) for r in url_rules.match_rules(pages, rules).collect()}
    for url, held in tokens.items():
        fits = [(c, v) for p, v, c, _ in mined if p <= held]
        assert (url in best) == bool(fits)
        if fits:
            assert best[url][1] == max(fits)[0]


def test_url_rules_without_labels_or_pages(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = url_rules.judge_pages(pages, labels, F.col("quality") == 0)
    assert out.where("rule is null and verdict <> 'allow'").count() == 0
    assert url_rules.judge_pages(pages.limit(0), labels, F.col("quality") == 0).count() == 0


# -- 6 -----------------------------------------------------------------------

def judged_digest(frame):
    return frame.select("doc_id", "n_words", "n_hit", F.size("items").cast("long"),
                        F.sha2(F.array_join("items", ","), 256), "contaminated")


def test_decontamination_on_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    expected = brute.contamination(docs, items)
    assert any(x[-1] for x in expected)
    same(queries.op6_decontamination(spark, sf), expected)


def test_decontamination_on_fixture(spark, documents, rows, nothing):
    texts = dict(rows)
    items = [(1, " ".join(texts[7].split()[40:70])), (2, "one two three"), (3, None), (4, ""),
             (5, "one"), (6, "MIT license, under CC"), (7, texts[7].upper()), (7, "la li lu la li lu"),
             (10, "é" * 250)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    same(judged_digest(decontamination.judge_documents(documents, bench)),
         brute.contamination(rows, items))
    clean = decontamination.clean_documents(documents, bench)
    assert clean.columns == documents.columns
    assert {r.doc_id for r in clean.collect()} == {
        x[0] for x in brute.contamination(rows, items) if not x[-1]}
    same(judged_digest(decontamination.judge_documents(documents, bench.limit(0))),
         brute.contamination(rows, []))
    assert decontamination.judge_documents(nothing, bench).count() == 0


# -- 8 -----------------------------------------------------------------------

def test_near_duplicates_on_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = brute.near_duplicates(docs)
    assert len({x[2] for x in expected}) < len(expected) - 50
    same(queries.op8_ngram_join(spark, sf), expected)


def test_near_duplicates_on_fixture(documents, rows, nothing):
    same(ngram_join.near_duplicates(documents), brute.near_duplicates(rows))
    kept = ngram_join.distinct_documents(documents)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {
        d for d, _, c in brute.near_duplicates(rows) if d == c}
    assert ngram_join.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("least, rows_broadcast", [(-1, 200_000), (-1, 0), (3, 200_000)])
def test_near_duplicates_of_hot_shingles(spark, monkeypatch, least, rows_broadcast):
    """Cells of all or of frequent shingles summed before the shuffle, and
    joined back by broadcast or with salted keys."""
    monkeypatch.setattr(ngram_join, "HOT_PARTS", 10**12)
    monkeypatch.setattr(ngram_join, "HOT_LEAST", least)
    monkeypatch.setattr(tables, "BROADCAST_ROWS", rows_broadcast)
    rng = random.Random(4)
    common = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(60):
        words = common + [f"v{rng.randrange(3)}x{j}" for j in range(rng.choice([4, 8, 30]))]
        if i % 4 == 0:
            words[i % 40] = f"edit{i}"
        rows.append((i, " ".join(words)))
    frame = spark.createDataFrame([*rows, (None, rows[3][1]), (None, "a text of its very own words")],
                                  "doc_id long, text string")
    found = ngram_join.near_duplicates(frame)
    expected = {d: c for d, _, c in brute.near_duplicates(rows)}
    same(found.where("doc_id IS NOT NULL"), brute.near_duplicates(rows))
    assert len(set(expected.values())) < len(rows)
    without = [r.component_id for r in found.where("doc_id IS NULL").collect()]
    assert sorted(without, key=str) == sorted([expected[3], None], key=str)


def test_near_duplicates_in_chains_and_tiles(spark, monkeypatch):
    """Chains of slightly different texts, and cells cut into tiles."""
    monkeypatch.setattr(ngram_join, "TILE", 4)
    rng = random.Random(11)
    words = [f"w{i}" for i in range(500)]
    rows, text = [], [rng.choice(words) for _ in range(120)]
    for i in range(60):
        rows.append((100 - i, " ".join(text)))
        for _ in range(2 if i % 3 else 5):
            text[rng.randrange(120)] = rng.choice(words)
    for i in range(40):     # one shared passage, otherwise different
        rows.append((200 + i, " ".join(text[:40] + [rng.choice(words) for _ in range(60)])))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    same(ngram_join.near_duplicates(frame), brute.near_duplicates(rows))


def test_rtree_bound_loses_no_pair():
    import numpy as np
    rng = np.random.default_rng(2)
    points = rng.integers(0, 6, (150, ngram_join.GROUPS)).astype(np.int32)
    points[75:] = np.maximum(points[:75] + rng.integers(-1, 2, (75, ngram_join.GROUPS)), 0)
    sizes = points.sum(axis=1).astype(np.int64)
    tree = ngram_join.RTree(points, sizes, leaf=8)
    found = {tuple(sorted(p)) for x, y in tree.pairs(tree, True) for p in zip(x.tolist(), y.tolist())}
    expected = {(i, j) for i in range(150) for j in range(i + 1, 150)
                if 7 * np.minimum(points[i], points[j]).sum() >= 3 * (sizes[i] + sizes[j])}
    assert found == expected and expected


# -- 10 ----------------------------------------------------------------------

def cut_digest(frame):
    return frame.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long"),
                        F.sha2("kept", 256))


def test_suffix_dedup_on_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = brute.suffix_dedup(docs)
    assert sum(x[2] for x in expected) > 0
    same(queries.op10_suffix_dedup(spark, sf), expected)


def test_suffix_dedup_on_fixture(documents, rows, nothing):
    same(cut_digest(suffix_dedup.dedup_documents(documents)), brute.suffix_dedup(rows))
    assert suffix_dedup.dedup_documents(nothing).count() == 0


def test_suffix_dedup_without_hot_copies(documents, rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_SHARE", 0)
    monkeypatch.setattr(suffix_dedup, "COMBINE_BYTES", 2000)
    same(cut_digest(suffix_dedup.dedup_documents(documents)), brute.suffix_dedup(rows))


def test_multikey_order_sorts_rows():
    import numpy as np
    rng = np.random.default_rng(4)
    words = rng.integers(0, 3, (500, 5)).astype(np.uint64)
    order, differs = suffix_dedup.multikey_order(words)
    as_rows = [tuple(r) for r in words[order].tolist()]
    assert as_rows == sorted(map(tuple, words.tolist()))
    assert differs.tolist() == [next((j for j in range(5) if a[j] != b[j]), 5)
                                for a, b in zip(as_rows, as_rows[1:])]


# -- 9 -----------------------------------------------------------------------

def domain(source):
    return ("unknown" if source is None else "hub" if source == "src0"
            else "wide" if len(source) == 4 else "tail")


WEIGHTS = (lambda x: {"hub": 30, "wide": 40, "tail": 30}.get(x, 5),
           lambda x: {"en": 50, "de": 20, "fr": 15, "es": 15}.get(x, 5), lambda x: 1)


def mix_rows(frame):
    return [(r.doc_id, len(brute.blank_words(r.text)),
             (domain(r.source), r.lang or "unknown", r.source or "unknown")) for r in frame.collect()]


def test_mixing_on_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    expected = brute.mixture(mix_rows(docs), WEIGHTS, queries.MIX_SEED, 1.0, queries.MIX_EPOCHS)
    same(queries.op9_mixing(spark, "/root/testdata/sf0.01").select("doc_id", "epoch"), expected)


@pytest.mark.parametrize("share,epochs", [(1.0, 1), (0.4, 1), (1.0, 4), (0.0, 2)])
def test_mixing_on_fixture(documents, share, epochs):
    levels = mixing.corpus_levels()
    plan = mixing.plan_mixture(documents, levels, share, epochs, seed=9)
    expected = brute.mixture(mix_rows(documents), WEIGHTS, 9, share, epochs)
    taken = mixing.epochs_of(plan, levels, seed=9).where("tokens > 0").select("doc_id", "epoch")
    costs = {r[0]: r[1] for r in mix_rows(documents)}
    same(taken, [x for x in expected if costs[x[0]]])
    kept = mixing.mixed_documents(documents, plan, levels, seed=9)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect() if costs[r.doc_id]} == {
        d for d, _ in expected if costs[d]}


def test_mixing_empty(nothing):
    levels = mixing.corpus_levels()
    plan = mixing.plan_mixture(nothing, levels)
    assert mixing.epochs_of(plan, levels).count() == 0
    assert mixing.mixed_documents(nothing, plan, levels).count() == 0


# -- 5 -----------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>x("</p>")</script>
</head><body class="has-sidebar"><header>Site</header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies, please read all about what we do with them here.</div>
<div class="ad">Buy now</div>%s<aside>Other news of the day that nobody asked to read</aside>
<form><input><p>Your name and your e-mail address please</p></form>
<footer>&copy; 2001 Site &middot; imprint</footer></body></html>"""
ARTICLE = """<article><header><h1>Caf&eacute; &amp; <i>more</i></h1></header>
<p>First   paragraph<p>Second &lt;b&gt;
 line &#39;x&#39;<div class="ad">Ad inside</div><p>Be.</p><ul><li>one<li>two</ul>
<section class="comments"><p>Reader: a long comment on the story that goes on for a while.</p></section>
</article>"""
LONG = "A sentence that is long enough to be the body of some page without a marked article. "


def test_html_article():
    text = html_blocks.main_text(PAGE % ARTICLE)
    assert text == "Café & more\nFirst paragraph\nSecond <b> line 'x'\nBe.\none\ntwo"


def test_html_without_article():
    body = f"<div><h2>Head</h2><p>{LONG}</p><p>{LONG}</p><p>Short.</p></div>"
    assert html_blocks.main_text(PAGE % body) == "\n".join(
        ["Head", LONG.strip(), LONG.strip(), "Short."])


@pytest.mark.parametrize("opening", [
    '<div style="overflow: hidden">', '<div title="the hidden gem">', "<div data-x='a hidden b'>",
    '<section id="discussion">', '<section id="related-work">', '<section id="share-of-renewables">',
    '<div class="notice">', '<div class="search-results">', '<div id="comment-on-the-method">'])
@pytest.mark.parametrize("page", [f"<article><h1>Head</h1>%s<p>{LONG}</p></article>",
                                  f"<div><h1>Head</h1><p>{LONG}</p>%s<p>{LONG}</p></div>"])
def test_html_names_that_are_not_furniture(page, opening):
    if page.startswith("<div") and "notice" in opening:
        return      # a notice outside an article is furniture
    text = html_blocks.main_text(page % opening)
    assert text.splitlines() == ["Head"] + [LONG.strip()] * page.count(LONG)


@pytest.mark.parametrize("heading", ['<h2 id="share-of-renewables">', '<h2 id="comments">'])
def test_html_heading_slugs(heading):
    assert html_blocks.main_text(f"<article>{heading}Title</h2><p>{LONG}</p></article>") \
        == f"Title\n{LONG.strip()}"


@pytest.mark.parametrize("opening", [
    '<div hidden>', '<div class=x HIDDEN>', '<div hidden="until-found">', '<div aria-hidden="true">',
    '<div class="x related-posts">', '<div class="share-buttons">', '<div id="comments">',
    '<div class="sidebar">', '<div role="navigation">', '<div class="comment-list">'])
def test_html_furniture_inside_article(opening):
    assert html_blocks.main_text(f"<article><p>{LONG}</p>{opening}<p>{LONG}</p></div></article>") \
        == LONG.strip()


def test_html_line_lengths_decide():
    main = html_blocks.main_text
    para, close = LONG.strip(), "The end."
    short = "A single paragraph of a page that holds sixty characters, ok."
    assert main(f"<div><h1>T</h1><p>{short}</p></div>") == f"T\n{short}"
    assert main(f"<p>{para}</p>" + '<div class="ad">Buy</div>' * 4 + f"<p>{close}</p>") \
        == f"{para}\n{close}"
    linked = '<p><a href="/x">A paragraph most of which is a link</a> and a rest</p>'
    assert main(f"<div><p>{para}</p>{linked}<p>{close}</p></div>") == "\n".join(
        [para, "A paragraph most of which is a link and a rest", close])
    menu = "<ul>" + "".join(f'<li><a href="/{i}">Place {i}</a></li>' for i in range(9)) + "</ul>"
    assert main(f"{menu}<p>{para}</p>{menu}") == para


@pytest.mark.parametrize("name", ["commentlist", "relatedposts", "sharebar", "commentsection",
                                  "sidenav", "postcomments", "x socialicons"])
def test_html_names_in_one_word(name):
    page = f'<article><p>{LONG}</p><ol class="{name}"><li>{LONG}</ol></article>'
    assert html_blocks.main_text(page) == LONG.strip()


@pytest.mark.parametrize("name", ["shareholder", "thread", "address", "navy", "adage", "research",
                                  "commentary", "post-header", "postheader", "entry-header"])
def test_html_words_that_hold_no_furniture(name):
    page = f'<article><div class="{name}"><h1>Head</h1></div><p>{LONG}</p></article>'
    assert html_blocks.main_text(page) == f"Head\n{LONG.strip()}"


def test_html_linked_lists():
    main, para = html_blocks.main_text, LONG.strip()
    titles = [f"Essay {i} on the history of sound" for i in range(5)]
    items = "".join(f'<li><a href="/{i}">{t}</a></li>' for i, t in enumerate(titles))
    assert main(f"<div><p>{para}</p><ul>{items}</ul></div>") == "\n".join([para, *titles])
    names = "".join(f'<li><a href="/{i}">Place {i}</a></li>' for i in range(4))
    led = "These are the places we saw on the way:"
    assert main(f"<p>{para}</p><p>{led}</p><ul>{names}</ul>") == "\n".join(
        [para, led] + [f"Place {i}" for i in range(4)])
    assert main(f"<p>{para}</p><ul>{names}</ul>") == para
    assert main(f"<article><p>{para}</p></article><ul>{items}</ul>") == para


def test_html_surge_and_dive_against_brute_force():
    rng = random.Random(8)
    for _ in range(400):
        parts, lines, inside = [], [], False
        for _ in range(rng.randint(1, 25)):
            kind = rng.random()
            if kind < 0.08:
                inside = not inside
                parts.append("<article>" if inside else "</article>")
            elif kind < 0.2:
                parts.append(f'<div class="ad">{LONG}</div>')
            elif kind < 0.5:
                parts.append('<ul><li><a href="/">Menu label</a></li></ul>')
                lines.append(("Menu label", 10 * inside, inside))
            else:
                text = "x" * rng.choice([1, 3, 12, 30, 79, 80, 200, 900])
                parts.append(f"<p>{text}</p>")
                lines.append((text, len(text), inside))
        page = "".join(parts) + "</article>" * inside
        assert html_blocks.main_text(page) == "\n".join(brute.surge_and_dive(lines)), page


@pytest.mark.parametrize("opening, closing", [("<div>", "</b>"), ("<b><div>", "</b>"), ("<b>", "</i>"),
                                              ("<div><p>", "</div>"), ("<ul><li>", "</a>")])
def test_html_long_nested_page(opening, closing):
    n = 150_000
    start = time.monotonic()
    text = html_blocks.main_text(f"<p>{LONG}</p>" + opening * n + "deep" + closing * n)
    assert text.startswith(LONG.strip())
    assert time.monotonic() - start < 30


def test_html_article_is_a_bonus():
    main, para = html_blocks.main_text, LONG.strip()
    body = "".join(f"<p>{LONG * 3}</p>" for _ in range(4))
    teaser = "<article><p>A short teaser</p></article>"
    assert main(f"<div>{body}</div>{teaser}") == "\n".join([(LONG * 3).strip()] * 4
                                                           + ["A short teaser"])
    assert main(f"<div>Skip</div><article><p>Be.</p>{body}</article><p>{para}</p>") == "\n".join(
        ["Be."] + [(LONG * 3).strip()] * 4)


@pytest.mark.parametrize("page", [None, "", " ", "<", "<p", "<!--", "<script>", "&amp", "<a b='",
                                  "</p></p>", "<title>x", "<nav><p>only menu"])
def test_html_without_text(page):
    assert html_blocks.main_text(page) in ("", "&amp")


def test_html_on_table(spark):
    import html as h
    import re
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    out = queries.op5_html_blocks(spark, SF_SMALL).collect()
    assert {r.page_id for r in out} == set(pages)
    for r in out:
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(h.unescape(x).split()) for x in re.split(
            r"</?(?:p|h1|br)>", article.replace("<b>", ""))]
        assert r.text == "\n".join(x for x in blocks if x)
        assert r.n_chars == len(r.text)


def test_html_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string, text string")
    assert html_blocks.extract_pages(pages).count() == 0
    one = spark.createDataFrame([(1, None, None, "clash")], pages.schema)
    assert [tuple(r) for r in html_blocks.extract_pages(one).collect()] == [(1, None, "", 0)]


# -- 3 -----------------------------------------------------------------------

def test_preferences(spark):
    a, u = "assistant", "user"
    turns = [(1, 0, u, "hi"), (1, 1, a, "yes"), (1, 2, u, "go"), (2, 0, u, "hi"), (2, 1, a, "no, never"),
             (3, 0, u, "other"), (3, 0, u, "other"), (3, 1, a, None), (4, 0, u, "other"),
             (4, None, None, ""), (5, 0, u, "same"), (6, 0, u, "same"), (None, 0, u, "lost"),
             (7, 0, None, None), (8, 0, u, "other")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    ordered = preferences.ordered_turns(frame.withColumn("place", F.lit("clash")))
    pairs = preferences.neighbour_pairs(ordered)
    out = {r.pair_id: r for r in preferences.format_preferences(ordered, pairs).collect()}
    r = out[1]
    assert (r.chosen_id, r.rejected_id, r.n_prompt) == (2, 1, 1)
    assert r.prompt == "<|user|>\nhi\n"
    assert r.chosen == "<|assistant|>\nno, never\n"
    start, end = map(int, r.chosen_mask.split("-"))
    assert r.chosen[start:end] == "no, never"
    assert r.rejected == "<|assistant|>\nyes\n<|user|>\ngo\n"
    start, end = map(int, r.rejected_mask.split("-"))
    assert r.rejected[start:end] == "yes"
    assert (out[5].prompt, out[5].chosen, out[5].rejected) == ("<|user|>\nsame\n", "", "")
    assert preferences.format_preferences(ordered.limit(0), pairs.limit(0)).count() == 0


def test_preferences_pair_every_conversation(spark):
    out = queries.op3_preferences(spark, SF_SMALL).collect()
    ids = [i for r in out for i in (r.chosen_id, r.rejected_id)]
    total = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id").distinct().count()
    assert len(ids) == len(set(ids)) == total // 2 * 2


def _opening_pairs(spark, openings):
    turns = [(i, n, r, t) for i, o in openings.items()
             for n, r, t in ((0, "user", o), (1, "assistant", f"answer {i}"))]
    frame = spark.createDataFrame(turns, "conv_id long, turn int, role string, text string")
    ordered = preferences.ordered_turns(frame.repartition(5))
    out = preferences.format_preferences(ordered, preferences.neighbour_pairs(ordered)).collect()
    ids = [i for r in out for i in (r.chosen_id, r.rejected_id)]
    assert len(ids) == len(set(ids)) == len(openings) // 2 * 2
    return out


def test_preferences_pair_equal_openings_of_any_ids(spark):
    # sparse ids; every opening is shared by ids far apart
    out = _opening_pairs(spark, {i * 5000 + 7: f"opening {i % 10}" for i in range(40)})
    assert all(r.n_prompt == 1 and r.prompt.startswith("<|user|>\nopening") for r in out)


def test_preferences_one_opening_over_many_ranges(spark):
    # one very common opening, an odd number of others: at most one stays alone
    openings = {i * 1009: "hot" for i in range(2001)} | {i * 1009 + 1: f"own {i}" for i in range(30)}
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = _opening_pairs(spark, openings)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert sum(r.n_prompt == 1 for r in out) == 1000
    assert len(out) == 1015


def test_digest_of_no_items():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
