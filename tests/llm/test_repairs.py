"""Row ids that survive other file splits, and bounded rule mining."""

import random
import time

import brute
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import decontamination, oracles, preferences, tables, url_rules


@pytest.fixture()
def few_rows_broadcast(monkeypatch):
    monkeypatch.setattr(tables, "BROADCAST_ROWS", 0)


# -- 6 -----------------------------------------------------------------------

def contaminated_rows():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, prose(30)) for i in range(5)]
    rows = [(i, prose(60) + (" " + items[i % 5][1] if i % 3 == 0 else "")) for i in range(60)]
    rows += [(None, items[1][1]), (None, prose(20)), (7, items[2][1]), (3, prose(40)), (9, prose(50)),
             (9, rows[9][1]), (11, None), (None, None)]
    return rows, items


@pytest.mark.parametrize("splits", [1, 40])
def test_row_ids_do_not_follow_the_splits_of_a_read(spark, splits):
    rows, items = contaminated_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = decontamination.item_windows(bench)
    scanned = decontamination.scan_documents(docs, decontamination.window_grams(windows))
    before = sorted(map(str, scanned.select("row", "doc_id", "n_words").collect()))
    spark.conf.set("spark.sql.files.minPartitionNum", splits)
    try:
        assert sorted(map(str, scanned.select("row", "doc_id", "n_words").collect())) == before
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_documents_with_null_and_repeated_ids(spark, few_rows_broadcast):
    rows, items = contaminated_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    verdicts = brute.contamination(rows, items)
    judged = decontamination.judge_documents(docs, bench)
    assert sorted(map(tuple, judged.select("doc_id", "n_words", "n_hit", "contaminated").collect()), key=repr) == \
        sorted(((d, n, h, c) for d, n, h, _, _, c in verdicts), key=repr)
    kept = sorted(((d, t) for (d, t), v in zip(rows, verdicts) if not v[-1]), key=repr)
    clean = decontamination.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=repr) == kept
    assert {(None, rows[61][1]), (3, rows[63][1]), (9, rows[64][1])} <= set(kept)


def test_bitmap_grows_with_the_benchmark(spark):
    grams = spark.range(3_000_000).select(F.concat(F.lit("g "), F.col("id").cast("string")).alias("gram"))
    assert decontamination.bitmap_bits(grams.limit(10)) == decontamination.LEAST_BITS
    bits = decontamination.bitmap_bits(grams)
    assert bits & (bits - 1) == 0 and 16 * 2_500_000 <= bits <= decontamination.MOST_BITS


# -- 1 -----------------------------------------------------------------------

def mined(spark, urls, bad, **kw):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, int(b)) for i, b in enumerate(bad)], "doc_id long, bad int")
    rules = url_rules.mine_rules(pages, labels, "url", F.col("bad") == 1, **kw)
    return pages, rules


def test_a_long_url_among_few_labels_ends(spark):
    urls = [f"http://a{i}.net/" for i in range(19)] + ["http://x.net/" + "/".join(f"t{i}" for i in range(60))]
    began = time.time()
    _, rules = mined(spark, urls, [i % 2 for i in range(20)])
    assert rules.count() < 10 and time.time() - began < 60


@pytest.mark.parametrize("shape", ["equal", "nested"])
def test_long_urls_that_many_share_end(spark, shape, few_rows_broadcast):
    """Forty common tokens: in all the same urls, or each in fewer than the one before."""
    deep = [f"t{i:02d}" for i in range(40)]
    urls, bad = [], []
    for i in range(120):
        spam = i % 2 == 0
        n = 40 if shape == "equal" else 41 - i % 36
        urls.append("http://spam.net/" + "/".join(deep[:n]) if spam else f"http://good.net/{i % 7}")
        bad.append(spam)
    pages, rules = mined(spark, urls, bad)
    assert 0 < rules.count() < 5000
    found = {r.url: r.verdict for r in url_rules.match_rules(pages, rules).collect()}
    assert all(found[u] == ("block" if b else "allow") for u, b in zip(urls, bad))
    # any of the tokens that stand together stands for the others
    new = spark.createDataFrame([("http://other.com/t00/",)], "url string")
    assert [r.verdict for r in url_rules.match_rules(new, rules).collect()] == ["block"]


def test_rules_of_long_urls_are_those_of_all_combinations(spark):
    """More items in a url than FP-growth is given: nothing is left out."""
    rng = random.Random(5)
    urls, bad = [], []
    for _ in range(60):
        held = [i for i in range(12) if rng.random() < 0.85]
        urls.append("http://h.net/" + "/".join(f"t{i}" for i in held))
        bad.append((10 in held and 11 not in held) or rng.random() < 0.2)
    kw = {"min_support": 0.1, "min_confidence": 0.6}
    pages, grown = mined(spark, urls, bad, **kw)
    tokens = pages.select(F.max(F.size(url_rules.url_tokens(F.col("url"))))).first()[0]
    assert tokens > url_rules.MAX_TOKENS
    _, listed = mined(spark, urls, bad, max_tokens=99, **kw)

    def plain(rules):
        return {(tuple(r.tokens), r.verdict): (round(r.confidence, 9), round(r.support, 9))
                for r in rules.collect()}
    assert len(plain(listed)) > 5 and plain(grown) == plain(listed)


def test_rules_of_short_urls_are_those_of_all_combinations(spark):
    """Where nothing is bounded: every combination, pruned, by brute force."""
    from itertools import combinations
    rng = random.Random(8)
    urls = [f"http://{rng.choice('abc')}.net/{rng.choice('de')}/{rng.choice('fg')}" for _ in range(120)]
    bad = ["a.net/d" in u or ("b.net" in u and "/f" in u) for u in urls]
    pages, rules = mined(spark, urls, bad, min_confidence=0.6)
    tokens = {r.url: frozenset(r.t) for r in pages.select(
        "url", url_rules.url_tokens(F.col("url")).alias("t")).collect()}
    every = {frozenset(c) for t in tokens.values() for n in range(1, len(t) + 1) for c in combinations(t, n)}
    rule = {}
    for c in every:
        held = [b for u, b in zip(urls, bad) if c <= tokens[u]]
        for verdict, right in (("block", sum(held)), ("allow", len(held) - sum(held))):
            if right >= 5 and right / len(held) >= 0.6:
                rule[c, verdict] = right / len(held)
    best = {(c, v) for (c, v), x in rule.items()
            if not any(p < c and w == v and y >= x for (p, w), y in rule.items())}
    assert {(frozenset(r.tokens), r.verdict) for r in rules.collect()} == best


# -- 3 -----------------------------------------------------------------------

def test_preference_sql_states_the_operators_pairing(spark):
    """Openings shared across far ids, blocks with one conversation, an odd rest."""
    import duckdb

    rows = []
    for conv, opening in [(5, "hi"), (1500, "hi"), (70_000, "hi"), (6, "yo"), (2001, "Hello"), (2002, "zz"),
                          (2003, "zz"), (9_999, "alone"), (12, None)]:
        rows += [(conv, 0, "user", opening), (conv, 1, "assistant", f"answer {conv % 7}" * (conv % 3 + 1)),
                 (conv, 2, "user", None)]
    rows += [(None, 0, "user", "hi"), (5, 2, "user", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    turns = preferences.ordered_turns(frame)
    ours = preferences.format_preferences(turns, preferences.neighbour_pairs(turns))
    con = duckdb.connect()
    con.register("conversations", frame.toPandas().astype({"conv_id": "Int64"}))
    theirs = con.execute(oracles.PREFERENCES).fetchall()
    names = [d[0] for d in con.description]
    assert sorted(map(tuple, ours.select(*names).collect()), key=repr) == sorted(theirs, key=repr)


# -- 7 -----------------------------------------------------------------------

def test_a_metric_is_worked_out_once(spark, monkeypatch):
    """Each metric's expression stands once in the filter, however many rules use it."""
    from ledgerline.llm import quality_rules

    made = []
    for name, metric in dict(quality_rules.METRICS).items():
        monkeypatch.setitem(quality_rules.METRICS, name,
                            lambda t, name=name, metric=metric: made.append(name) or metric(t))
    rules = (*quality_rules.BASE_RULES, *quality_rules.RULES)
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    failed = quality_rules.first_failure(rules, F.col("text"), {})
    assert sorted(made) == sorted(set(quality_rules.METRICS))
    assert [r[0] for r in docs.select(failed).collect()] == ["too_few_words"] * 2


def test_rule_costs_are_measured(spark):
    from ledgerline.llm import quality_rules

    text = " ".join(f"word{i % 700}" for i in range(4000))
    docs = spark.range(60).select(F.col("id").alias("doc_id"), F.concat(F.lit(text), "id").alias("text"))
    rules = (*quality_rules.BASE_RULES, *quality_rules.RULES)
    found = quality_rules.estimate_rules(docs, rules)
    assert found["repeated_windows"][0] > found["exclamations"][0] > 0
    same_key = docs.withColumn("doc_id", F.lit(1))
    assert set(quality_rules.estimate_rules(same_key, rules, sample_rows=5)) == set(found)


# -- 10 ----------------------------------------------------------------------

def cut(frame):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.removed), bytes(r.kept))
                   for r in frame.collect()), key=repr)


def line_rows():
    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    short, middle, long = prose(10)[:40], prose(30)[:90], prose(60)[:150]
    return [(i, f"{prose(12)} {[short, middle, long][i % 3]} {prose(12)}") for i in range(90)]


@pytest.mark.parametrize("hot_lead", [1, 5, 4096])
def test_lines_that_many_documents_hold(spark, monkeypatch, hot_lead):
    """The same result by buckets and by hashed strings."""
    import hashlib

    from ledgerline.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "HOT_LEAD", hot_lead)
    rows = line_rows()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    found = [(d, n, removed, runs, hashlib.sha256(kept).hexdigest())
             for d, n, removed, runs, kept in cut(suffix_dedup.dedup_documents(frame))]
    assert found == sorted(brute.suffix_dedup(rows), key=repr)
    assert any(x[2] for x in found)


@pytest.mark.parametrize("hot_lead", [1, 4096])
def test_suffixes_of_null_and_repeated_ids(spark, monkeypatch, hot_lead):
    """Rows of one id with different texts in the order of their hashes, rows
    without id last; equal rows are one document."""
    import hashlib

    from ledgerline.llm import suffix_dedup

    monkeypatch.setattr(suffix_dedup, "HOT_LEAD", hot_lead)
    rng = random.Random(5)
    letters = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    line = letters(160)
    rows = [(4, line + letters(300)), (4, letters(150)), (4, letters(50) + line), (2, letters(40) + line),
            (None, line + letters(20)), (None, letters(120) + line), (9, "short"), (9, None)]
    rows += [rows[1]] * 2
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    tie = {r.text: r.h for r in frame.select("text", F.xxhash64("text").alias("h")).collect()}
    ordered = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, tie[r[1]]))
    expected = {ordered[i]: x for i, *x in brute.suffix_dedup(list(enumerate(t for _, t in ordered)))}
    found = sorted(((d, n, removed, runs, hashlib.sha256(kept).hexdigest())
                    for d, n, removed, runs, kept in cut(suffix_dedup.dedup_documents(frame))), key=repr)
    assert found == sorted(((r[0], *expected[r]) for r in rows), key=repr)
    assert sum(x[2] > 0 for x in found) >= 3
