"""SimHash groups, source audit and filter audit against plain Python."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from conftest import SF_SMALL
from pyspark.sql import functions as F

from ledgerline.llm import filter_audit, queries, simhash_join, source_audit

SCHEMA = "doc_id long, text string, lang string, source string"


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def same(frame, expected):
    assert rows_of(frame) == sorted(expected, key=repr)


def awkward():
    """Rows with nulls in every column, empty and long texts, ties, copies,
    repeated rows and ids."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 20))) for _ in range(60)]
    words += ["Ähnlichkeit", "x" * 300, "日本語", "abcdefgh", "abcdefghi", "a" * 16, "a" * 17]

    def prose(n):
        return " ".join(rng.choice(words) for _ in range(n))

    long = prose(6000)
    texts = [None, "", " \t\n", "one", "One two", "one  TWO", "a b c", "A\tb\nc d", "#$%", "SHOUT LOUD",
             long, long + " end", long.replace(" ", "\n", 3), "\x00\x01 nul \x00", "x" * 20000]
    texts += [prose(rng.randint(1, 260)) for _ in range(120)]
    base = prose(230)
    texts += [base] * 8 + [base + " tail"] * 2 + [base + f" {i}" for i in range(12)]
    rows = [(i, t, ["en", "de", None, ""][i % 4 if i % 3 else 0], [f"s{i % 5}", None][i % 11 == 0])
            for i, t in enumerate(texts, 1)]
    rows += [rows[20], rows[20], (None, base, "en", "s1"), (None, "only here", None, None),
             (40, "another text of id forty", "fr", "lone")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return awkward()


@pytest.fixture(scope="module")
def documents(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("code", "fingerprint", "label", "n", "term", "p", "place", "part", "mask", "id", "docs"):
        frame = frame.withColumn(name, F.lit("clash"))
    return frame.repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# -- 11 ----------------------------------------------------------------------

def hexed(frame):
    return frame.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("f"),
                        "component_id")


def test_xxh64_of_spans():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 4000, dtype=np.uint8)
    starts, sizes = rng.integers(0, 3000, 2000), rng.integers(0, 300, 2000)
    found = simhash_join.span_xxh64(data, starts, sizes)
    assert [int(x) for x in found] == [
        xxhash.xxh64_intdigest(data[s:s + n].tobytes(), 42) for s, n in zip(starts, sizes)]


def test_fingerprints(rows):
    texts = [r[1] for r in rows]
    found = np.concatenate(list(simhash_join.fingerprints(pa.array(texts))))
    assert [int(x) for x in found] == [brute.simhash(t) for t in texts]


@pytest.mark.parametrize("queries_at_once", [7, 1 << 14])
def test_gray_index_finds_every_pair(queries_at_once):
    rng = np.random.default_rng(1)
    one = np.uint64(1)
    for _ in range(10):
        base = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
        codes = np.unique(np.concatenate([base, *(
            b ^ (one << rng.integers(0, 64, 50).astype(np.uint64))
            ^ (one << rng.integers(0, 64, 50).astype(np.uint64)) for b in base)]))
        codes = codes[np.argsort(simhash_join.gray_rank(codes))]
        cell = np.sort(rng.integers(0, 3, len(codes)))
        found = [x for a, b in simhash_join.GrayIndex(codes, cell).pairs(queries=queries_at_once)
                 for x in zip(a.tolist(), b.tolist())]
        assert len(found) == len(set(found))
        assert set(found) == {(i, j) for i in range(len(codes)) for j in range(i + 1, len(codes))
                              if cell[i] == cell[j] and int(codes[i] ^ codes[j]).bit_count() <= 2}


def test_gray_index_leaves_whole_groups():
    """Two far clusters of a cell: their pairs are never compared one by one."""
    low = np.arange(64, dtype=np.uint64)
    codes = np.concatenate([low, low | np.uint64(0xFF << 40)])
    codes = codes[np.argsort(simhash_join.gray_rank(codes))]
    index = simhash_join.GrayIndex(codes, np.zeros(len(codes), np.int64))
    assert (index.levels[-1]["mask"] == ~np.uint64(0xFF0000000000 | 63)).all()
    assert all(abs(int(codes[i]) - int(codes[j])) < 64
               for a, b in index.pairs() for i, j in zip(a, b))


@pytest.mark.parametrize("crowded", [3, 2048])
def test_simhash_links_of_dense_codes(spark, crowded):
    """Codes within few bits of each other, in crowded and in calm cells."""
    rng = random.Random(9)
    codes = {0, (1 << 64) - 1}
    for _ in range(4):
        base = rng.getrandbits(64)
        codes |= {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64))
                  for _ in range(40)}
    codes = sorted(codes)
    frame = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "code long")
    parent = {c: c for c in codes}

    def root(c):
        while parent[c] != c:
            c = parent[c]
        return c

    for r in simhash_join.fingerprint_links(frame, crowded).collect():
        a, b = (x % (1 << 64) for x in r)
        parent[root(b)] = root(a)
    groups = {}
    for c in codes:
        groups.setdefault(root(c), set()).add(c)
    for i, a in enumerate(codes):
        for b in codes[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                assert root(a) == root(b)
    for members in groups.values():     # and nothing else is joined
        seen, todo = set(), [min(members)]
        while todo:
            c = todo.pop()
            if c not in seen:
                seen.add(c)
                todo += [d for d in members if (c ^ d).bit_count() <= 2]
        assert seen == members


def test_simhash_on_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    same(queries.op11_simhash_dedup(spark, SF_SMALL), brute.simhash_groups([tuple(r) for r in docs]))


@pytest.mark.parametrize("crowded", [2, 2048])
def test_simhash_on_fixture(documents, rows, nothing, crowded):
    known = [(d, t) for d, t, _, _ in rows if d is not None]
    expected = brute.simhash_groups(known)
    low = {f: c for _, f, c in expected}
    expected += [(None, f"{brute.simhash(t):016x}", low.get(f"{brute.simhash(t):016x}"))
                 for d, t, _, _ in rows if d is None]
    same(hexed(simhash_join.near_duplicates(documents, crowded=crowded)), expected)
    assert simhash_join.near_duplicates(nothing).count() == 0


# -- 12 ----------------------------------------------------------------------

def test_radix_order_is_a_stable_sort():
    rng = np.random.default_rng(2)
    high = rng.integers(0, 4, 3000).astype(np.uint64) << np.uint64(40)
    low = rng.integers(0, 1 << 20, 3000).astype(np.uint64)
    assert (source_audit.radix_order([high, low]) == np.lexsort((low, high))).all()
    assert (source_audit.radix_order([high]) == np.argsort(high, kind="stable")).all()


def test_packed_terms_come_back():
    terms = ["a", "ab", "abcdefgh", "é", "日本"]
    for terms in (terms, [*terms, "abcdefghi", "a" * 16]):
        data = "".join(terms).encode()
        sizes = np.array([len(t.encode()) for t in terms])
        words = source_audit.packed_words(np.frombuffer(data, np.uint8),
                                          np.cumsum(np.r_[0, sizes[:-1]]), sizes)
        assert source_audit.unpacked(words).to_pylist() == terms
        assert np.lexsort(words[::-1]).tolist() == sorted(
            range(len(terms)), key=lambda i: terms[i].encode())


def test_source_audit_on_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text", "lang", "source")
    same(queries.op12_source_audit(spark, SF_SMALL),
         brute.source_audit([tuple(r) for r in docs.collect()]))


@pytest.mark.parametrize("tile,block_rows,held", [(128, 1 << 14, 1 << 19), (2, 10, 8), (1, 3, 1 << 19)])
def test_source_audit_on_fixture(documents, rows, monkeypatch, tile, block_rows, held):
    monkeypatch.setattr(source_audit, "HELD", held)
    monkeypatch.setattr(source_audit, "STRIP", 4 * tile)
    for least in (3, 30):
        same(source_audit.audit_sources(documents, min_documents=least, tile=tile,
                                        block_rows=block_rows),
             brute.source_audit([(t, lang, s) for _, t, lang, s in rows], least))


def test_source_audit_of_large_counts(spark):
    """Shares are exact beyond 64 bits."""
    frame = spark.createDataFrame([(9_000_000_000_001, 70_000_000_000_003, 12_345)],
                                  "n long, total long, kept long")
    found = frame.select(source_audit.share(F.col("n"), F.col("total"), F.col("kept"))).scalar()
    p = frame.select(found.alias("p")).first()["p"]
    assert p == 1 + 10**9 * (9_000_000_000_001 + 5) // (70_000_000_000_003 + 5 * 12_345)


def test_source_audit_without_rows_or_terms(spark, nothing):
    assert source_audit.audit_sources(nothing).count() == 0
    bare = spark.createDataFrame([(1, "12 34", "en", "a"), (2, None, "en", "b"), (3, "", None, None)],
                                 SCHEMA)
    same(source_audit.audit_sources(bare), [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)])


# -- 13 ----------------------------------------------------------------------

AUDIT = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
         "toxic_lost", "shapley")


def test_filter_audit_on_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").select("doc_id", "quality", "toxic")
    same(queries.op13_filter_audit(spark, SF_SMALL).select(*AUDIT), brute.filter_audit(
        [tuple(r) for r in docs.collect()], [tuple(r) for r in labels.collect()]))


def test_filter_audit_on_fixture(spark, documents, rows, nothing):
    marks = [(d, [0, 1, None][d % 3], [None, 0, 1][d % 5 % 3]) for d, _, _, _ in rows if d]
    marks += [(None, 1, 1), (3, 1, 0), (3, 1, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int").withColumn(
        "good", F.lit("clash"))
    same(filter_audit.audit_documents(documents, labels).select(*AUDIT),
         brute.filter_audit([r[:3] for r in rows], marks))
    assert filter_audit.audit_documents(nothing, labels).count() == 0
    empty = labels.limit(0)
    assert filter_audit.audit_documents(documents, empty).agg(
        F.sum("good_lost"), F.sum("toxic_lost")).first() == (0, 0)


def test_filter_audit_of_other_filters(spark, documents):
    """Any number of filters; the first step of an order removes what fails."""
    short = {"S": lambda text, words, distinct: words < 3,
             "H": lambda text, words, distinct: text.contains("#")}
    cells = filter_audit.mask_cells(documents, spark.createDataFrame(
        [], "doc_id long, quality int, toxic int"), filters=short)
    found = filter_audit.audit_orders(cells, "SHE")
    assert found.count() == 6 * 3 * cells.select("part").distinct().count()
    n = documents.where(F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"),
                                        lambda x: x != "")) < 3).count()
    assert found.where("filter_order = 'SHE' AND step = 1").agg(F.sum("removed")).first()[0] == n


def test_filter_audit_of_many_parts(spark):
    """More prefixes than the session lets a recursion have rows."""
    before = spark.conf.get(filter_audit.ROW_LIMIT, None)
    spark.conf.set(filter_audit.ROW_LIMIT, "1000")
    try:
        docs = spark.createDataFrame([(i, "few words", f"l{i}", "s") for i in range(30)], SCHEMA)
        labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
        assert filter_audit.audit_documents(docs, labels).count() == 30 * 600
    finally:
        spark.conf.unset(filter_audit.ROW_LIMIT) if before is None else spark.conf.set(
            filter_audit.ROW_LIMIT, before)
