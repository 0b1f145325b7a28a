"""Benchmark decontamination by a prefix-filtered join.

A benchmark item is its windows of ``WINDOW`` words (a shorter item is one
window). A window is the set of its ``GRAM``-word shingles at their places;
it occurs in a document only if all of them do, so one necessary prefix token
is enough to find it: shingles are ordered by rarity (their count over all
documents) and each window is filed under its rarest. Document shingles that
equal it propose a start; length and position bounds drop what would not fit
into the document, and the window's words are then compared one by one.

Documents are scanned once, in Arrow tasks, where a bitmap of the benchmark's
shingle hashes (a fixed number of bits) lets through the few shingles worth a
row; everything after that is joins and windows over those rows.

Defined cases: null and empty texts have no words and are clean; items
without words have no windows; repeated items and windows count once per
item; repeated document rows are judged one by one; empty tables give an
empty result, or clean documents; only the named columns are read, so other
columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import plain_words
from .tables import join_small, stored
from .textbytes import (LOWERED, PLAIN_WORD, prefix_hash, shingle_hash, span_hash, summed_blocks,
                        text_chunks, words_of)

WINDOW = 13
GRAM = 5
#: Slots per distinct benchmark shingle, and bounds of the bitmap's size.
SLOTS_PER_GRAM, LEAST_BITS, MOST_BITS = 16, 1 << 23, 1 << 28


def item_windows(benchmark: DataFrame, key: str = "item_id", text: str = "text",
                 window: int = WINDOW) -> DataFrame:
    """Distinct (item_id, window): windows as word arrays."""
    words = benchmark.select(F.col(key).cast("string").alias("item_id"),
                             plain_words(F.col(text)).alias("words"))
    last = F.greatest(F.size("words") - (window - 1), F.lit(1))
    return words.where(F.size("words") > 0).select("item_id", F.explode(F.transform(
        F.sequence(F.lit(1), last), lambda i: F.slice("words", i, window))).alias("window")
    ).distinct()


def window_grams(windows: DataFrame, gram: int = GRAM) -> DataFrame:
    """(window, off, gram) of every distinct window; shingles as text."""
    size = F.least(F.size("window"), F.lit(gram))
    return windows.select("window").distinct().select("window", F.posexplode(F.transform(
        F.sequence(F.lit(1), F.size("window") - size + 1),
        lambda i: F.array_join(F.slice("window", i, size), " "))).alias("off", "gram"))


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes & np.uint64(bits - 1)).astype(np.int64)      # bits: a power of two


def bitmap_bits(grams: DataFrame) -> int:
    """Size of the bitmap: a power of two with ``SLOTS_PER_GRAM`` slots for each
    distinct shingle, so that one in sixteen slots is set, up to 32 MB."""
    n = grams.agg(F.approx_count_distinct("gram")).first()[0]
    return min(MOST_BITS, max(LEAST_BITS, 1 << (SLOTS_PER_GRAM * n).bit_length()))


def gram_bitmap(grams: DataFrame, bits: int = LEAST_BITS) -> tuple[np.ndarray, list[int]]:
    """One flag per hash slot of a benchmark shingle, and the lengths (in
    words) that shingles have. The flags are ``bits`` in number."""
    def flags(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros(bits, np.uint8)
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch.column(0)):
                starts, ends, first = words_of(data, offsets, PLAIN_WORD)
                hashes = span_hash(prefix_hash(data), starts, ends)
                for a, b in zip(first[:-1], first[1:]):
                    out[_slots(shingle_hash(hashes[a:b], b - a), bits)] = 1
        return out

    lengths = [r[0] for r in grams.select(F.size(F.split("gram", " "))).distinct().collect()]
    return summed_blocks(grams.select("gram"), flags, bits, "uint8") > 0, sorted(lengths)


def _scanner(bitmap, lengths: list[int], window: int):
    """Arrow task: doc_id, text -> doc_id, n_words and the shingles (place,
    words, words around) whose hash slot the bitmap holds."""
    hit = pa.struct([("p", pa.int64()), ("gram", pa.string()), ("from", pa.int64()),
                     ("around", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.unpackbits(bitmap.value)
        for batch in batches:
            for row, end, raw, offsets in text_chunks(batch.column(1)):
                data = LOWERED[raw]
                starts, ends, first = words_of(data, offsets, PLAIN_WORD)
                hashes = span_hash(prefix_hash(data), starts, ends)
                n_words = np.diff(first)
                found: list[list[dict]] = [[] for _ in range(end - row)]
                for k in lengths:
                    grams = shingle_hash(hashes, k)
                    at = np.flatnonzero(flags[_slots(grams, len(flags))])
                    doc = np.searchsorted(first, at, "right") - 1
                    for p, d in zip(at.tolist(), doc.tolist()):
                        lo, hi = first[d], first[d + 1]
                        if p + k > hi:
                            continue

                        def text(a: int, b: int) -> str:
                            return " ".join(data[starts[i]:ends[i]].tobytes().decode("utf-8")
                                            for i in range(a, b))
                        a, b = max(lo, p - window + k), min(hi, p + window)
                        found[d].append({"p": p - lo, "gram": text(p, p + k), "from": a - lo,
                                         "around": text(a, b)})
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(n_words, pa.int64()),
                     pa.array(found, pa.list_(hit))], names=["doc_id", "n_words", "hits"])
    return scan


def scan_documents(documents: DataFrame, grams: DataFrame, key: str = "doc_id",
                   text: str = "text", window: int = WINDOW) -> DataFrame:
    """(row, doc_id, n_words, hits) of every document, stored. Rows are
    numbered before they are stored: a number put on a later read would change
    with the splits of that read."""
    bitmap, lengths = gram_bitmap(grams, bitmap_bits(grams))
    shared = documents.sparkSession.sparkContext.broadcast(np.packbits(bitmap))
    rows = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    schema = (f"doc_id {dict(rows.dtypes)['doc_id']}, n_words long, "
              "hits array<struct<p:long,gram:string,from:long,around:string>>")
    scanned = rows.mapInArrow(_scanner(shared, lengths, window), schema)
    return stored(scanned.select(F.monotonically_increasing_id().alias("row"), "*"), "decon-scan")


def occurrences(scanned: DataFrame, windows: DataFrame, grams: DataFrame) -> DataFrame:
    """Verified (row, start, window) from the scan."""
    hits = stored(scanned.where(F.size("hits") > 0).select("row", "n_words", F.inline("hits"))
                  .select("row", "n_words", "p", "gram", F.col("from").alias("first"), "around"),
                  "decon-hits")
    counts = hits.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarity = grams.join(counts, "gram", "left").select(
        "window", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "off").alias("token"))
    anchors = stored(rarity.groupBy("window").agg(F.min("token").alias("token")).select(
        "window", "token.gram", "token.off"), "decon-anchors")
    start = (F.col("p") - F.col("off"))
    size = F.size("window")
    # length and position bounds, then every word of the window
    candidates = join_small(hits, anchors, ["gram"], "row").select(
        "row", "n_words", "window", "first", "around", start.alias("start")).where(
        (size <= F.col("n_words")) & (F.col("start") >= 0)
        & (F.col("start") + size <= F.col("n_words")))
    words = F.slice(F.split("around", " "), (F.col("start") - F.col("first") + 1).cast("int"), size)
    return candidates.where(words == F.col("window")).select("row", "start", "window")


def _covered(spans: DataFrame) -> DataFrame:
    """(row, n_hit): words under the union of a row's spans."""
    order = Window.partitionBy("row").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(reach, F.lit(0))))
    return spans.select("row", new.alias("new")).groupBy("row").agg(F.sum("new").alias("n_hit"))


def contamination_rule(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def _judged_rows(documents: DataFrame, benchmark: DataFrame, key: str, text: str, item_key: str,
                 item_text: str) -> DataFrame:
    """(row, doc_id, n_words, n_hit, items, contaminated) of every document."""
    windows = stored(item_windows(benchmark, item_key, item_text), "decon-windows")
    grams = stored(window_grams(windows), "decon-grams")
    scanned = scan_documents(documents, grams, key, text)
    found = stored(occurrences(scanned, windows, grams), "decon-found")
    hit = _covered(found.select("row", "start", (F.col("start") + F.size("window")).alias("end"))
                   .distinct())
    items = (join_small(found.select("row", "window").distinct(), windows, ["window"], "row")
             .groupBy("row").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    return (scanned.select("row", "doc_id", "n_words").join(hit.join(items, "row"), "row", "left")
            .select("row", "doc_id", "n_words",
                    F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"))
            .withColumn("contaminated", contamination_rule(F.col("n_hit"), F.col("n_words"))))


def judge_documents(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id",
                    text: str = "text", item_key: str = "item_id", item_text: str = "text"
                    ) -> DataFrame:
    """Words, hit words, items and verdict of every document."""
    return _judged_rows(documents, benchmark, key, text, item_key, item_text).drop("row")


def clean_documents(documents: DataFrame, benchmark: DataFrame, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Documents that are not contaminated, as they came. A verdict follows
    from the text alone, so rows go by their text: a key that is null or
    repeated neither hides nor spreads one."""
    digest = F.sha2(F.col(text), 256)
    marked = documents.select(digest.alias("digest"), F.col(text).alias("text"))
    bad = stored(judge_documents(marked, benchmark, "digest", "text").where("contaminated")
                 .select(F.col("doc_id").alias("__digest")).distinct(), "decon-bad")
    return join_small(documents.withColumn("__digest", digest), bad, ["__digest"], key,
                      "left_anti").select(*documents.columns)
