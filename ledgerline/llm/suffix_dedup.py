"""Suffix-array removal of byte strings that occurred before.

A byte is removed when a string of ``SPAN`` bytes that covers it also starts
earlier (in a smaller doc_id, or earlier in the same document).

A suffix at every byte would be a hundred times the input, so the array is
sparse: suffixes start at minimizers. Of the ``GRAM``-byte grams inside any
``SPAN``-byte string the one with the smallest hash is chosen (the first if
several), which depends on the string alone; equal strings choose the same
gram at the same place, so every repeated string is seen from a suffix that
starts inside it at a gram that is repeated too.

1. Minimizers of all documents are shuffled by gram hash; grams that occur
   once are dropped. What a task sees repeated in its own texts it knows to be
   repeated, and sends only one row of it to the others.
2. Each repeated one is given its context: the bytes from which any string
   around the gram can be read (``SPAN - GRAM`` before it, ``SPAN`` from it).
   Tasks combine before they ship: of equal contexts in one task only the
   earliest goes on, the others are repeats already.
3. Sampled splitters (Spark's range partitioning) deal the suffixes by their
   leading words of 8 bytes, so suffixes that share a gram meet in one bucket.
   A bucket is sorted by multikey quicksort - word by word, each time only
   inside the runs that are still equal - and neighbours' common prefixes are
   read off. For each distance of a string's start before the gram, runs of
   suffixes that agree to the string's end are split by the bytes before the
   gram; in every run all but the earliest are repeats. Splitters never part
   suffixes of equal leading words, so no run crosses a bucket's boundary, and
   buckets hold about ``BUCKET_SUFFIXES`` however large the table is.
4. Leading words that more than ``HOT_LEAD`` suffixes share (a line that very
   many documents hold, with different text around it) would make one bucket of
   any size. Their strings are compared across buckets instead: every string
   around such a gram is hashed (128 bits), tasks and then Spark keep the earliest
   place of each hash, and all places but those are repeats. The earliest places
   are taken out by a join on hash and place, so a string that a third of all
   documents hold is no hot key.
5. Spans are united per document and cut out of its bytes.

Exact copies of one text beyond a thousandth of all documents would repeat
everything in each step; they are recognised by their text hash beforehand
(at most a thousand such texts), and all but the smallest id are repeats.

A document is known by its doc_id and a hash of its text.

Defined cases: null and empty texts have no bytes and no removed span; texts
shorter than ``SPAN`` are never touched; long texts are read whole; rows that
share a doc_id and a text count as one document and get one result; rows of one
doc_id with different texts are documents of their own, in the order of their
texts' hashes; rows without doc_id come after all others, in that order too; an
empty table gives an empty result; only the named columns are read, so other
columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import join_small, stored
from .textbytes import mix, prefix_hash, span_hash, text_chunks

SPAN = 100
GRAM = 32
HOT_SHARE = 1000        # a text is hot beyond one in so many documents
COMBINE_BYTES = 1 << 25
WORD = 8                # bytes compared at once
HOT_LEAD = 100_000      # suffixes of one lead that one bucket takes
BUCKET_SUFFIXES = 100_000
LAST = (1 << 63) - 1    # place of rows without doc_id

# A number for each byte, for the second half of a string's hash.
_SECOND = mix(np.arange(1, 257, dtype=np.uint64))


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    out, done = values, 1
    while 2 * done <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def minimizers(data: np.ndarray, offsets: np.ndarray, span: int = SPAN, gram: int = GRAM
               ) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes): the first smallest gram of every ``span``-byte
    string that lies inside one text."""
    n = len(data) - gram + 1
    if len(data) < span:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(n)
    hashes = span_hash(prefix_hash(data), at, at + gram)
    # upper half of the hash, then the place: the minimum is the first smallest
    low = np.uint64(0xFFFFFFFF)
    least = window_minima((hashes & ~low) | at.astype(np.uint64), span - gram + 1)
    inside = np.zeros(len(least) + 1, np.int64)       # strings within one text
    long = np.flatnonzero(np.diff(offsets) >= span)
    np.add.at(inside, offsets[long], 1)
    np.add.at(inside, offsets[long + 1] - (span - 1), -1)
    chosen = (least[np.cumsum(inside[:-1]) > 0] & low).astype(np.int64)
    chosen = chosen[np.r_[True, chosen[1:] != chosen[:-1]]] if len(chosen) else chosen
    return chosen, hashes[chosen]


def _gram_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow task: doc, tie, text -> (route, doc, tie, place) of minimizers.

    A gram that occurs once among the texts at hand is routed by its hash. One
    that occurs more often is known to be repeated: its places need no meeting
    and are routed anywhere (``known``), and one row without a place goes where
    its hash leads, so a very common gram sends one row per run of texts."""
    for batch in batches:
        ids, ties = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for row, _, data, offsets in text_chunks(batch.column(2)):
            at, hashes = minimizers(data, offsets)
            doc = np.searchsorted(offsets, at, "right") - 1
            grams, which, counts = np.unique(hashes, return_inverse=True, return_counts=True)
            known = counts[which] > 1
            route = np.where(known, mix(hashes ^ (at + 1).astype(np.uint64)), hashes)
            marks = grams[counts > 1]
            n = len(marks)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([route, marks]).view(np.int64)),
                 pa.array(np.concatenate([ids[row + doc], np.zeros(n, np.int64)])),
                 pa.array(np.concatenate([ties[row + doc], np.zeros(n, np.int64)])),
                 pa.array(np.concatenate([(at - offsets[doc]), np.full(n, -1)]).astype(np.int32)),
                 pa.array(np.concatenate([known, np.zeros(n, bool)]))],
                names=["route", "doc", "tie", "place", "known"])


def repeated_grams(texts: DataFrame) -> DataFrame:
    """(doc, tie, places) of minimizers whose gram occurs more than once."""
    rows = texts.mapInArrow(_gram_task, "route long, doc long, tie long, place int, known boolean")
    counted = rows.select("*", F.count(F.lit(1)).over(Window.partitionBy("route")).alias("n"))
    return stored(counted.where((F.col("known") | (F.col("n") > 1)) & (F.col("place") >= 0))
                  .groupBy("doc", "tie").agg(F.collect_set("place").alias("places")), "suffix-grams")


def _context_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow task: doc, tie, text, places -> contexts. Of equal contexts among
    ``COMBINE_BYTES`` only the earliest keeps its bytes; the others are
    repeats, known by their span alone."""
    best: dict[tuple[int, bytes], tuple[int, int, int]] = {}
    repeats: list[tuple[int, int, int, int, int]] = []
    held = 0

    def combined() -> pa.RecordBatch:
        rows = [(*here, before, len(context), context)
                for (before, context), here in best.items()]
        rows += [(*r, None) for r in repeats]
        doc, tie, at, before, size, context = zip(*rows)
        lead = [None if c is None else c[b:b + GRAM] for b, c in zip(before, context)]
        return pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(tie, pa.int64()), pa.array(at, pa.int32()),
             pa.array(before, pa.int32()), pa.array(size, pa.int32()), pa.array(lead, pa.binary()),
             pa.array(context, pa.binary())],
            names=["doc", "tie", "place", "before", "size", "lead", "context"])

    for batch in batches:
        for doc, tie, text, places in zip(*(batch.column(i).to_pylist() for i in range(4))):
            data = text.encode("utf-8")
            for at in sorted(places):
                first = max(0, at - (SPAN - GRAM))
                context = data[first:at + SPAN]
                key, here = (at - first, context), (doc, tie, at)
                there = best.get(key)
                if there is None:
                    best[key] = here
                    held += len(context)
                elif here != there:
                    best[key] = min(here, there)
                    repeats.append((*max(here, there), at - first, len(context)))
            if held > COMBINE_BYTES or len(repeats) > COMBINE_BYTES // SPAN:
                yield combined()
                best, repeats, held = {}, [], 0
    if best:
        yield combined()


def multikey_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, first different word of each neighbour pair) of rows of words:
    sorted by one word after the other inside the runs that are still equal."""
    n, depth = words.shape
    order = np.argsort(words[:, 0], kind="stable")
    differs = np.full(max(n - 1, 0), depth, np.int64)
    column = words[order, 0]
    differs[column[1:] != column[:-1]] = 0
    for j in range(1, depth):
        equal = differs == depth
        active = np.flatnonzero(np.r_[equal, False] | np.r_[False, equal])
        if not len(active):
            break
        run = np.cumsum(np.r_[True, ~equal])[active]
        rows = order[active]
        order[active] = rows[np.lexsort((words[rows, j], run))]
        column = words[order, j]
        differs[equal & (column[1:] != column[:-1])] = j
    return order, differs


def common_prefixes(words: np.ndarray, order: np.ndarray, differs: np.ndarray) -> np.ndarray:
    """Equal leading bytes of neighbours in the order."""
    depth = words.shape[1]
    at = np.minimum(differs, depth - 1)
    other = words[order[:-1], at] ^ words[order[1:], at]
    equal_bytes = np.zeros(len(at), np.int64)
    for b in range(1, WORD):
        equal_bytes += (other >> np.uint64(8 * (WORD - b))) == 0
    return np.where(differs == depth, WORD * depth, WORD * differs + equal_bytes)


def repeats_in_bucket(doc: np.ndarray, place: np.ndarray, before: np.ndarray,
                      contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end): for each suffix of the bucket the span of its strings
    that start earlier elsewhere, relative to the document."""
    n = len(contexts)
    depth = -(-SPAN // WORD)
    width = SPAN - GRAM
    size = np.array([len(c) for c in contexts], np.int64)
    right = np.frombuffer(b"".join(c[b:].ljust(depth * WORD, b"\0") for b, c in
                                   zip(before.tolist(), contexts)), np.uint8)
    words = right.reshape(n, depth * WORD).view(">u8").astype(np.uint64)
    left = np.frombuffer(b"".join(c[:b].rjust(width, b"\0") for b, c in
                                  zip(before.tolist(), contexts)), np.uint8).reshape(n, width)
    order, differs = multikey_order(words)
    prefix = common_prefixes(words, order, differs)
    after = (size - before)[order]
    before_o, left = before[order], left[order]
    by_start = np.lexsort((place, doc))
    step = (np.diff(doc[by_start]) != 0) | (np.diff(place[by_start]) != 0)
    rank = np.empty(n, np.int64)
    rank[by_start] = np.cumsum(np.r_[0, step])
    rank = rank[order]

    least = np.full(n, SPAN, np.int64)      # smallest and largest distance that repeats
    most = np.full(n, -1, np.int64)
    hashed = np.zeros(n, np.uint64)
    for distance in range(width + 1):
        if distance:
            hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + left[:, width - distance] + np.uint64(1)
        need = SPAN - distance
        run = np.cumsum(np.r_[True, prefix < need]) if n else np.zeros(0, np.int64)
        able = np.flatnonzero((after >= need) & (before_o >= distance))
        able = able[np.bincount(run[able], minlength=n + 2)[run[able]] > 1] if len(able) else able
        if not len(able):
            continue
        key = mix(hashed[able] ^ mix(run[able].astype(np.uint64)))
        sort = np.lexsort((rank[able], key))
        key, rows = key[sort], able[sort]
        heads = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        earliest = np.repeat(rank[rows[heads]], np.diff(np.r_[heads, len(rows)]))
        again = rows[rank[rows] > earliest]
        least[again] = np.minimum(least[again], distance)
        most[again] = distance
    hit = np.flatnonzero(most >= 0)
    row = order[hit]
    return row, place[row] - most[hit], place[row] + (SPAN - least[hit])


def _ranked(doc: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Place of each document among those at hand."""
    order = np.lexsort((tie, doc))
    new = np.r_[False, (np.diff(doc[order]) != 0) | (np.diff(tie[order]) != 0)]
    rank = np.empty(len(doc), np.int64)
    rank[order] = np.cumsum(new)
    return rank


def _bucket_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow task over one bucket of suffixes -> (doc, tie, start, end)."""
    parts = [b for b in batches if b.num_rows]
    if not parts:
        return
    t = pa.Table.from_batches(parts)
    doc, tie, place = t["doc"].to_numpy(), t["tie"].to_numpy(), t["place"].to_numpy().astype(np.int64)
    row, start, end = repeats_in_bucket(_ranked(doc, tie), place,
                                        t["before"].to_numpy().astype(np.int64), t["context"].to_pylist())
    yield pa.RecordBatch.from_arrays([pa.array(doc[row]), pa.array(tie[row]), pa.array(start), pa.array(end)],
                                     names=["doc", "tie", "start", "end"])


def second_hash(data: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Another hash of data[start:start + size]: bytes as other numbers."""
    step = np.uint64(0xC2B2AE3D27D4EB4F)
    with np.errstate(over="ignore"):
        out = np.zeros(len(starts), np.uint64)
        for i in range(size):
            out = out * step + _SECOND[data[starts + i]]
    return mix(out)


def _string_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow task: suffixes -> hashes and starts of all ``SPAN``-byte strings
    around their grams."""
    for batch in batches:
        if not batch.num_rows:
            continue
        doc, tie, place, before, size = (batch.column(i).to_numpy().astype(np.int64) for i in range(5))
        data = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint8)
        begin = np.r_[0, np.cumsum(size)]
        # a string starts at 0 to ``before`` of its context and ends inside it
        n = np.minimum(before, size - SPAN) + 1
        n = np.maximum(n, 0)
        which = np.repeat(np.arange(len(n)), n)
        off = np.arange(len(which)) - np.repeat(np.r_[0, np.cumsum(n)[:-1]], n)
        at = begin[which] + off
        first = span_hash(prefix_hash(data), at, at + SPAN) if len(at) else np.zeros(0, np.uint64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(first.view(np.int64)), pa.array(second_hash(data, at, SPAN).view(np.int64)),
             pa.array(doc[which]), pa.array(tie[which]), pa.array(place[which] - before[which] + off)],
            names=["h1", "h2", "doc", "tie", "start"])


def repeated_strings(suffixes: DataFrame) -> DataFrame:
    """(doc, tie, start, end) of all strings around the grams of ``suffixes``
    that start earlier elsewhere, by their hashes."""
    strings = stored(suffixes.select("doc", "tie", "place", "before", "size", "context").mapInArrow(
        _string_task, "h1 long, h2 long, doc long, tie long, start long"), "suffix-strings")
    earliest = strings.groupBy("h1", "h2").agg(F.min(F.struct("doc", "tie", "start")).alias("x")).select(
        "h1", "h2", "x.*")
    again = strings.join(earliest, ["h1", "h2", "doc", "tie", "start"], "left_anti")
    return again.select("doc", "tie", "start", (F.col("start") + SPAN).alias("end"))


def repeated_spans(texts: DataFrame, hot_lead: int | None = None) -> DataFrame:
    """(doc, tie, spans) of the bytes to remove, from (doc, tie, text)."""
    hot_lead = HOT_LEAD if hot_lead is None else hot_lead
    grams = repeated_grams(texts)
    contexts = stored(texts.join(grams, ["doc", "tie"]).select("doc", "tie", "text", "places").mapInArrow(
        _context_task, "doc long, tie long, place int, before int, size int, lead binary, context binary"),
        "suffix-contexts")
    start = (F.col("place") - F.col("before")).cast("long")
    known = contexts.where(F.col("context").isNull()).select(
        "doc", "tie", start.alias("start"), (start + F.col("size")).alias("end"))
    suffixes = contexts.where(F.col("context").isNotNull())
    leads = stored(suffixes.groupBy("lead").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_lead),
                   "suffix-leads")
    n_leads, n_hot = leads.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    calm = suffixes
    if n_leads:
        hot = leads.select("lead")
        calm = join_small(suffixes, hot, ["lead"], "place", "left_anti", n_leads)
        found = repeated_strings(join_small(suffixes, hot, ["lead"], "place", "left_semi", n_leads))
        known = known.unionByName(found)
    buckets = -(-(suffixes.count() - n_hot) // BUCKET_SUFFIXES)
    found = (calm.select("doc", "tie", "place", "before", "lead", "context")
             .repartitionByRange(max(buckets, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))),
                                 "lead")
             .select("doc", "tie", "place", "before", "context")
             .mapInArrow(_bucket_task, "doc long, tie long, start long, end long"))
    return stored(known.unionByName(found).groupBy("doc", "tie").agg(
        F.collect_set(F.struct("start", "end")).alias("spans")), "suffix-spans")


def _cut_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow task: doc_id, text, spans -> kept bytes and united spans."""
    for batch in batches:
        kept, removed, runs = [], [], []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            data = (text or "").encode("utf-8")
            united: list[list[int]] = []
            for start, end in sorted((x["start"], min(x["end"], len(data))) for x in spans or ()):
                if united and start <= united[-1][1]:
                    united[-1][1] = max(united[-1][1], end)
                else:
                    united.append([start, end])
            at, out = 0, []
            for start, end in united:
                out.append(data[at:start])
                at = end
            kept.append(b"".join([*out, data[at:]]))
            removed.append(len(data) - len(kept[-1]))
            runs.append([{"start": a, "end": b} for a, b in united])
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([k + r for k, r in zip(map(len, kept), removed)], pa.int64()),
             pa.array(removed, pa.int64()), pa.array(runs, pa.list_(span)),
             pa.array(kept, pa.binary())],
            names=["doc_id", "n_bytes", "n_removed", "removed", "kept"])


def hot_copies(texts: DataFrame) -> DataFrame:
    """(hash, first_id) of texts that more than one in ``HOT_SHARE`` documents
    hold: at most ``HOT_SHARE`` rows."""
    hashes = stored(texts.where(F.octet_length("text") >= SPAN).select(
        "doc", F.sha2("text", 256).alias("hash")), "suffix-hashes")
    total = hashes.agg(F.count(F.lit(1)).alias("n")).scalar()
    return stored(hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("n"),
                                             F.min("doc").alias("first_id"))
                  .where((F.col("n") > 1) & (F.col("n") * HOT_SHARE > total))
                  .select("hash", "first_id"), "suffix-hot")


def dedup_documents(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, removed, kept) of every document."""
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("tie"))
    hot = F.broadcast(hot_copies(rows))
    is_copy = F.coalesce(F.col("first_id") < F.col("doc"), F.lit(False))

    def marked(frame: DataFrame) -> DataFrame:
        return frame.withColumn("hash", F.sha2("text", 256)).join(hot, "hash", "left").withColumn(
            "copy", is_copy)

    texts = marked(rows.where(F.octet_length("text") >= SPAN)).where(~F.col("copy")).select(
        "doc", "tie", "text")
    spans = repeated_spans(texts)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"),
                             F.octet_length("text").cast("long").alias("end")))
    return marked(rows).join(spans, ["doc", "tie"], "left").select(
        "doc_id", "text", F.when(F.col("copy"), whole).otherwise(F.col("spans")).alias("spans")
    ).mapInArrow(_cut_task, "doc_id long, n_bytes long, n_removed long, "
                            "removed array<struct<start:long,end:long>>, kept binary")
