"""Source divergence audit: how the word use of sources differs.

Terms (runs of letters) are counted per language and source, and each source's
smoothed shares are compared with those of every other source of its language
and with the language itself.

Counting works on packed terms, in Arrow tasks. Terms of up to 8 bytes become
one uint64 word and those of up to 16 bytes two, byte order kept; they are
radix-sorted, 16 bits at a time, and counted as runs. Longer terms go to a
bucket for each length and are sorted there as byte strings. A term holds no
zero byte, so padding tells lengths apart. A task keeps packed counts, merges
them when they are many, and ships what is left; Spark adds them up.

Shares are whole numbers: p = 1 + floor(10^9 (count + 5) / (N + 5 V)), worked
out in decimals of 38 digits, so sums over them are exact. A term that a source
does not hold has the share of count 0.

A pair of sources differs by the sum of |p - q| over all kept terms. Sources of
a language are dealt into tiles of ``TILE`` and terms into blocks: a task holds
the terms of one block for one pair of tiles, a few at a time, and ships one sum
per pair. Terms that neither tile holds add the same amount each, so they are
counted and not visited. A language that holds most rows is spread by its
blocks.

Defined cases: a null text, language or source is an empty one; repeated rows
are documents of their own; a group without kept terms has a row for every
other source all the same (0 if the language keeps no term); ties are ordered
by the item's UTF-8 bytes; long texts and terms are taken whole; an empty table
gives an empty result; only the named columns are read, so other columns cannot
clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored
from .textbytes import LOWERED, text_chunks, words_of

MIN_DOCUMENTS = 30
TOP_TERMS = 50
SCALE, SMOOTHING = 1_000_000_000, 5
TILE = 128              # sources compared by one task
BLOCK_ROWS = 1 << 14    # counted terms of a block of a language, about
HELD = 1 << 19          # packed counts a task holds before it merges them
STRIP = 1 << 18         # numbers of a strip of terms compared at once

#: Letters after lower-casing: a-z and all bytes of characters from 0x80 on.
LETTER = np.zeros(256, bool)
LETTER[0x61:0x7B] = LETTER[0x80:] = True


# ---------------------------------------------------------------------------
# Packed terms
# ---------------------------------------------------------------------------

def radix_order(words: list[np.ndarray], start: np.ndarray | None = None) -> np.ndarray:
    """Stable order of rows of uint64 words (the first is the highest), by one
    pass over each 16-bit digit in which rows differ."""
    order = np.arange(len(words[0])) if start is None else start
    for word in reversed(words):
        for shift in (0, 16, 32, 48):
            digit = ((word >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def packed_words(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Big-endian uint64 words of spans of 16 bytes at most, two for spans of
    which one is longer than 8."""
    width = 16 if len(sizes) and sizes.max() > 8 else 8
    padded = np.r_[data, np.zeros(width, np.uint8)]
    rows = padded[starts[:, None] + np.arange(width)]
    rows[np.arange(width) >= sizes[:, None]] = 0
    words = rows.view(">u8").astype(np.uint64)
    return [words[:, i] for i in range(width // 8)]


def unpacked(words: list[np.ndarray]) -> pa.Array:
    """Terms of packed words."""
    rows = np.stack(words, axis=1).astype(">u8").view(np.uint8)
    there = rows != 0
    offsets = np.r_[0, np.cumsum(there.sum(axis=1))].astype(np.int64)
    return pa.LargeStringArray.from_buffers(
        len(rows), pa.py_buffer(offsets.tobytes()), pa.py_buffer(rows[there].tobytes())
    ).cast(pa.string())


class PackedCounts:
    """Counts of (term, group) of one bucket of packed terms."""

    def __init__(self) -> None:
        self.parts: list[tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, words: list[np.ndarray], group: np.ndarray, doc: np.ndarray) -> None:
        """Occurrences of terms; ``group`` and ``doc`` ascend with their place."""
        order = radix_order(words)
        words = [w[order] for w in words]
        group, doc = group[order], doc[order]
        new_group = self._heads(words, group)
        new_doc = new_group | np.r_[True, doc[1:] != doc[:-1]]
        head = np.flatnonzero(new_group)
        self._hold([w[head] for w in words], group[head], np.diff(np.r_[head, len(group)]),
                   np.add.reduceat(new_doc.astype(np.int64), head))

    @staticmethod
    def _heads(words: list[np.ndarray], group: np.ndarray) -> np.ndarray:
        new = np.r_[True, group[1:] != group[:-1]]
        for w in words:
            new[1:] |= w[1:] != w[:-1]
        return new

    def _hold(self, *part) -> None:
        self.parts.append(part)
        self.rows += len(part[1])

    def merged(self) -> None:
        words = [np.concatenate(w) for w in zip(*(p[0] for p in self.parts))]
        group, occurs, docs = (np.concatenate([p[i] for p in self.parts]) for i in (1, 2, 3))
        order = radix_order(words, radix_order([group.astype(np.uint64)]))
        words = [w[order] for w in words]
        group, occurs, docs = group[order], occurs[order], docs[order]
        head = np.flatnonzero(self._heads(words, group))
        self.parts, self.rows = [], 0
        self._hold([w[head] for w in words], group[head], np.add.reduceat(occurs, head),
                   np.add.reduceat(docs, head))

    def taken(self) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """(terms, group, occurrences, documents) held, which go."""
        self.merged()
        (words, group, occurs, docs), = self.parts
        self.parts, self.rows = [], 0
        return unpacked(words), group, occurs, docs


def counted_long(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, group: np.ndarray,
                 doc: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(terms, group, occurrences, documents) of terms of more than 16 bytes:
    a bucket for each length, sorted as byte strings."""
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        terms = np.ascontiguousarray(data[starts[at][:, None] + np.arange(size)]).view(
            f"S{size}").ravel()
        order = np.argsort(terms, kind="stable")
        terms, at = terms[order], at[order]
        new_group = np.r_[True, (terms[1:] != terms[:-1]) | (group[at[1:]] != group[at[:-1]])]
        new_doc = new_group | np.r_[True, doc[at[1:]] != doc[at[:-1]]]
        head = np.flatnonzero(new_group)
        yield (pa.array(terms[head].tolist(), pa.binary()).cast(pa.string()), group[at[head]],
               np.diff(np.r_[head, len(at)]), np.add.reduceat(new_doc.astype(np.int64), head))


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow task: text, lang, source -> counts per lang, source and term."""
    groups: dict[tuple[str, str], int] = {}
    buckets = {1: PackedCounts(), 2: PackedCounts()}

    def made(terms, group, occurs, docs) -> pa.RecordBatch:
        names = list(groups)
        lang, source = (pa.array([n[i] for n in names]).take(pa.array(group)) for i in (0, 1))
        return pa.RecordBatch.from_arrays(
            [lang, source, terms, pa.array(occurs, pa.int64()), pa.array(docs, pa.int64())],
            names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        number = np.array([groups.setdefault(x, len(groups)) for x in
                           zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())], np.int64)
        for row, end, raw, offsets in text_chunks(batch.column(0)):
            data = LOWERED[raw]
            starts, ends, first = words_of(data, offsets, LETTER)
            doc = np.repeat(np.arange(end - row), np.diff(first))
            # documents of a group stand together, so that runs of a term do
            order = np.argsort(number[row:end][doc], kind="stable")
            starts, sizes, doc = starts[order], (ends - starts)[order], doc[order]
            group = number[row:end][doc]
            for n_words, fits in ((1, sizes <= 8), (2, (sizes > 8) & (sizes <= 16))):
                if fits.any():
                    buckets[n_words].add(packed_words(data, starts[fits], sizes[fits]),
                                         group[fits], doc[fits])
            if (sizes > 16).any():
                long = sizes > 16
                for part in counted_long(data, starts[long], sizes[long], group[long], doc[long]):
                    yield made(*part)
            for bucket in buckets.values():
                if bucket.rows > HELD:
                    bucket.merged()
                    if bucket.rows > HELD // 2:
                        yield made(*bucket.taken())
    for bucket in buckets.values():
        if bucket.rows:
            yield made(*bucket.taken())


# ---------------------------------------------------------------------------
# Counts, shares and groups
# ---------------------------------------------------------------------------

def term_counts(documents: DataFrame, text: str = "text", lang: str = "lang",
                source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs) over all documents, stored."""
    empty = F.lit("")
    rows = documents.select(F.col(text).alias("text"), F.coalesce(F.col(lang), empty).alias("lang"),
                            F.coalesce(F.col(source), empty).alias("source"))
    return stored(rows.mapInArrow(
        _count_task, "lang string, source string, term string, n long, docs long")
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")),
        "audit-counts")


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE (count + 5) / (total + 5 kept)), exact. Where nothing is
    kept it is the same for all, so that differences are 0."""
    above = (count + SMOOTHING).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = F.greatest(total + SMOOTHING * kept, F.lit(1)).cast("decimal(20,0)")
    return F.call_function("div", above.cast("decimal(38,0)"), below.cast("decimal(38,0)")) + 1


def kept_counts(counts: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Counts of the terms that enough documents of their language hold, stored."""
    kept = counts.groupBy("lang", "term").agg(
        F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(
        F.col("docs") >= min_documents).select("lang", "term", "lang_n")
    return stored(counts.drop("docs").join(kept, ["lang", "term"]), "audit-kept")


def source_groups(documents: DataFrame, kept: DataFrame, lang: str = "lang",
                  source: str = "source") -> DataFrame:
    """(lang, source, place, total, base, kept, lang_total): every group that
    occurs, its place in the language and its share of count 0, stored."""
    empty = F.lit("")
    groups = documents.select(F.coalesce(F.col(lang), empty).alias("lang"),
                              F.coalesce(F.col(source), empty).alias("source")).distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = (kept.groupBy("lang", "term").agg(F.max("lang_n").alias("n")).groupBy("lang")
             .agg(F.count(F.lit(1)).alias("kept"), F.sum("n").alias("lang_total")))
    zero = F.lit(0).cast("long")
    rows = (groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
            .select("lang", "source", F.coalesce("total", zero).alias("total"),
                    F.coalesce("kept", zero).alias("kept"),
                    F.coalesce("lang_total", zero).alias("lang_total")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return stored(rows.select("*", place.alias("place"), share(zero, F.col("total"), F.col("kept"))
                              .alias("base")), "audit-groups")


# ---------------------------------------------------------------------------
# Pairs of sources
# ---------------------------------------------------------------------------

TASK_KEY = ("lang", "left", "right", "block")


def _pair_task(width: int):
    """Arrow task over rows sorted by tile pair, block and term, the shares of
    count 0 (``head``) before all terms -> sums of |p - q| over the block's
    terms, and their number, for each pair of sources."""
    def sums(base: np.ndarray, there: np.ndarray, term: np.ndarray, place: np.ndarray,
             p: np.ndarray, same: bool, total: np.ndarray) -> None:
        """Adds |p - q| of whole terms to ``total`` (left place, right place)."""
        grid = np.broadcast_to(base, (int(term[-1]) + 1, len(base))).copy()
        grid[term, place] = p
        left = np.flatnonzero(there[:width])
        right = np.flatnonzero(there) if same else width + np.flatnonzero(there[width:])
        for i in left.tolist():
            total[i, right] += np.abs(grid[:, right] - grid[:, i:i + 1]).sum(axis=0)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = base = there = total = None
        n_terms, held = 0, None

        def flush(rows) -> None:
            nonlocal n_terms
            if rows is not None and len(rows[0]):
                new = np.r_[False, rows[0][1:] != rows[0][:-1]]
                term = np.cumsum(new)
                n_terms += int(term[-1]) + 1
                sums(base, there, term, rows[1], rows[2], key[1] == key[2], total)

        def done() -> pa.RecordBatch:
            flush(held)
            at, other = np.nonzero(there[:width, None] & there[None, :])
            keep = other >= width if key[1] != key[2] else at != other
            at, other = at[keep], other[keep]
            n = len(at)
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]] * n, pa.string()), pa.array(at + key[1] * width, pa.int32()),
                 pa.array(np.where(other >= width, other - width + key[2] * width,
                                   other + key[1] * width), pa.int32()),
                 pa.array(total[at, other], pa.int64()), pa.array(np.full(n, n_terms), pa.int64())],
                names=["lang", "place", "other", "apart", "terms"])

        for batch in batches:
            if not batch.num_rows:
                continue
            t = {c: batch.column(c) for c in batch.schema.names}
            keys = [t[c].to_pylist() for c in TASK_KEY]
            numbers = [t[c].to_numpy() for c in TASK_KEY[1:]]
            lang_code = t["lang"].dictionary_encode().indices.to_numpy()
            edge = np.zeros(batch.num_rows, bool)
            for c in (lang_code, *numbers):
                edge[1:] |= c[1:] != c[:-1]
            bounds = [0, *np.flatnonzero(edge).tolist(), batch.num_rows]
            # a term is known by a number in the batch; its text where it goes on
            terms = t["term"].fill_null("").to_numpy(zero_copy_only=False)
            place, p, head = t["slot"].to_numpy().astype(np.int64), t["p"].to_numpy(), t["head"].to_numpy(
                zero_copy_only=False)
            for s, e in zip(bounds[:-1], bounds[1:]):
                now = tuple(k[s] for k in keys)
                if now != key:
                    if key is not None:
                        yield done()
                    key, n_terms, held = now, 0, None
                    base, there = np.zeros(2 * width, np.int64), np.zeros(2 * width, bool)
                    total = np.zeros((width, 2 * width), np.int64)
                heads = np.flatnonzero(head[s:e]) + s
                base[place[heads]], there[place[heads]] = p[heads], True
                s += len(heads)
                rows = (terms[s:e], place[s:e], p[s:e])
                if held is not None:
                    rows = tuple(np.concatenate(x) for x in zip(held, rows))
                strip = max(1, STRIP // (2 * width))
                while len(rows[0]):
                    new = np.flatnonzero(np.r_[True, rows[0][1:] != rows[0][:-1]])
                    if len(new) <= 1:
                        break
                    cut = int(new[min(strip, len(new) - 1)])
                    flush(tuple(x[:cut] for x in rows))
                    rows = tuple(x[cut:] for x in rows)
                held = rows
        if key is not None:
            yield done()

    return task


def source_pairs(kept: DataFrame, groups: DataFrame, tile: int = TILE,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(lang, source, item, value) for each source and other source of a language."""
    sizes = groups.groupBy("lang").agg((F.floor(F.max("place") / tile) + 1).cast("int").alias("tiles"))
    rows = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    plan = stored(sizes.join(rows, "lang", "left").select("lang", "tiles", F.ceil(
        F.greatest(F.coalesce("rows", F.lit(0)), F.lit(1)) / block_rows).cast("int").alias("blocks")),
        "audit-plan")
    placed = groups.select("lang", "source", "place", "total", "kept", "base").join(plan, "lang")
    mine = F.floor(F.col("place") / tile).cast("int")
    slot = (F.col("place") % tile).cast("int")

    def dealt(frame: DataFrame) -> DataFrame:
        """One row for each tile that a source's tile is compared with."""
        copies = frame.withColumn("mine", mine).withColumn("other", F.explode(
            F.sequence(F.lit(0), F.col("tiles") - 1)))
        right = F.col("mine") > F.col("other")
        return copies.select("lang", F.least("mine", "other").alias("left"),
                             F.greatest("mine", "other").alias("right"), "block", "term",
                             (slot + F.when(right, F.lit(tile)).otherwise(0)).alias("slot"), "p",
                             F.col("term").isNull().alias("head"))

    heads = placed.select("lang", "place", "tiles", F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        F.lit(None).cast("string").alias("term"), F.col("base").alias("p"))
    terms = kept.join(placed.drop("base"), ["lang", "source"]).select(
        "lang", "place", "tiles", F.pmod(F.xxhash64("term"), "blocks").cast("int").alias("block"),
        "term", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"))
    ordered = (dealt(heads.unionByName(terms)).repartition(*TASK_KEY)
               .sortWithinPartitions(*TASK_KEY, F.asc_nulls_first("term")))
    partial = ordered.mapInArrow(
        _pair_task(tile), "lang string, place int, other int, apart long, terms long")
    half = partial.groupBy("lang", "place", "other").agg(
        F.sum("apart").alias("apart"), F.sum("terms").alias("terms"))
    # tiles compared with themselves name both orders, others one
    both = half.unionByName(half.where(F.floor(F.col("place") / tile) != F.floor(F.col("other") / tile))
                            .select("lang", F.col("other").alias("place"),
                                    F.col("place").alias("other"), "apart", "terms"))
    one = groups.select("lang", "place", "source", "base", "kept")
    two = groups.select("lang", F.col("place").alias("other"), F.col("source").alias("item"),
                        F.col("base").alias("other_base"))
    return both.join(one, ["lang", "place"]).join(two, ["lang", "other"]).select(
        "lang", "source", "item",
        (F.col("apart") + (F.col("kept") - F.col("terms")) * F.abs(F.col("base") - F.col("other_base")))
        .alias("value"))


def leading_terms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of terms that a source uses more than its
    language does."""
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    rows = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"),
        (share(F.col("n"), F.col("total"), F.col("kept")) - q).alias("value"))
    return rows.where(F.col("value") > 0)


def audit_sources(documents: DataFrame, text: str = "text", lang: str = "lang",
                  source: str = "source", min_documents: int = MIN_DOCUMENTS,
                  top_terms: int = TOP_TERMS, tile: int = TILE,
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(lang, source, part, item, value, rank): distance to every other source
    of the language (``pair``) and the terms that mark a source (``term``)."""
    kept = kept_counts(term_counts(documents, text, lang, source), min_documents)
    groups = source_groups(documents, kept, lang, source)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = source_pairs(kept, groups, tile, block_rows).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value",
        F.row_number().over(order).alias("rank"))
    terms = leading_terms(kept, groups).select(
        "lang", "source", F.lit("term").alias("part"), "item", "value",
        F.row_number().over(order).alias("rank")).where(F.col("rank") <= top_terms)
    return pairs.unionByName(terms)
