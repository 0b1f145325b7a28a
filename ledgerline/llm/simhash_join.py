"""SimHash near-duplicates through a Gray-order hierarchical index.

A document's fingerprint has a bit for each bit that is set in more than half
of its shingles' XXH64 hashes. Documents whose fingerprints differ in ``REACH``
bits or fewer are linked.

Fingerprints that differ in two bits or fewer agree in two of four blocks of 16
bits, so each distinct fingerprint is sent to six cells, one for each choice of
two blocks; a cell is named by the choice and its 32 bits. Inside a cell the
fingerprints are sorted by Gray rank, where neighbours differ in few bits, and
an index is built over runs of them, bottom up: a node knows the bits that all
of its members share (a mask and a pattern), and those that the node above it
shares already are factored out of it. A search carries the differences down:
each node adds those in its own bits, and a group whose sum exceeds ``REACH``
is left with all its members.

A cell of more than ``CROWDED`` fingerprints is not searched: its members move
to cells named by two of four blocks of the other 32 bits as well. 48 bits are
fixed there, so such a cell has at most 65,536 members, whatever the data. Every
pair within reach meets in some cell, so no link is lost. What leaves a cell is
its own connected groups, one row per member, not all its pairs.

Documents of equal fingerprints are one point. Components are those of the
links; their smallest doc_id is looked up at the end.

Defined cases: null and empty texts, and texts without words, have fingerprint
zero, which is linked like any other; a text of fewer than ``K`` words is one
shingle; repeated rows are rows of their own with equal results; a row without
doc_id gets the component of its fingerprint, but links nothing (null where no
other row has the fingerprint); long texts are read whole; an empty table gives
an empty result; only the named columns are read, so other columns cannot
clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .tables import join_small, stored
from .textbytes import BLANK_WORD, LOWERED, text_chunks, words_of

K = 3
SEED = 42
REACH = 2
CROWDED = 2048      # fingerprints of a cell that are searched in one index
FANOUT = 8
QUERIES = 1 << 14   # fingerprints searched at once
LONG = 256          # shingle bytes hashed one by one beyond this length

# The constants of XXH64.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
    0x27D4EB2F165667C5))


def _turned(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def xxh64_rows(rows: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of each row of a matrix of bytes (rows of one length)."""
    n, size = rows.shape

    def lane(at: int, width: int) -> np.ndarray:
        part = np.ascontiguousarray(rows[:, at:at + width])
        return part.view(f"<u{width}").ravel().astype(np.uint64)

    with np.errstate(over="ignore"):
        seed64, at = np.uint64(seed), 0
        if size >= 32:
            state = [np.full(n, s, np.uint64) for s in (
                seed64 + _P1 + _P2, seed64 + _P2, seed64, seed64 - _P1)]
            while at + 32 <= size:
                for i in range(4):
                    state[i] = _turned(state[i] + lane(at + 8 * i, 8) * _P2, 31) * _P1
                at += 32
            h = sum((_turned(s, r) for s, r in zip(state, (1, 7, 12, 18))), np.zeros(n, np.uint64))
            for s in state:
                h = (h ^ (_turned(s * _P2, 31) * _P1)) * _P1 + _P4
        else:
            h = np.full(n, seed64 + _P5, np.uint64)
        h = h + np.uint64(size)
        while at + 8 <= size:
            h = _turned(h ^ (_turned(lane(at, 8) * _P2, 31) * _P1), 27) * _P1 + _P4
            at += 8
        if at + 4 <= size:
            h = _turned(h ^ (lane(at, 4) * _P1), 23) * _P2 + _P3
            at += 4
        while at < size:
            h = _turned(h ^ (lane(at, 1) * _P5), 11) * _P1
            at += 1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return h ^ (h >> np.uint64(32))


def span_xxh64(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
               seed: int = SEED) -> np.ndarray:
    """XXH64 of data[start:start + size] for each span; spans of one length
    are hashed together."""
    out = np.empty(len(starts), np.uint64)
    order = np.argsort(sizes, kind="stable")
    ends = np.flatnonzero(np.r_[np.diff(sizes[order]) != 0, True]) + 1 if len(order) else []
    begin = 0
    for end in ends:
        rows, begin = order[begin:end], end
        size = int(sizes[rows[0]])
        if size > LONG:
            for r in rows.tolist():
                s = int(starts[r])
                out[r] = xxhash.xxh64_intdigest(data[s:s + size].tobytes(), seed)
        else:
            out[rows] = xxh64_rows(data[starts[rows][:, None] + np.arange(size)], seed)
    return out


def fingerprints(column: pa.Array, k: int = K) -> Iterator[np.ndarray]:
    """Fingerprints of the texts of a batch, in runs."""
    for row, end, raw, offsets in text_chunks(column):
        starts, ends, first = words_of(LOWERED[raw], offsets, BLANK_WORD)
        # the words of the chunk, one blank behind each
        spread = np.zeros(len(raw) + 1, np.int32)
        spread[starts] += 1
        spread[ends] -= 1
        inside = np.cumsum(spread[:-1]) > 0
        size = ends - starts
        place = np.r_[0, np.cumsum(size + 1)]
        data = np.full(place[-1], 0x20, np.uint8)
        keep = np.ones(len(data), bool)
        keep[place[1:] - 1] = False
        data[keep] = LOWERED[raw[inside]]
        # shingles never cross texts: one text's are its runs of k words
        n_words = np.diff(first)
        n_grams = np.where(n_words >= k, n_words - k + 1, np.minimum(n_words, 1))
        doc = np.repeat(np.arange(end - row), n_grams)
        begin = np.r_[0, np.cumsum(n_grams)]
        word = np.arange(begin[-1]) - begin[doc] + first[doc]
        until = word + np.minimum(n_words[doc], k)
        hashes = span_xxh64(data, place[word], place[until] - 1 - place[word])
        out = np.zeros(end - row, np.uint64)
        some = np.flatnonzero(n_grams)
        if len(some):
            for bit in range(64):
                ones = np.add.reduceat(((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int64),
                                       begin[some])
                out[some] |= (2 * ones > n_grams[some]).astype(np.uint64) << np.uint64(bit)
        yield out


def document_fingerprints(documents: DataFrame, key: str = "doc_id", text: str = "text",
                          k: int = K) -> DataFrame:
    """(doc_id, fingerprint) of every row, stored; fingerprints as longs."""
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [x for x in fingerprints(batch.column(1), k)]
            values = np.concatenate(held) if held else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fingerprint"])

    return stored(rows.mapInArrow(task, "doc_id long, fingerprint long"), "simhash")


# ---------------------------------------------------------------------------
# The index of a cell
# ---------------------------------------------------------------------------

def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray order."""
    out = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


class GrayIndex:
    """Hierarchical index over cells of fingerprints, each cell in Gray order.

    ``levels[0]`` are the fingerprints; a node of a level covers up to
    ``FANOUT`` nodes below it and never two cells. ``own`` are the bits that a
    node's members share and its parent's members do not."""

    def __init__(self, codes: np.ndarray, cell: np.ndarray, fanout: int = FANOUT):
        full = np.full(len(codes), ~np.uint64(0))
        levels = [{"mask": full, "pattern": codes, "cell": cell,
                   "last": np.arange(len(codes))}]
        while True:
            below = levels[-1]
            edge = np.flatnonzero(np.r_[True, np.diff(below["cell"]) != 0])
            inside = np.arange(len(below["cell"])) - np.repeat(
                edge, np.diff(np.r_[edge, len(below["cell"])]))
            if not (inside > 0).any():
                break
            first = np.flatnonzero(inside % fanout == 0)
            ones = np.bitwise_and.reduceat(below["mask"] & below["pattern"], first)
            zeros = np.bitwise_and.reduceat(below["mask"] & ~below["pattern"], first)
            child_end = np.r_[first[1:], len(inside)]
            levels.append({"mask": ones | zeros, "pattern": ones, "cell": below["cell"][first],
                           "first": first, "end": child_end, "last": below["last"][child_end - 1]})
        for upper, lower in zip(levels[1:], levels[:-1]):
            parent = np.repeat(np.arange(len(upper["first"])), upper["end"] - upper["first"])
            lower["own"] = lower["mask"] & ~upper["mask"][parent]
        self.codes, self.levels = codes, levels
        self.root = np.cumsum(np.r_[False, np.diff(cell) != 0])     # of each fingerprint

    def pairs(self, reach: int = REACH, queries: int = QUERIES
              ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (i, j), i < j, of one cell within reach of each other."""
        for begin in range(0, len(self.codes), queries):
            query = np.arange(begin, min(begin + queries, len(self.codes)))
            node = self.root[query]
            apart = np.zeros(len(query), np.int64)
            for upper, lower in zip(self.levels[:0:-1], self.levels[-2::-1]):
                n = upper["end"][node] - upper["first"][node]
                start = np.r_[0, np.cumsum(n)]
                child = (np.arange(start[-1]) - np.repeat(start[:-1], n)
                         + np.repeat(upper["first"][node], n))
                query, apart = np.repeat(query, n), np.repeat(apart, n)
                apart = apart + np.bitwise_count(
                    (self.codes[query] ^ lower["pattern"][child]) & lower["own"][child])
                near = (apart <= reach) & (lower["last"][child] > query)
                query, node, apart = query[near], child[near], apart[near]
            if len(self.levels) > 1:
                yield query, node


def joined_groups(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest place that each of ``n`` places is connected with."""
    label = np.arange(n)
    for a, b in pairs:
        while True:
            low = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            while True:
                next_label = label[label]
                if (next_label == label).all():
                    break
                label = next_label
            if (label == before).all():
                break
    return label


def _cell_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow task: (choice, bits, code) sorted by cell and Gray rank -> links
    (a, b) that connect what is connected inside each cell. Holds a batch and
    one cell."""
    names = ("choice", "bits", "code")
    held: dict[str, np.ndarray] = {}

    def solved(rows: dict[str, np.ndarray], cell: np.ndarray) -> pa.RecordBatch:
        codes = rows["code"].view(np.uint64)
        label = joined_groups(len(codes), GrayIndex(codes, cell).pairs())
        moved = np.flatnonzero(label != np.arange(len(codes)))
        return pa.RecordBatch.from_arrays(
            [pa.array(rows["code"][label[moved]]), pa.array(rows["code"][moved])],
            names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {c: batch.column(c).to_numpy() for c in names}
        if held:
            rows = {c: np.concatenate([held[c], v]) for c, v in rows.items()}
        new = (rows["choice"][1:] != rows["choice"][:-1]) | (rows["bits"][1:] != rows["bits"][:-1])
        cell = np.cumsum(np.r_[False, new])
        last = int(np.searchsorted(cell, cell[-1]))
        if last:
            yield solved({c: v[:last] for c, v in rows.items()}, cell[:last])
        held = {c: v[last:] for c, v in rows.items()}
    if held:
        yield solved(held, np.zeros(len(held["code"]), np.int64))


# ---------------------------------------------------------------------------
# Cells over the cluster
# ---------------------------------------------------------------------------

def _blocks(code: Column, width: int, among: list[int]) -> Column:
    """Bits of blocks of ``width`` bits of a code, put together."""
    out = F.lit(0).cast("long")
    for b in among:
        part = F.shiftrightunsigned(code, b * width).bitwiseAND(F.lit((1 << width) - 1))
        out = F.shiftleft(out, width).bitwiseOR(part)
    return out


def _gray_rank(code: Column) -> Column:
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


def _choices() -> list[tuple[list[int], list[int]]]:
    """(two chosen blocks of four, the other two)."""
    return [(list(c), [b for b in range(4) if b not in c]) for c in combinations(range(4), 2)]


def cells(codes: DataFrame) -> DataFrame:
    """(choice, bits, code): the six cells of every code."""
    code = F.col("code")
    return codes.select("code", F.inline(F.array(*[
        F.struct(F.lit(i).alias("choice"), _blocks(code, 16, chosen).alias("bits"))
        for i, (chosen, _) in enumerate(_choices())]))).select("choice", "bits", "code")


def finer_cells(rows: DataFrame) -> DataFrame:
    """Members of crowded cells in cells of 48 fixed bits: two of four blocks
    of 8 of the 32 bits that their cell does not fix."""
    code = F.col("code")
    rest = F.element_at(F.array(*[_blocks(code, 16, others) for _, others in _choices()]),
                        F.col("choice") + 1)
    return rows.select("choice", "bits", "code", rest.alias("rest")).select(
        "code", "choice", "bits", F.inline(F.array(*[
            F.struct(F.lit(i).alias("finer"), _blocks(F.col("rest"), 8, chosen).alias("more"))
            for i, (chosen, _) in enumerate(_choices())]))).select(
        (F.col("choice") * 6 + F.col("finer") + 6).alias("choice"),
        F.shiftleft("bits", 16).bitwiseOR(F.col("more")).alias("bits"), "code")


def fingerprint_links(codes: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Links (a, b) that connect all distinct codes within reach, stored."""
    spread = stored(cells(codes), "simhash-cells")
    full = stored(spread.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("n"))
                  .where(F.col("n") > crowded).select("choice", "bits"), "simhash-crowded")
    n_full = full.count()
    rows = spread
    if n_full:
        calm = join_small(spread, full, ["choice", "bits"], "code", "left_anti", n_full)
        busy = join_small(spread, full, ["choice", "bits"], "code", "left_semi", n_full)
        rows = calm.select("choice", "bits", "code").unionByName(finer_cells(busy))
    rank = _gray_rank(F.col("code"))
    ordered = (rows.repartition("choice", "bits")
               .sortWithinPartitions("choice", "bits", rank < 0, rank))
    return stored(ordered.mapInArrow(_cell_task, "a long, b long").distinct(), "simhash-links")


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text", k: int = K,
                    crowded: int = CROWDED) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row: the smallest doc_id
    that links of fingerprints reach."""
    rows = document_fingerprints(documents, key, text, k)
    points = stored(rows.where(F.col("doc_id").isNotNull()).groupBy(
        F.col("fingerprint").alias("code")).agg(F.min("doc_id").alias("low")), "simhash-points")
    labels = connected_components(fingerprint_links(points.select("code"), crowded))
    # Points without a link stay out of the components; the others take the
    # smallest id below their label.
    linked = stored(labels.withColumnRenamed("node", "code").join(points, "code"), "simhash-linked")
    lowest = linked.groupBy("label").agg(F.min("low").alias("component_id"))
    moved = linked.join(lowest, "label").select("code", "component_id")
    classes = points.join(moved, "code", "left").select(
        F.col("code").alias("fingerprint"), F.coalesce("component_id", "low").alias("component_id"))
    return rows.join(classes, "fingerprint", "left").select("doc_id", "fingerprint", "component_id")
