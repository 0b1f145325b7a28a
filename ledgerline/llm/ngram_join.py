"""N-gram Jaccard join with count-vector R-trees.

A document's set is its distinct ``K``-word shingles. The sets' hashes fall
into ``GROUPS`` groups, and the counts per group are the document's point: two
sets share at most the sum of the coordinate minima, so a pair whose sum is
too small for the similarity is dropped without looking at the sets. Points
that may be near each other meet in cells, and every cell holds an R-tree over
its points: leaves of similar points with the largest count per group, leaf
against leaf first, then point against point. Surviving pairs are bounded once
more in 65,536 groups where most of them are no links, and verified on the full
sets.

Cells come from a prefix filter, without which each point would meet each
other one: in one global order of shingles (rare first, by a sketch of fixed
size counted over all documents) two similar sets must share one of the first
quarter of their shingles, which for the smaller set is one of the first
seventh. The order decides the work only, never the result. Cells are summed in
windows; those of shingles that the sketch counts above a fixed share of all may
be large and are summed before the shuffle, and their sums joined back.

Documents with equal sets are one point. Clusters are joined in two rounds:
first every point is verified against the smallest point it shares most cells
with, then only points of different clusters that still share a cell meet. A
cell larger than ``TILE`` points is cut into tiles that are compared by
different tasks, so no task holds more than two tiles of a cell.

Defined cases: null and empty texts, and texts without words, have empty sets
and are linked with nothing; a text of fewer than ``K`` words is one shingle;
rows that share a doc_id are one document; a row without one is a copy of the
documents with its very set, else its component is null; an empty table gives an empty
result; only the named columns are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import connected_components
from .tables import join_small, small_side, stored
from .textbytes import (BLANK_WORD, LOWERED, mix, prefix_hash, shingle_hash, span_hash,
                        summed_blocks, text_chunks, words_of)

K = 5
GROUPS = 256
LEAF = 32
TILE = 512
SKETCH = 1 << 18
#: A shingle is hot when its slot of the sketch holds more than one in
#: ``HOT_PARTS`` of all counts, and more than ``HOT_LEAST``.
HOT_PARTS, HOT_LEAST = 4096, 512
# Similarity 75/100: pairs share 3/7 of their summed sizes or more.
NUMERATOR, DENOMINATOR = 75, 100


def shingle_sets(column: pa.Array, k: int = K) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text of a batch."""
    empty = np.zeros(0, np.uint64)
    for row, _, raw, offsets in text_chunks(column):
        data = LOWERED[raw]
        starts, ends, first = words_of(data, offsets, BLANK_WORD)
        words = span_hash(prefix_hash(data), starts, ends)
        grams = shingle_hash(words, k)
        for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
            if b - a >= k:
                yield row + i, np.unique(grams[a:b - k + 1])
            else:
                yield row + i, (shingle_hash(words[a:b], b - a) if b > a else empty)


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 18)).astype(np.int64)


def shingle_sketch(texts: DataFrame, k: int = K) -> np.ndarray:
    """Documents per slot of shingle hashes, counted over all texts; the
    number of slots is fixed."""
    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros(SKETCH, np.int64)
        for batch in batches:
            held: list[np.ndarray] = []
            n = 0
            for _, hashes in shingle_sets(batch.column(0), k):
                held.append(hashes)
                n += len(hashes)
                if n > 1 << 20:
                    out += np.bincount(_slot(np.concatenate(held)), minlength=SKETCH)
                    held, n = [], 0
            if held:
                out += np.bincount(_slot(np.concatenate(held)), minlength=SKETCH)
        return out

    return summed_blocks(texts, count, SKETCH, "int64")


def _pointer(sketch, k: int):
    """Arrow task: doc_id, text -> the point of each document: size, digest of
    the set, group counts, prefix in rarity order, its index part, and how many
    of its shingles, the first ones, are not hot."""
    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = sketch.value
        heavy = HOT_LEAST + seen.sum() // HOT_PARTS
        for batch in batches:
            out: dict[str, list] = {x: [] for x in ("n", "d1", "d2", "point", "prefix", "own", "cold")}
            for _, hashes in shingle_sets(batch.column(1), k):
                n = len(hashes)
                out["n"].append(n)
                out["d1"].append(int(mix(hashes).sum(dtype=np.uint64).view(np.int64)))
                out["d2"].append(int(mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))
                                     .sum(dtype=np.uint64).view(np.int64)))
                out["point"].append(np.bincount(
                    (hashes & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)
                    .astype(np.int32))
                counts = seen[_slot(hashes)]
                order = np.lexsort((hashes, counts))
                # probe prefix n - ceil(t n) + 1, index prefix n - ceil(2t/(1+t) n) + 1
                probe = n - -(-NUMERATOR * n // DENOMINATOR) + 1 if n else 0
                own = n - -(-2 * NUMERATOR * n // (DENOMINATOR + NUMERATOR)) + 1 if n else 0
                out["prefix"].append(hashes[order[:probe]].view(np.int64))
                out["own"].append(own)
                out["cold"].append(int((counts[order[:probe]] <= heavy).sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out["n"], pa.int32()), pa.array(out["d1"], pa.int64()),
                 pa.array(out["d2"], pa.int64()), pa.array(out["point"], pa.list_(pa.int32())),
                 pa.array(out["prefix"], pa.list_(pa.int64())), pa.array(out["own"], pa.int32()),
                 pa.array(out["cold"], pa.int32())],
                names=["doc_id", "n", "d1", "d2", "point", "prefix", "own", "cold"])
    return points


def document_points(documents: DataFrame, key: str = "doc_id", text: str = "text",
                    k: int = K) -> DataFrame:
    """Point, digest and prefix of every document, stored."""
    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketch = documents.sparkSession.sparkContext.broadcast(shingle_sketch(rows.select("text"), k))
    return stored(rows.mapInArrow(
        _pointer(sketch, k), "doc_id long, n int, d1 long, d2 long, "
                             "point array<int>, prefix array<long>, own int, cold int"),
        "join-points")


class RTree:
    """Points of a cell, packed into leaves of similar ones (by size, then by
    the coordinate that varies most), with the largest counts per leaf."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, leaf: int = LEAF):
        widest = int(points.var(axis=0).argmax()) if len(points) else 0
        slab = max(leaf, int(np.sqrt(len(points) * leaf)))
        by_size = np.argsort(sizes, kind="stable")
        order = np.concatenate([s[np.argsort(points[s, widest], kind="stable")] for s in
                                np.split(by_size, range(slab, len(points), slab))])
        self.leaves = np.split(order, range(leaf, len(points), leaf))
        self.points, self.sizes = points, sizes
        self.top = np.array([points[x].max(axis=0) for x in self.leaves])
        self.smallest = np.array([sizes[x].min() for x in self.leaves])

    def pairs(self, other: RTree, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Indices of points whose summed minima allow the similarity."""
        for i, a in enumerate(self.leaves):
            bound = np.minimum(self.top[i], other.top).sum(axis=1, dtype=np.int64)
            reach = 7 * bound >= 3 * (self.smallest[i] + other.smallest)
            for j in np.flatnonzero(reach):
                if same and j < i:
                    continue
                b = other.leaves[j]
                shared = np.minimum(self.points[a][:, None, :], other.points[b][None, :, :]
                                    ).sum(axis=2, dtype=np.int64)
                near = 7 * shared >= 3 * (self.sizes[a][:, None] + other.sizes[b][None, :])
                if same and i == j:
                    near = np.triu(near, 1)
                x, y = np.nonzero(near)
                if len(x):
                    yield a[x], b[y]


def _near(points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a cell of one leaf whose summed minima allow the similarity."""
    shared = np.minimum(points[:, None, :], points[None, :, :]).sum(axis=2, dtype=np.int64)
    return np.nonzero(np.triu(7 * shared >= 3 * (sizes[:, None] + sizes[None, :]), 1))


def _cell_pairs(cell: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Node pairs of one tile that may be similar and are not yet joined."""
    node, size, label = cell["node"], cell["n"], cell["label"]
    right = cell["side"] == 1
    left, found = [], []
    if not right.any():
        if len(node) <= LEAF:
            hits = [_near(cell["point"], size)]
        else:
            tree = RTree(cell["point"], size)
            hits = tree.pairs(tree, True)
        sides = (np.arange(len(node)),) * 2
    else:
        sides = np.flatnonzero(~right), np.flatnonzero(right)
        hits = RTree(cell["point"][sides[0]], size[sides[0]]).pairs(
            RTree(cell["point"][sides[1]], size[sides[1]]), False) if len(sides[0]) else ()
    for x, y in hits:
        x, y = sides[0][x], sides[1][y]
        apart = label[x] != label[y]
        left.append(node[x[apart]])
        found.append(node[y[apart]])
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(left), np.concatenate(found)
    return np.minimum(a, b), np.maximum(a, b)


CELL = ("x1", "x2", "i", "j")


def _tile_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow task over rows sorted by tile: holds a batch and one tile."""
    names = (*CELL, "side", "node", "n", "label")
    held: dict[str, np.ndarray] = {}

    def solved(rows: dict[str, np.ndarray], bounds: list[int]) -> pa.RecordBatch:
        pairs = [_cell_pairs({c: v[s:e] for c, v in rows.items()})
                 for s, e in zip(bounds[:-1], bounds[1:])]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([p[k] for p in pairs])) for k in (0, 1)], names=["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {c: batch.column(c).to_numpy() for c in names}
        rows["n"] = rows["n"].astype(np.int64)
        rows["point"] = batch.column("point").flatten().to_numpy().reshape(-1, GROUPS)
        if held:
            rows = {c: np.concatenate([held[c], v]) for c, v in rows.items()}
        new = np.zeros(len(rows["node"]) - 1, bool)
        for c in CELL:
            new |= rows[c][1:] != rows[c][:-1]
        bounds = [0, *(np.flatnonzero(new) + 1).tolist()]
        if len(bounds) > 1:
            yield solved(rows, bounds)
        held = {c: v[bounds[-1]:] for c, v in rows.items()}
    if held:
        yield solved(held, [0, len(held["node"])])


def _fine_bounded(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs whose sets, in 65,536 groups, allow the similarity.

    ``fine`` holds the groups of a set, each once; what two sets share is at
    most the groups they share plus the shingles that fell on a taken group."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("fine").alias("fa"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("fine").alias("fb"))
    doubled = F.least(F.col("na") - F.size("fa"), F.col("nb") - F.size("fb"))
    return pairs.join(left, "a").join(right, "b").where(
        7 * (F.size(F.array_intersect("fa", "fb")) + doubled) >= 3 * (F.col("na") + F.col("nb"))
    ).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full sets are similar."""
    left = sets.select(F.col("node").alias("a"), F.col("set").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - both
    return (pairs.join(left, "a").join(right, "b")
            .where(DENOMINATOR * both >= NUMERATOR * union).select("a", "b"))


def _setter(k: int):
    """Arrow task: node, text -> the set, its size and its 16-bit groups."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [h for _, h in shingle_sets(batch.column(1), k)]
            fine = [np.unique((h >> np.uint64(48)).astype(np.uint16)).view(np.int16) for h in held]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(h) for h in held], pa.int32()),
                 pa.array(fine, pa.list_(pa.int16())),
                 pa.array([h.view(np.int64) for h in held], pa.list_(pa.int64()))],
                names=["node", "n", "fine", "set"])
    return sets


def _bounded(pairs: DataFrame, coords: DataFrame) -> DataFrame:
    """Pairs (a, b) whose summed minima allow the similarity."""
    left = coords.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("point").alias("pa"))
    right = coords.select(F.col("node").alias("b"), F.col("n").alias("nb"),
                          F.col("point").alias("pb"))
    shared = F.aggregate(F.zip_with("pa", "pb", lambda x, y: F.least(x, y)), F.lit(0),
                         lambda s, x: s + x)
    return pairs.join(left, "a").join(right, "b").where(
        7 * shared >= 3 * (F.col("na") + F.col("nb"))).select("a", "b")


def with_cell_sums(rows: DataFrame, sums: dict[str, Column], keep: Column, name: str) -> DataFrame:
    """Rows (token, node, hot, ...) with the sums of their cell, those of cells
    that ``keep`` holds for. A cell that is not hot is one window, of a fixed
    share of all rows at most; hot ones are summed map-side first."""
    cell = Window.partitionBy("token")
    cold = rows.where(~F.col("hot")).withColumns({c: x.over(cell) for c, x in sums.items()}).where(keep)
    hot = rows.where("hot")
    cells = stored(hot.groupBy("token").agg(*[x.alias(c) for c, x in sums.items()]).where(keep), name)
    return cold.unionByName(join_small(hot, cells, ["token"], "node"))


def similar_documents(documents: DataFrame, key: str = "doc_id", text: str = "text",
                      k: int = K) -> tuple[DataFrame, DataFrame]:
    """(members, links): set size and representative of every document, and
    the verified links between representatives that connect each class."""
    points = document_points(documents, key, text, k)
    classes = stored(points.where(F.col("n") > 0).groupBy("n", "d1", "d2").agg(
        F.min("doc_id").alias("node")), "join-classes")
    members = points.select("doc_id", "n", "d1", "d2").join(
        classes, ["n", "d1", "d2"], "left").select("doc_id", "n", "node")
    texts = documents.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text"))

    def verified(pairs: DataFrame, name: str, mostly_links: bool) -> DataFrame:
        nodes = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(),
                       f"{name}-nodes")
        sets = stored(texts.join(small_side(nodes), "node", "left_semi").mapInArrow(
            _setter(k), "node long, n int, fine array<smallint>, set array<long>"), f"{name}-sets")
        if not mostly_links:
            pairs = stored(_fine_bounded(pairs, sets), f"{name}-near")
        return stored(_verified(pairs, sets), name)

    # One row per set and prefix shingle; a cell is worth something when it
    # holds two sets, one of them by its index prefix.
    reps = stored(points.join(classes.select(F.col("node").alias("doc_id"), "n", "d1", "d2"),
                              ["doc_id", "n", "d1", "d2"])
                  .select(F.col("doc_id").alias("node"), "n", "own", "cold", "prefix", "point"),
                  "join-reps")
    rows = reps.select("node", "n", "own", "cold", F.posexplode("prefix").alias("at", "token")).select(
        "token", "node", "n", (F.col("at") < F.col("own")).alias("own"),
        (F.col("at") >= F.col("cold")).alias("hot"))
    shared = stored(with_cell_sums(
        rows, {"c": F.count(F.lit(1)), "indexed": F.max("own"), "hub": F.min("node")},
        (F.col("c") > 1) & F.col("indexed"), "join-hot-cells").select(
        "token", "node", "n", "hot", "hub"), "join-cells")
    coords = stored(reps.select("node", "n", "point").join(
        shared.select("node").distinct(), "node", "left_semi"), "join-coords")

    # Round 1: each point against the hub it shares most cells with.
    hubs = (shared.where(F.col("hub") != F.col("node")).groupBy("node", "hub")
            .agg(F.count(F.lit(1)).alias("cells")).groupBy("node")
            .agg(F.max(F.struct(F.col("cells"), (-F.col("hub")).alias("minus"))).alias("best"))
            .select((-F.col("best.minus")).alias("a"), F.col("node").alias("b")))
    first = verified(stored(_bounded(hubs, coords), "join-hubs"), "join-links1", True)
    clusters = connected_components(first)

    # Round 2: points of different clusters that share a cell. Cells of the
    # same points are one cell, known by two sums over its points.
    labelled = shared.join(clusters, "node", "left").select(
        "token", "node", "n", "hot", F.coalesce("label", "node").alias("label"))
    mixed = with_cell_sums(
        labelled, {"c": F.count(F.lit(1)), "low": F.min("label"), "high": F.max("label"),
                   "x1": F.bit_xor(F.xxhash64("node")), "x2": F.bit_xor(F.xxhash64("node", F.lit(1)))},
        F.col("low") < F.col("high"), "join-hot-mixed").select(
        "x1", "x2", "c", "node", "n", "label").distinct()
    tiles = F.ceil(F.col("c") / TILE).cast("int")
    block = F.pmod(F.xxhash64("node", F.lit(2)), tiles).cast("int")
    placed = mixed.select("x1", "x2", "node", "label", block.alias("block"),
                          F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other"))
    placed = placed.select("x1", "x2", F.least("block", "other").alias("i"),
                           F.greatest("block", "other").alias("j"),
                           (F.col("block") > F.col("other")).cast("int").alias("side"),
                           "node", "label")
    pairs = (placed.join(coords, "node").select(*CELL, "side", "node", "n", "label", "point")
             .repartition(*CELL).sortWithinPartitions(*CELL)
             .mapInArrow(_tile_task, "a long, b long").distinct())
    second = verified(stored(pairs, "join-pairs"), "join-links2", False)
    return members, first.unionByName(second)


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text",
                    k: int = K) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    members, links = similar_documents(documents, key, text, k)
    labels = connected_components(links)
    return members.join(labels, "node", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("label", "node", "doc_id").alias("component_id"))


def distinct_documents(documents: DataFrame, key: str = "doc_id", text: str = "text",
                       k: int = K) -> DataFrame:
    """One document of each component (the smallest id), as they came."""
    found = near_duplicates(documents, key, text, k)
    gone = stored(found.where(F.col("component_id") != F.col("doc_id"))
                  .select(F.col("doc_id").alias("__gone")).distinct(), "join-gone")
    return documents.join(small_side(gone), F.col(key) == F.col("__gone"), "left_anti")
