"""Vectorised word and shingle hashing over Arrow text columns.

Used inside Arrow tasks: a batch's texts are one byte array with offsets, and
words, word hashes and shingle hashes of many texts come from a few numpy
passes. Spark partitions, shuffles and joins what comes out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

CHUNK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: list[np.ndarray] = []

LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
#: Bytes of words between blanks: all but 0x20 and 0x09-0x0D.
BLANK_WORD = np.ones(256, bool)
BLANK_WORD[[0x20, *range(0x09, 0x0E)]] = False
#: Bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing; the bytes
#: of all characters from 0x80 on belong to words.
PLAIN_WORD = np.zeros(256, bool)
PLAIN_WORD[0x30:0x3A] = PLAIN_WORD[0x61:0x7B] = PLAIN_WORD[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bit mixer of 64-bit values (splitmix64's last steps)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        one = np.ones(1, np.uint64)
        _POWERS[:] = [np.cumprod(np.concatenate([one, np.full(size - 1, b, np.uint64)]))
                      for b in (_BASE, _INVERSE)]
    return _POWERS[0], _POWERS[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial hash; ``span_hash`` reads spans from it."""
    power, _ = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] for each span, the same wherever it stands."""
    _, inverse = _powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * inverse[starts])


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of about
    ``limit`` bytes, at least one row each; null texts are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset:column.offset + len(column) + 1]
    values = column.buffers()[2]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def words_of(data: np.ndarray, offsets: np.ndarray, table: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, word offsets of the texts); no word spans two texts."""
    inside = table[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_hash(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` word hashes (runs may cross texts)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += words[j:j + n]
    return mix(out)


def summed_blocks(frame: DataFrame, vectors: Callable[[Iterator[pa.RecordBatch]], np.ndarray],
                  n: int, dtype: str, blocks: int = 16) -> np.ndarray:
    """Sum over all tasks of a fixed-size vector that each task makes from its
    batches (``n`` numbers whatever the input). Vectors are cut into blocks,
    which are added up in parallel; the driver gets ``n`` numbers."""
    size = n // blocks

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = vectors(batches)
        for i in range(blocks):
            part = whole[i * size:(i + 1) * size]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                    names=["block", "part"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums.setdefault(i, np.zeros(size, dtype))
                sums[i] += np.frombuffer(part.as_buffer(), dtype)
        for i, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                names=["block", "part"])

    schema = "block int, part binary"
    parts = frame.mapInArrow(made, schema).repartition(blocks, "block").mapInArrow(added, schema)
    out = np.zeros(n, dtype)
    for row in parts.collect():
        out[row.block * size:(row.block + 1) * size] = np.frombuffer(row.part, dtype)
    return out
