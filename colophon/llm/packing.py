"""Packing along a space-filling curve.

A document becomes a hashed vector of its words (counts in ``BUCKETS`` buckets, scaled to
unit length), projected to ``DIMS`` dimensions by a fixed Gaussian matrix. Each dimension is scaled
from the range of all documents to ``DEPTH`` bits, and the Hilbert index of the cell is the document's key. The documents are range-sorted by (key, doc_id) and
laid end to end along the curve; the line is cut every ``capacity`` words. So neighbours on the
curve share packs, every pack but the last is full, and a document longer than a pack goes on in the next ones. Each row has its piece of the text: the pieces of a document, one after another, are the
whole text (what stands before its first word belongs to the first piece, what stands after a word to the piece of that word).

Words are counted on whole texts. Rows without doc_id are left out. A null text counts as empty; documents
without words take no room and are in no pack. Rows that repeat an id are packed one after another, equal rows included.
An empty table gives an empty result. Columns besides doc_id and text don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textops as T
from .common import keyed, lean, written

BUCKETS, DIMS, DEPTH, CAPACITY, SEED = 256, 3, 10, 4096, 11


def projected(w: T.Words, buckets: int = BUCKETS, dims: int = DIMS) -> np.ndarray:
    n = w.hi - w.lo
    v = np.bincount(w.doc * buckets + (w.hash % np.uint64(buckets)).astype(np.int64), minlength=n * buckets).reshape(n, buckets).astype(float)
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    return v @ np.random.default_rng(SEED).normal(size=(buckets, dims))


def hilbert(cells: np.ndarray, depth: int) -> np.ndarray:
    """Index on the Hilbert curve of each row of cell coordinates (0 … 2**depth - 1), by Skilling's transposition."""
    x, n = cells.astype(np.int64).T.copy(), cells.shape[1]
    q = 1 << (depth - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            t = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (depth - 1)
    while q > 1:
        t = np.where(x[n - 1] & q, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(depth - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def vectors(docs: DataFrame) -> DataFrame:
    """(x0 …) for each document with words."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in T.each_words(b.column(1)):
                x = projected(w)[np.diff(w.first) > 0]
                yield pa.RecordBatch.from_arrays([pa.array(x[:, j]) for j in range(DIMS)], [f"x{j}" for j in range(DIMS)])

    return keyed(docs).mapInArrow(run, ", ".join(f"x{j} double" for j in range(DIMS)))


def curve_keys(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(doc_id, text, n_words, key) for each document with words. One step from text to key: a second one would
    need a second worker for each task, and texts sent through both."""
    edges = vectors(docs).agg(*(f(f"x{j}") for j in range(DIMS) for f in (F.min, F.max))).first()
    low = np.array([edges[2 * j] or 0 for j in range(DIMS)])
    width = np.maximum(np.array([edges[2 * j + 1] or 0 for j in range(DIMS)]) - low, 1e-12)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in T.each_words(b.column(1)):
                n = np.diff(w.first)
                cells = np.clip((projected(w) - low) / width * (1 << depth), 0, (1 << depth) - 1).astype(np.int64)
                rows = pa.RecordBatch.from_arrays([*(b.column(c)[w.lo : w.hi] for c in (0, 1)), pa.array(n), pa.array(hilbert(cells, depth))], ["doc_id", "text", "n_words", "key"])
                yield rows.filter(pa.array(n > 0))

    return keyed(docs).mapInArrow(run, "doc_id long, text string, n_words long, key long")


@lean
def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each row of curve_keys(), sorted, the words that stand before it in its part of the sort (start). The sum is
    carried on from batch to batch of a task; a window would need one more exchange, with the texts."""
    upto = 0
    for b in batches:
        n = b.column(2).to_numpy()
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(upto + np.cumsum(n) - n)], ["doc_id", "text", "n_words", "key", "start"])
        upto += int(n.sum())


def _cut(capacity: int):
    """The pieces of each document (doc_id, text, key, at), at being its first word's place on the line."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key, place = b.column(2).to_numpy(), b.column(3).to_numpy()
            for w in T.each_words(b.column(1)):
                at, n = place[w.lo : w.hi], np.diff(w.first)
                first = at // capacity
                many = (at + n - 1) // capacity - first + 1
                doc = np.repeat(np.arange(len(n)), many)
                pack = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
                lo, hi = np.maximum(at[doc], pack * capacity), np.minimum(at[doc] + n[doc], (pack + 1) * capacity)
                from_word, to_word = lo - at[doc], hi - at[doc]
                base, raw = w.first[doc], w.data
                start = np.where(from_word == 0, w.off[doc], w.start[np.minimum(base + from_word, len(w.start) - 1)])
                end = np.where(to_word == n[doc], w.off[doc + 1], w.start[np.minimum(base + to_word, len(w.start) - 1)])
                text = [raw[x:y].tobytes().decode() for x, y in zip(start.tolist(), end.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pack), pa.array(lo - pack * capacity), b.column(0)[w.lo : w.hi].take(pa.array(doc)), pa.array(key[w.lo : w.hi][doc]), pa.array(from_word), pa.array(hi - lo), pa.array(text, pa.string())],
                    ["pack_id", "position", "doc_id", "key", "first_word", "n_words", "text"],
                )

    return run


def packs(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(pack_id, position, doc_id, key, first_word, n_words, text): the pieces of documents in each pack;
    position is the piece's place in the pack, in words; first_word its first word in the document."""
    if capacity < 1:
        raise ValueError("capacity must be positive")
    keys = curve_keys(docs)
    # The sort is written once: part numbers come from a sample of the data, and must be the same for both uses.
    # Texts are exchanged once, for the sort: files of an exchange stay on disk until the driver collects its garbage.
    order = keys.repartitionByRange("key", "doc_id", "n_words").sortWithinPartitions("key", "doc_id", "n_words")
    line = written(order.mapInArrow(_along, "doc_id long, text string, n_words long, key long, start long").withColumn("part", F.spark_partition_id()), "line")
    # One row a partition of the sort: few, however many documents there are.
    before = line.groupBy("part").agg(F.sum("n_words").alias("words")).withColumn("before", F.sum("words").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    at = line.join(F.broadcast(before.select("part", F.coalesce("before", F.lit(0)).alias("before"))), "part")
    at = at.select("doc_id", "text", "key", (F.col("before") + F.col("start")).alias("at"))
    return at.mapInArrow(_cut(capacity), "pack_id long, position long, doc_id long, key long, first_word long, n_words long, text string")
