"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Each document becomes a vector of statistics of its whole text (``STATISTICS``). Random Fourier
features z(x) = sqrt(2/D) cos(Wx + b) approximate a Gaussian kernel over the standardised
statistics. Every partition of the labelled rows sums its own part of the normal equations
Z'Z and Z'y; the parts are added and ridge weights solved for. Scores of held-out labelled rows
are calibrated to probabilities by isotonic regression (pool adjacent violators).

The model is fitted on at most ``sample`` labelled rows (those with the least hash of doc_id),
a fifth of them held out for calibration. Every document is scored.

A null text counts as empty, and an empty text is scored like any other. Rows without doc_id are
scored as well. Rows that repeat an id are scored one by one. Labels without doc_id or quality are left out; an id with both
labels counts as the lower. Without rows of both classes there is no model: every document gets
probability 1 and is kept. Empty tables give empty results. Columns besides doc_id and text don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import lean, written

SAMPLE, FEATURES, RIDGE, WIDTH, KEEP, SEED = 20_000, 256, 0.1, 2.0, 0.5, 7
STATISTICS = [
    "log_bytes", "log_words", "word_mean", "word_spread", "letters", "upper", "digits", "marks", "spaces", "lines", "not_ascii",
    "distinct", "commonest", "echo", "longest", "entropy", "marks_a_word", "capitals_a_word",
]
_CLASS = np.full(256, 3, np.uint8)  # 0 lower, 1 upper, 2 digit, 3 mark, 4 space, 5 line end, 6 not ASCII
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[[9, 11, 12, 13, 32]], _CLASS[10], _CLASS[128:] = 0, 1, 2, 4, 5, 6


def statistics_of(w: T.Words) -> np.ndarray:
    """One row of STATISTICS for each document."""
    n = w.hi - w.lo
    size = np.diff(w.off).astype(float)
    doc_of_byte = np.repeat(np.arange(n), np.diff(w.off))
    by_byte = np.bincount((doc_of_byte << 8) | w.data, minlength=n << 8).reshape(n, 256)
    share = np.zeros((n, 7))
    for c in range(7):
        share[:, c] = by_byte[:, _CLASS == c].sum(axis=1)
    some = np.maximum(size, 1)
    p = by_byte / some[:, None]
    entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)
    words = np.diff(w.first).astype(float)
    many = np.maximum(words, 1)
    length = (w.end - w.start).astype(float)
    doc = w.doc
    mean = np.bincount(doc, length, n) / many
    spread = np.sqrt(np.maximum(np.bincount(doc, length**2, n) / many - mean**2, 0))
    longest, distinct, commonest = np.zeros(n), np.zeros(n), np.zeros(n)
    echo = np.zeros(n)
    if len(doc):
        np.maximum.at(longest, doc, length)
        key = np.sort((doc.astype(np.uint64) << np.uint64(44)) | (w.hash >> np.uint64(20)))
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        run, of = np.diff(np.r_[new, len(key)]).astype(float), (key[new] >> np.uint64(44)).astype(np.int64)
        distinct = np.bincount(of, minlength=n) / many
        np.maximum.at(commonest, of, run)
        commonest /= many
        echo = np.bincount(doc[1:], (w.hash[1:] == w.hash[:-1]) & (doc[1:] == doc[:-1]), n) / many
    return np.stack(
        [np.log1p(size), np.log1p(words), mean, spread, (share[:, 0] + share[:, 1]) / some, share[:, 1] / some, share[:, 2] / some, share[:, 3] / some, share[:, 4] / some, share[:, 5] / some, share[:, 6] / some,
         distinct, commonest, echo, np.log1p(longest), entropy, share[:, 3] / many, share[:, 1] / many], axis=1,
    )


@lean
def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for w in T.each_words(b.column(0)):
            x = statistics_of(w)
            yield pa.RecordBatch.from_arrays([T.list_array(x.ravel(), np.full(len(x), x.shape[1]), pa.float64()), *(b.column(j)[w.lo : w.hi] for j in (1, 2))], ["x", "y", "held"])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: np.ndarray
    b: np.ndarray
    beta: np.ndarray
    level: np.ndarray
    value: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.cos(np.clip((x - self.mean) / self.scale, -8, 8) @ self.w + self.b) * np.sqrt(2 / len(self.b))
        return np.concatenate([z, np.ones((len(x), 1))], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.beta

    def probability(self, score: np.ndarray) -> np.ndarray:
        return np.interp(score, self.level, self.value)


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (mean score, fitted value) of each block, both ascending. Equal scores are one point."""
    level, inverse, count = np.unique(score, return_inverse=True, return_counts=True)
    total = np.bincount(inverse, y)
    blocks: list[list[float]] = []
    for s, t, c in zip(level * count, total, count):
        blocks.append([s, t, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            top = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], top)]
    s, t, c = np.array(blocks).T
    return s / c, t / c


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES, ridge: float = RIDGE) -> Model | None:
    """A model of the labels (doc_id, quality), or None without rows of both classes."""
    y = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min("quality").cast("double").alias("y"))
    some = y.orderBy(F.xxhash64("id"), "id").limit(sample).withColumn("held", F.pmod(F.xxhash64("id", F.lit("held")), F.lit(5)) == 0)
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(some), "id")  # at most `sample` rows are broadcast
    x = written(rows.select("text", "y", "held").mapInArrow(_statistics, "x array<double>, y double, held boolean"), "statistics")
    k = len(STATISTICS)
    m = x.agg(F.count("*"), F.min("y"), F.max("y"), *(f(F.col("x")[j]) for j in range(k) for f in (F.avg, F.stddev_pop))).first()
    if not m[0] or m[1] == m[2]:
        return None
    mean, scale = np.array(m[3::2], float), np.maximum(np.array(m[4::2], float), 1e-9)
    rng = np.random.default_rng(SEED)
    w, b = rng.normal(size=(k, features)) / (WIDTH * np.sqrt(k)), rng.uniform(0, 2 * np.pi, features)
    model = Model(mean, scale, w, b, np.zeros(features + 1), np.zeros(1), np.zeros(1))

    @lean
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, c = np.zeros((features + 1, features + 1)), np.zeros(features + 1)
        for part in batches:
            if part.num_rows:
                z = model.features(part.column(0).flatten().to_numpy().reshape(-1, k))
                a += z.T @ z
                c += z.T @ part.column(1).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()), pa.array([c.tobytes()], pa.binary())], ["a", "c"])

    a, c = np.zeros((features + 1, features + 1)), np.zeros(features + 1)
    for r in x.where("not held").select("x", "y").coalesce(8).mapInArrow(sums, "a binary, c binary").toLocalIterator():
        a += np.frombuffer(r.a).reshape(a.shape)
        c += np.frombuffer(r.c)
    model.beta = np.linalg.solve(a + ridge * np.eye(features + 1), c)
    held = x.where("held").select("x", "y").toPandas()  # at most `sample` rows
    if len(held) == 0:
        held = x.select("x", "y").toPandas()
    model.level, model.value = isotonic(model.score(np.stack(held.x)), held.y.to_numpy())
    return model


def _scored(model: Model | None, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    score, p = np.ones(len(texts)), np.ones(len(texts))
    if model is not None:
        for w in T.each_words(texts):
            score[w.lo : w.hi] = model.score(statistics_of(w))
        p = model.probability(score)
    return score, p


def scores(docs: DataFrame, model: Model | None, keep: float = KEEP) -> DataFrame:
    """(doc_id, score, probability, keep) for every row of docs."""

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s, p = _scored(model, b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s), pa.array(p), pa.array(p >= keep)], ["doc_id", "score", "probability", "keep"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, probability double, keep boolean")


def accepted(docs: DataFrame, model: Model | None, keep: float = KEEP) -> DataFrame:
    """The rows of docs, with all their columns, whose probability is at least ``keep``."""
    at = docs.columns.index("text")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(_scored(model, b.column(at))[1] >= keep))

    return docs.mapInArrow(run, docs.schema)
