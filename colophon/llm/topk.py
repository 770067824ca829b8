"""Exact top-k search by Fagin's threshold algorithm: the rows whose id is divisible by ``EVERY`` are queries, against all rows.

The score of two vectors is their inner product, rounded to ``DIGITS`` decimals (so that equal vectors tie whatever the order of summation); ties go to the smaller id, and no
row is its own neighbour. Rows are laid out in shards of similar vectors (the nearest of about sqrt(rows)/16 centres, found on a bounded sample; only
the layout depends on them). Vectors are turned to the principal axes of that sample, so that what differs most between rows comes first. A shard holds, for each of the first
``LISTS`` axes, the list of its rows sorted by that axis, and one more list by the length of the rest of the vector (the product of the lengths bounds that of the rests). A block of
queries goes down the lists of a shard together, from the top or, where a query's component is negative, from the bottom. At each depth the threshold is the
inner product of the query with the values reached; rows seen in any list are scored in full, and a query stops as soon
as the threshold cannot beat its kth result. At depth 0 the threshold is the bound from the shard's extremes: each query first searches its own shard, and then goes only to
the shards whose bound can still beat its kth score. Nothing is approximate and nothing capped: where bounds are
weak (vectors without structure in many dimensions, as the driver's) every shard is read to its end, and no exact search does better.

What is sent to all workers is two vectors of LISTS + 1 numbers for each shard, of which there are at most ``MOST_SHARDS`` more than centres: shards have up to max(``SHARD_ROWS``, sqrt(rows), rows/MOST_SHARDS) rows.

Rows without vec_id or embedding are left out, and those of another length than the most common one (ties: the longest). Null and NaN components count as 0.
Of rows that repeat a vec_id the least embedding counts. Fewer than k other rows: as many as there are. Empty tables give an empty result. Other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

K, EVERY, DIGITS, SAMPLE, BLOCK, LISTS, SHARD_ROWS, MOST_SHARDS, SEED = 10, 20, 9, 20_000, 1024, 16, 8192, 16_384, 3
HIT = "vec_id long, score double, neighbor_id long"
SLACK = 2e-9  # more than rounding can add


def centres(x: np.ndarray, n: int, rounds: int = 5) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    c = x[rng.choice(len(x), min(n, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        size = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c[size > 0] = total[size > 0] / size[size > 0, None]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmax(x @ c.T - (c * c).sum(axis=1) / 2, axis=1)


def turned(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """x along the axes, and the length of the rest."""
    y = x @ axes
    rest = np.sqrt(np.maximum((x * x).sum(axis=1) - (y * y).sum(axis=1), 0))
    return np.concatenate([y, rest[:, None]], axis=1)


def principal(x: np.ndarray, lists: int = LISTS) -> np.ndarray:
    """The first principal axes (about 0) of rows, as columns."""
    return np.linalg.eigh(x.T @ x)[1][:, ::-1][:, :lists]


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The most that an inner product of a turned query with vectors between low and high can be."""
    return np.maximum(q, 0) @ high + np.minimum(q, 0) @ low


class Shard:
    """Rows with their sorted lists."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, axes: np.ndarray):
        self.ids, self.x, self.axes = ids, x, axes
        y = turned(x, axes)
        self.lists = np.argsort(y, axis=0, kind="stable")  # column j: rows in ascending order of list j
        n, depth, self.steps = len(ids), 8, []
        seen = np.zeros(n, bool)
        while n and not seen.all():
            d = min(depth, n)
            fresh = np.zeros(n, bool)
            fresh[self.lists[:d, :-1].ravel()] = fresh[self.lists[n - d :].ravel()] = True  # the list of rests only from the top
            fresh &= ~seen
            seen |= fresh
            low, high = y[self.lists[d - 1], np.arange(y.shape[1])], y[self.lists[n - d], np.arange(y.shape[1])]
            low[-1] = 0
            self.steps.append((np.flatnonzero(fresh), low, high))
            depth *= 2

    def search(self, q_ids: np.ndarray, q: np.ndarray, least: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(place of the query, score, id) of everything that may be among the k best of a query; least: the score to be reached."""
        for a in range(0, len(q), BLOCK):
            yield from self._search(np.arange(a, min(a + BLOCK, len(q))), q_ids, q, least, k)

    def _search(self, at, q_ids, q, least, k):
        best_s = np.full((len(at), k), -np.inf)
        best_i = np.full((len(at), k), np.iinfo(np.int64).max)
        active, q_turned = np.arange(len(at)), turned(q[at], self.axes)
        for rows, low, high in self.steps:
            if len(active) == 0:
                break
            if len(rows):
                qa = q[at[active]]
                s = np.round(qa @ self.x[rows].T, DIGITS)
                s[q_ids[at[active]][:, None] == self.ids[rows][None, :]] = -np.inf
                if s.shape[1] > 4 * k:  # all that reach the kth score, ties included
                    kth = -np.partition(-s, k - 1, axis=1)[:, k - 1]
                    r, c = np.nonzero(s >= np.maximum(kth, np.maximum(least[at[active]], best_s[active, -1]))[:, None])
                else:
                    r, c = np.nonzero(s >= np.maximum(least[at[active]], best_s[active, -1])[:, None])
                touched = np.unique(r)
                all_r = np.r_[r, np.repeat(touched, k)]
                all_s, all_i = np.r_[s[r, c], best_s[active[touched]].ravel()], np.r_[self.ids[rows][c], best_i[active[touched]].ravel()]
                order = np.lexsort((all_i, -all_s, all_r))
                all_r, all_s, all_i = all_r[order], all_s[order], all_i[order]
                first = np.searchsorted(all_r, touched)
                take = first[:, None] + np.arange(k)
                best_s[active[touched]], best_i[active[touched]] = all_s[take], all_i[take]
            threshold = bounds(q_turned[active], low, high)
            active = active[threshold + SLACK >= np.maximum(best_s[active, -1], least[at[active]])]
        r, c = np.nonzero(best_s > -np.inf)
        yield at[r], best_s[r, c], best_i[r, c]


def _matrix(b: pa.RecordBatch, name: str, d: int) -> np.ndarray:
    return b.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """(vec_id, rank, neighbor_id, score): the k best neighbours, among all rows, of each row whose id is divisible by ``every``; rank from 1."""
    if k < 1:
        raise ValueError("k must be positive")
    spark = vectors.sparkSession
    clean = vectors.where("vec_id is not null and embedding is not null and size(embedding) > 0").groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("embedding").alias("v"))
    clean = written(clean.select("vec_id", F.transform("v", lambda x: F.when(x.isNull() | F.isnan(x), 0.0).otherwise(x.cast("double"))).alias("v")), "vectors")
    common = clean.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    empty = spark.createDataFrame([], "vec_id long, rank int, neighbor_id long, score double")
    if common is None:
        return empty
    d, n = common["d"], common["count"]
    clean = clean.where(F.size("v") == d)
    some = np.array([r.v for r in clean.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()])
    c, axes = centres(some, max(1, round(n**0.5 / 16))), principal(some)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(nearest(_matrix(b, "v", d), c).astype(np.int64)), *b.columns], ["cell", "vec_id", "v"])

    placed = written(clean.mapInArrow(assign, "cell long, vec_id long, v array<double>"), "cells")
    rows = max(SHARD_ROWS, int(n**0.5), n // MOST_SHARDS)
    parts = placed.groupBy("cell").agg((F.floor(F.count("*") / rows) + 1).alias("parts"))
    shards = written(placed.join(F.broadcast(parts), "cell").withColumn("shard", F.col("cell") * 1_000_000 + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).select("shard", "vec_id", "v"), "shards")  # parts: one row for each centre

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                y, (name, of) = turned(_matrix(b, "v", d), axes), np.unique(b.column("shard").to_numpy(), return_inverse=True)
                low, high = np.full((len(name), y.shape[1]), np.inf), np.full((len(name), y.shape[1]), -np.inf)
                np.minimum.at(low, of, y)
                np.maximum.at(high, of, y)
                yield pa.RecordBatch.from_arrays([pa.array(name), *(pa.array(z[:, j]) for z in (low, high) for j in range(y.shape[1]))], ["shard", *(f"{z}{j}" for z in "lh" for j in range(y.shape[1]))])

    width = axes.shape[1] + 1
    names_of = [f"{z}{j}" for z in "lh" for j in range(width)]
    ends = shards.mapInArrow(extremes, "shard long, " + ", ".join(f"{x} double" for x in names_of)).groupBy("shard").agg(*((F.min if x[0] == "l" else F.max)(x) for x in names_of)).collect()  # two vectors a shard
    names = np.array([r[0] for r in ends], np.int64)
    low, high = (np.array([r[a : a + width] for r in ends], float).reshape(len(ends), width) for a in (1, 1 + width))
    low[:, -1] = 0
    sent = spark.sparkContext.broadcast((names, low.T, high.T))
    asks = F.col("vec_id") % every == 0

    def hits(q_ids, found):
        for r, s, i in found:
            if len(r):
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[r]), pa.array(s), pa.array(i)], ["vec_id", "score", "neighbor_id"])

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
        """Batches sorted by their first column, cut where it changes."""
        for b in batches:
            if b.num_rows == 0:
                continue
            s = b.column(0).to_numpy()
            edges = np.r_[0, np.flatnonzero(s[1:] != s[:-1]) + 1, len(s)]
            for x, y in zip(edges.tolist(), edges[1:].tolist()):
                yield int(s[x]), b.slice(x, y - x)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None

        def run():
            t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            ids = t.column("vec_id").to_numpy()
            q = ids % every == 0
            yield from hits(ids[q], Shard(ids, x := _matrix(t, "v", d), axes).search(ids[q], x[q], np.full(int(q.sum()), -np.inf), k))

        for shard, b in groups(batches):
            if held and shard != now:
                yield from run()
                held.clear()
            now = shard
            held.append(b)
        if held:
            yield from run()

    def routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, low, high = sent.value
        for b in batches:
            for a in range(0, b.num_rows, BLOCK):
                t = b.slice(a, BLOCK)
                q, home = _matrix(t, "v", d), t.column("shard").to_numpy()
                least = np.where(t.column("kth").is_null().to_numpy(zero_copy_only=False), -np.inf, t.column("kth").to_numpy(zero_copy_only=False))
                bound = bounds(turned(q, axes), low, high)
                go = (bound + SLACK >= least[:, None]) & (names[None, :] != home[:, None])
                for j in np.flatnonzero(go.any(axis=0)).tolist():
                    at = pa.array(np.flatnonzero(go[:, j]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), names[j])), pa.array(np.ones(len(at), np.int32)), t.column("vec_id").take(at), t.column("v").take(at), pa.array(least[at.to_numpy()])], ["shard", "kind", "vec_id", "v", "least"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now, made, asked, n_asked = [], None, None, [], 0

        def answer():
            t = pa.Table.from_batches(asked).combine_chunks().to_batches()[0]
            ids = t.column("vec_id").to_numpy()
            yield from hits(ids, made.search(ids, _matrix(t, "v", d), t.column("least").to_numpy(), k))

        for shard, b in groups(batches):
            if shard != now:
                if asked:
                    yield from answer()
                held, asked, n_asked, made, now = [], [], 0, None, shard
            kind = b.column("kind").to_numpy()
            cut = int(np.searchsorted(kind, 1))
            if cut:
                held.append(b.slice(0, cut))
            if cut < b.num_rows:
                if made is None:
                    t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    made, held = Shard(t.column("vec_id").to_numpy(), _matrix(t, "v", d), axes), []
                asked.append(b.slice(cut))
                n_asked += b.num_rows - cut
                if n_asked >= 4 * BLOCK:
                    yield from answer()
                    asked, n_asked = [], 0
        if asked:
            yield from answer()

    first = written(shards.repartition("shard").sortWithinPartitions("shard").mapInArrow(own, HIT), "own")
    kth = first.groupBy("vec_id").agg(F.count("*").alias("m"), F.min("score").alias("s")).where(F.col("m") >= k).select("vec_id", F.col("s").alias("kth"))
    asked = shards.where(asks).join(kth, "vec_id", "left").select("shard", "vec_id", "v", "kth").mapInArrow(routes, "shard long, kind int, vec_id long, v array<double>, least double")
    there = shards.select("shard", F.lit(0).alias("kind"), "vec_id", "v", F.lit(None).cast("double").alias("least"))
    more = there.union(asked).repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(others, HIT)
    rank = F.row_number().over(Window.partitionBy("vec_id").orderBy(F.desc("score"), "neighbor_id"))
    return first.union(more).withColumn("rank", rank).where(F.col("rank") <= k).select("vec_id", "rank", "neighbor_id", "score")


def sql(k: int = K, every: int = EVERY) -> str:
    """top_k() of embeddings, for DuckDB."""
    return f"""
WITH c AS (SELECT vec_id, min(embedding) AS v FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0 GROUP BY 1),
e AS (SELECT vec_id, list_transform(v, lambda x: CASE WHEN x IS NULL OR isnan(x) THEN 0 ELSE x END::DOUBLE) AS v FROM c
  WHERE len(v) = (SELECT len(v) FROM c GROUP BY 1 ORDER BY count(*) DESC, 1 DESC LIMIT 1)),
s AS (SELECT a.vec_id, b.vec_id AS neighbor_id, round(list_dot_product(a.v, b.v), {DIGITS}) + 0.0 AS score FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.vec_id % {every} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, neighbor_id)::INTEGER AS rank FROM s)
SELECT vec_id, rank, neighbor_id, score FROM r WHERE rank <= {k}"""
