"""Threshold-scaled sketches: of a document's shingles, every hash below a fixed fraction of the range.

A shingle is ``WORDS`` successive words (runs without ASCII white space); a document of fewer words is one
shingle of those it has. A word's value is the first 60 bits of its MD5, taken once for each distinct word of a worker; a shingle's hash
is the sum of its words' values, each times a fixed odd number by its place, modulo 2**64, without the lowest 4 bits. SQL can state
the same. Because the threshold is the same for all, the sketch of a union is the union of
sketches (``merged``), and |A ∩ B| / |A| of sketches estimates the containment of A in B however unequal they
are (``containment``).

Rows without an id are left out. Null and empty texts have an empty sketch. Rows that repeat an id have a sketch each;
in containment their sketches are merged. Empty tables give empty results. Other columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textops as T
from .common import keyed, written

WORDS, FRACTION = 5, 1 / 16
FACTOR = 0x9E3779B97F4A7C15
REMEMBERED = 1_000_000  # words whose values a worker keeps before it starts afresh


def factors(n: int) -> list[int]:
    """The odd number of each place of a shingle, below 2**60 so that SQL can multiply without overflow."""
    return [(pow(FACTOR, k + 1, 1 << 60)) for k in range(n)]


def threshold(fraction: float) -> int:
    """The least hash that isn't retained."""
    if not 0 < fraction <= 1:
        raise ValueError("fraction must be in (0, 1]")
    return round(fraction * (1 << 60))


def word_values(w: T.Words, known: dict[int, int]) -> np.ndarray:
    distinct, at, inverse = np.unique(w.hash, return_index=True, return_inverse=True)
    if len(known) > REMEMBERED:
        known.clear()
    raw, out = w.data.tobytes(), []
    for h, lo, hi in zip(distinct.tolist(), w.start[at].tolist(), w.end[at].tolist()):
        v = known.get(h)
        if v is None:
            known[h] = v = int(hashlib.md5(raw[lo:hi]).hexdigest()[:15], 16)
        out.append(v)
    return np.array(out, np.uint64)[inverse] if out else np.zeros(0, np.uint64)


def sketches(docs: DataFrame, key: str = "doc_id", n: int = WORDS, fraction: float = FRACTION, wanted: np.ndarray | None = None) -> DataFrame:
    """(key, n_shingles, sketch) for each row; sketch: the distinct retained hashes, ascending. With ``wanted`` (of ``bitmap``)
    only those that may be among its hashes."""
    bound, times = np.uint64(threshold(fraction)), np.array(factors(n), np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, int] = {}
        for b in batches:
            for w in T.each_words(b.column(1), normal=False):
                v = word_values(w, known)
                h = np.zeros(len(v), np.uint64)
                place = np.arange(len(v))
                for k in range(n):  # words past the document's end count as 0; only a short document's first shingle has such
                    x = v[k:] * times[k]
                    h[: len(x)] += np.where(place[: len(x)] + k < w.last[: len(x)], x, np.uint64(0))
                h >>= np.uint64(4)
                words = np.diff(w.first)
                count = np.where(words == 0, 0, np.maximum(words - (n - 1), 1))
                doc = w.doc
                retained = h < bound
                if wanted is not None:
                    retained &= wanted[(h >> np.uint64(42)).astype(np.int64)] >> (h >> np.uint64(36) & np.uint64(63)) & np.uint64(1) > 0
                ok = np.flatnonzero((place - w.first[:-1][doc] < count[doc]) & retained)
                order = np.lexsort((h[ok], doc[ok]))
                d, g = doc[ok][order], h[ok][order]
                new = np.r_[True, (d[1:] != d[:-1]) | (g[1:] != g[:-1])][: len(d)]
                d, g = d[new], g[new]
                sizes = np.bincount(d, minlength=w.hi - w.lo)
                yield pa.RecordBatch.from_arrays([b.column(0)[w.lo : w.hi], pa.array(count.astype(np.int32)), T.list_array(g.astype(np.int64), sizes, pa.int64())], [key, "n_shingles", "sketch"])

    return keyed(docs, key).mapInArrow(run, f"{key} long, n_shingles int, sketch array<long>")


def bitmap(hashes: DataFrame) -> np.ndarray:
    """2**24 bits, one for the first 24 bits of a hash, set where the column h has such a hash: 2 MB, however many there are."""
    found = hashes.select(F.shiftright("h", 42).cast("int").alias("word"), F.expr("shiftleft(1L, cast(shiftright(h, 36) & 63 as int))").alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << 18, np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def merged(sketches: DataFrame, by: str) -> DataFrame:
    """(by, sketch): the union of the sketches of each group."""
    return sketches.select(by, F.explode("sketch").alias("h")).distinct().groupBy(by).agg(F.array_sort(F.collect_list("h")).alias("sketch"))


def containment(a: DataFrame, b: DataFrame, a_key: str, b_key: str) -> DataFrame:
    """(a_key, b_key, shared, a_in_b, b_in_a) for every pair of a row of a and one of b that share a retained hash. One join by hash:
    what is exchanged are retained hashes, a fixed fraction of the shingles."""
    x = a.select(F.col(a_key).alias("_a"), F.explode("sketch").alias("h")).distinct()
    y = b.select(F.col(b_key).alias("_b"), F.explode("sketch").alias("h")).distinct()
    size = lambda d, k, to: d.groupBy(k).agg(F.count("*").alias(to))
    shared = x.join(y, "h").groupBy("_a", "_b").agg(F.count("*").alias("shared"))
    return (
        shared.join(size(x, "_a", "na"), "_a")
        .join(size(y, "_b", "nb"), "_b")
        .select(F.col("_a").alias(a_key), F.col("_b").alias(b_key), "shared", (F.col("shared") / F.col("na")).alias("a_in_b"), (F.col("shared") / F.col("nb")).alias("b_in_a"))
    )


def fingerprints(docs: DataFrame, items: DataFrame, n: int = WORDS, fraction: float = FRACTION, item_key: str = "item_id") -> DataFrame:
    """One row for each document: (doc_id, n_shingles, sketch, item_id, item_containment). sketch: its hashes, separated by spaces;
    item_id: the row of ``items`` that the document contains most of (the least id of equals), and how much, by the sketches; null where it shares nothing."""
    s = written(sketches(docs, "doc_id", n, fraction), "sketches")
    y = sketches(items, item_key, n, fraction).select(F.col(item_key).alias("i"), F.explode("sketch").alias("h")).distinct()
    y = written(y.withColumn("n", F.count("*").over(Window.partitionBy("i"))), "items")
    shared = s.select("doc_id", F.explode("sketch").alias("h")).join(y, "h").groupBy("doc_id", "i", "n").agg(F.countDistinct("h").alias("k"))
    best = shared.groupBy("doc_id").agg(F.min(F.struct((-F.col("k") / F.col("n")).alias("c"), "i")).alias("best"))
    best = best.select("doc_id", F.col("best.i").alias("item_id"), F.round(-F.col("best.c"), 6).alias("item_containment"))
    return s.join(best, "doc_id", "left").select("doc_id", "n_shingles", F.array_join(F.col("sketch").cast("array<string>"), " ").alias("sketch"), "item_id", "item_containment")


def passages(docs: DataFrame, items: DataFrame, n: int = WORDS, item_key: str = "item_id") -> DataFrame:
    """(doc_id, item_id, shared, item_containment) for every document and row of ``items`` that share a shingle: counted over all their
    distinct shingles, not over sketches, so that short items are found as well. Of the documents, only shingles that may be in an item are exchanged."""
    y = sketches(items, item_key, n, 1.0).select(F.col(item_key).alias("item_id"), F.explode("sketch").alias("h")).distinct()
    y = written(y.withColumn("n", F.count("*").over(Window.partitionBy("item_id"))), "items")
    x = sketches(docs, "doc_id", n, 1.0, bitmap(y)).select("doc_id", F.explode("sketch").alias("h"))
    shared = x.join(y, "h").groupBy("doc_id", "item_id", "n").agg(F.countDistinct("h").alias("shared"))
    return shared.select("doc_id", "item_id", "shared", F.round(F.col("shared") / F.col("n"), 6).alias("item_containment"))


def passages_sql(n: int = WORDS) -> str:
    """passages() of documents and benchmark, for DuckDB: from the words themselves, without hashes."""
    def shingles(table: str, key: str) -> str:
        return f"""
  SELECT DISTINCT id, array_to_string(w[i : i + {n - 1}], ' ') AS s
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - {n - 1}, 1) + 1)) AS i FROM (
    SELECT {key} AS id, list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS w
    FROM {table} WHERE {key} IS NOT NULL) WHERE len(w) > 0)"""

    return f"""
WITH d AS MATERIALIZED ({shingles("documents", "doc_id")}),
b AS MATERIALIZED ({shingles("benchmark", "item_id")}),
pairs AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS shared FROM d JOIN b USING (s) GROUP BY ALL)
SELECT doc_id, item_id, shared, round(shared / n, 6) AS item_containment
FROM pairs JOIN (SELECT id AS item_id, count(*) AS n FROM b GROUP BY 1) USING (item_id)"""


def sql(n: int = WORDS, fraction: float = FRACTION) -> str:
    """fingerprints() of documents and benchmark, for DuckDB."""
    def sketch(table: str, key: str) -> str:
        return f"""
  SELECT {key} AS id, row_number() OVER () AS r, list_filter(string_split_regex(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS w
  FROM {table} WHERE {key} IS NOT NULL"""

    values = "list_transform(w, lambda x: ('0x' || substr(md5(x), 1, 15))::BIGINT::HUGEINT)"
    total = " + ".join(f"coalesce(v[i + {k}], 0) * {f} % 18446744073709551616" for k, f in enumerate(factors(n)))
    hashes = f"""
  SELECT DISTINCT r, id, h FROM (
    SELECT r, id, ((({total}) % 18446744073709551616) // 16)::BIGINT AS h
    FROM (SELECT r, id, v, unnest(range(1, greatest(len(v) - {n - 1}, 1) + 1)) AS i FROM (SELECT r, id, {values} AS v FROM {{0}} WHERE len(w) > 0)))
  WHERE h < {threshold(fraction)}"""
    return f"""
WITH d AS MATERIALIZED ({sketch("documents", "doc_id")}),
b AS MATERIALIZED ({sketch("benchmark", "item_id")}),
dh AS MATERIALIZED ({hashes.format("d")}),
bh AS MATERIALIZED ({hashes.format("b")}),
pairs AS (
  SELECT x.id AS item_id, y.id AS doc_id, count(*) AS shared
  FROM (SELECT DISTINCT id, h FROM bh) x JOIN (SELECT DISTINCT id, h FROM dh) y USING (h) GROUP BY ALL),
ranked AS (
  SELECT doc_id, item_id, round(shared / na, 6) AS item_containment,
    row_number() OVER (PARTITION BY doc_id ORDER BY shared / na DESC, item_id) AS k
  FROM pairs JOIN (SELECT id AS item_id, count(DISTINCT h) AS na FROM bh GROUP BY 1) USING (item_id))
SELECT d.id AS doc_id, CASE WHEN len(w) = 0 THEN 0 ELSE greatest(len(w) - {n - 1}, 1) END AS n_shingles,
  coalesce(s.sketch, '') AS sketch, p.item_id, p.item_containment
FROM d LEFT JOIN (SELECT r, string_agg(h::VARCHAR, ' ' ORDER BY h) AS sketch FROM dh GROUP BY r) s USING (r)
LEFT JOIN ranked p ON p.doc_id = d.id AND p.k = 1"""
