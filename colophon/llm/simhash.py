"""SimHash near-duplicates by a binary trie self-join.

Every document gets a 252-bit SimHash of its distinct words, a word weighing as much as it
is long (up to 10 bytes), cut into ``TABLES`` keys of ``BITS`` bits. In each key two documents
are candidates if they differ in at most ``BUDGET`` bits. The keys of a table form a binary
trie; the self-join goes down pairs of nodes together, adds up differing bits, and drops a
pair of nodes as soon as it has more than ``BUDGET``. To spread one trie over a cluster, a
key is cut into BUDGET + 1 blocks: keys within the budget agree in at least one of them, so
each key is sent to one sub-trie per block, where the block comes first and must agree, and
a pair counts only in the first block in which it agrees. A candidate is a near-duplicate if no
more than ``TOTAL`` of the whole 256-bit signature differ; unrelated documents differ in about 120.

Every pair of different signatures that is a candidate in some table is a link, counted once: in the first table, and there in the
first block, in which it is one. So links are certain for pairs of at most TABLES * (BUDGET + 1) - 1 = 27 differing bits; between that and
``TOTAL`` a pair needs one table within the budget (README: measured shares). Classes are the connected components of links and equal signatures. In each sub-trie
the links found are reduced to a number for each node and a spanning forest, so that a class of any size costs rows in proportion to its
members; nothing is capped.

Result: one row for each document of a class of two or more: (doc_id, class_id, duplicate_of, n_copies, n_links). class_id is the least doc_id of the class; duplicate_of
is the same, but null for the one document that is kept; n_copies: other documents with the same signature; n_links: other signatures linked with this one.
A document without a row is a class of its own.

Rows without doc_id are left out. A null text counts as empty; documents without words are
duplicates of nothing. Rows equal in doc_id and text are one document; rows that repeat a doc_id with another text are documents of their own.
The document kept of a class has the least (doc_id, hash of its text). An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import keyed, lean, written

BITS, TABLES, BUDGET, TOTAL = 36, 7, 3, 42
PORTION = 4096  # words whose bits are held as numbers at a time, 1 KB each
U = np.uint64
SIGNATURE = "doc_id long, th long, s0 long, s1 long, s2 long, s3 long, n_words int"


def _word_bits(h: np.ndarray) -> np.ndarray:
    """The 256 bits of each word, as numbers."""
    four = np.stack([T.mix(h + U(0xA0761D6478BD642F * (j + 1) % (1 << 64))) for j in range(4)], axis=1)
    return np.unpackbits(four.view(np.uint8), axis=1, bitorder="little").astype(np.float32)


def signatures_of(words: T.Words) -> tuple[np.ndarray, np.ndarray]:
    """(one row of 4 x 64 bits for each document, number of distinct words)."""
    n = words.hi - words.lo
    out, size = np.zeros((n, 4), U), np.zeros(n, np.int32)
    if len(words.hash) == 0:
        return out, size
    doc = words.doc
    order = np.argsort((doc.astype(U) << U(44)) | (words.hash >> U(20)), kind="stable")
    h, d = words.hash[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = order[new]
    h, d = words.hash[at], doc[at]
    weight = np.clip(words.end[at] - words.start[at] - 1, 0.25, 9).astype(np.float32)
    first = np.searchsorted(d, np.arange(n + 1))
    size[:] = np.diff(first)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(first, first[lo] + PORTION, "right")) - 1)
        a, b = int(first[lo]), int(first[hi])
        if b - a > PORTION:  # one document; weights are quarters, so sums are exact in any order
            votes = sum((weight[x : min(b, x + PORTION)] @ _word_bits(h[x : min(b, x + PORTION)])).astype(float) for x in range(a, b, PORTION))
            out[lo] = np.packbits(votes * 2 > weight[a:b].sum(dtype=float), bitorder="little").view(U)
        elif b > a:
            bits = _word_bits(h[a:b])
            for k in range(lo, hi):
                x, y = first[k] - a, first[k + 1] - a
                if y > x:
                    w = weight[x + a : y + a]
                    out[k] = np.packbits(w @ bits[x:y] * 2 > w.sum(), bitorder="little").view(U)
        lo = hi
    return out, size


@lean
def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for w in T.each_words(b.column(1)):
            sig, n = signatures_of(w)
            sig = sig.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(j)[w.lo : w.hi] for j in (0, 2)), *(pa.array(sig[:, j]) for j in range(4)), pa.array(n, pa.int32())], ["doc_id", "th", "s0", "s1", "s2", "s3", "n_words"]
            )


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, th, s0 … s3, n_words) for each row of docs; th: a hash of the text, which tells rows of the same doc_id apart."""
    return keyed(docs).withColumn("th", F.xxhash64("text")).mapInArrow(_signatures, SIGNATURE)


def table_keys(sig: np.ndarray, bits: int = BITS, tables: int = TABLES) -> np.ndarray:
    """The keys of each signature, as integers: one column a table."""
    b = np.unpackbits(np.ascontiguousarray(sig).view(np.uint8), axis=1, bitorder="little")[:, : bits * tables].reshape(len(sig), tables, bits)
    return (b.astype(U) << np.arange(bits, dtype=U)).sum(axis=2, dtype=U)


def _rotated(key: np.ndarray, block: int, bits: int, budget: int) -> np.ndarray:
    """The key turned so that its block stands first (in the highest bits)."""
    by = block * (bits // (budget + 1))
    mask = U((1 << bits) - 1)
    return ((key << U(by)) | (key >> U(bits - by))) & mask if by else key


def _routes(bits: int, tables: int, budget: int):
    size = bits // (budget + 1)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            sig = np.stack([b.column(j).to_numpy(zero_copy_only=False) for j in range(1, 5)], axis=1).view(U)
            keys, n = table_keys(sig, bits, tables), len(sig)
            for t in range(tables):
                for k in range(budget + 1):
                    r = _rotated(keys[:, t], k, bits, budget)
                    route = (U((t * (budget + 1) + k) << size) | (r >> U(bits - size))).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(route), *b.columns[:5]], ["route", "node", "s0", "s1", "s2", "s3"])

    return run


def _leaf_pairs(p0: np.ndarray, p1: np.ndarray, q0: np.ndarray, q1: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All (i, j) of the ranges p × q, in portions of about ``most``."""
    n = (p1 - p0) * (q1 - q0)
    for k in np.flatnonzero(n > most).tolist():
        width = int(q1[k] - q0[k])
        step = max(1, most // width)
        for lo in range(int(p0[k]), int(p1[k]), step):
            hi = min(int(p1[k]), lo + step)
            yield np.repeat(np.arange(lo, hi), width), np.tile(np.arange(int(q0[k]), int(q1[k])), hi - lo)
    some = n <= most
    p0, q0, q1, n = p0[some], q0[some], q1[some], n[some]
    ends, a = np.cumsum(n), 0
    while a < len(n):
        z = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, "right")))
        m = n[a:z]
        k = np.arange(int(m.sum())) - np.repeat(np.cumsum(m) - m, m)
        width = np.repeat(q1[a:z] - q0[a:z], m)
        yield np.repeat(p0[a:z], m) + k // width, np.repeat(q0[a:z], m) + k % width
        a = z


def trie_pairs(key: np.ndarray, done: int, bits: int, budget: int, most: int = 1 << 19) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), i < j, of positions in the sorted array key that have the highest ``done``
    bits in common and differ in at most ``budget`` of the rest. Nodes of the trie are ranges of
    the array. The frontier is split when it exceeds ``most`` node pairs, so memory is bounded."""
    top = key >> U(bits - done)
    cut = np.flatnonzero(np.r_[True, top[1:] != top[:-1]]) if len(key) else np.zeros(0, np.int64)
    end = np.r_[cut[1:], len(key)].astype(np.int64)
    several = end - cut > 1
    a0, a1 = cut[several], end[several]
    todo = [(done, a0, a1, a0, a1, np.zeros(len(a0), np.int8))]
    while todo:
        level, a0, a1, b0, b1, diff = todo.pop()
        if len(a0) == 0:
            continue
        if len(a0) > most:
            half = len(a0) // 2
            todo += [(level, *(x[half:] for x in (a0, a1, b0, b1, diff))), (level, *(x[:half] for x in (a0, a1, b0, b1, diff)))]
            continue
        small = ((a1 - a0) * (b1 - b0) <= 64) | (level == bits)
        if small.any():
            for i, j in _leaf_pairs(a0[small], a1[small], b0[small], b1[small], most):
                ok = i < j
                i, j = i[ok], j[ok]
                ok = np.bitwise_count(key[i] ^ key[j]) <= budget
                yield i[ok], j[ok]
            big = ~small
            a0, a1, b0, b1, diff = a0[big], a1[big], b0[big], b1[big], diff[big]
            if len(a0) == 0:
                continue
        bit = U(bits - level - 1)

        def split(lo: np.ndarray) -> np.ndarray:
            return np.searchsorted(key, ((key[lo] >> bit) | U(1)) << bit)

        am, bm = np.clip(split(a0), a0, a1), np.clip(split(b0), b0, b1)
        same = (a0 == b0) & (a1 == b1)
        parts = []
        for x0, x1, y0, y1, plus, use in ((a0, am, b0, bm, 0, None), (am, a1, bm, b1, 0, None), (a0, am, bm, b1, 1, None), (am, a1, b0, bm, 1, ~same)):
            d = diff + np.int8(plus)
            ok = (x1 > x0) & (y1 > y0) & (d <= budget)
            if use is not None:
                ok &= use
            parts.append((x0[ok], x1[ok], y0[ok], y1[ok], d[ok]))
        todo.append((level + 1, *(np.concatenate(x) for x in zip(*parts))))


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For nodes 0 … n-1 and edges (i, j): the smallest node of each node's component."""
    label = np.arange(n)
    while len(i):
        a, b = label[i], label[j]
        lo, hi = np.minimum(a, b), np.maximum(a, b)
        np.minimum.at(label, hi, lo)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        open_ = label[i] != label[j]
        i, j = i[open_], j[open_]
    return label


def first_route(keys: np.ndarray, i: np.ndarray, j: np.ndarray, table: int, block: int, bits: int, budget: int) -> np.ndarray:
    """Which of the candidates (i, j) of a table and block are none in an earlier table, nor agree in an earlier block of this one."""
    first = np.ones(len(i), bool)
    for t in range(table):
        first &= np.bitwise_count(keys[i, t] ^ keys[j, t]) > budget
    size, x = bits // (budget + 1), keys[i, table] ^ keys[j, table]
    for k in range(block):
        first &= (x >> U(bits - (k + 1) * size)) & U((1 << size) - 1) != 0
    return first


def _edges(bits: int, tables: int, budget: int, total: int):
    size = bits // (budget + 1)

    def join(group: pa.Table) -> pa.RecordBatch:
        """(node, the least node it is connected with here, its links found here) for each node with links."""
        route = int(group.column("route")[0].as_py())
        t, k = divmod(route >> size, budget + 1)
        ids = group.column("node").to_numpy()
        sig = np.stack([group.column(f"s{j}").to_numpy() for j in range(4)], axis=1).view(U)
        keys = table_keys(sig, bits, tables)
        turned = _rotated(keys[:, t], k, bits, budget)
        order = np.lexsort((ids, turned))
        ids, sig, keys, turned = ids[order], sig[order], keys[order], turned[order]
        label, links = np.arange(len(ids)), np.zeros(len(ids), np.int64)
        for i, j in trie_pairs(turned, size, bits, budget):
            ok = np.bitwise_count(sig[i] ^ sig[j]).sum(axis=1) <= total
            i, j = i[ok], j[ok]
            ok = first_route(keys, i, j, t, k, bits, budget)
            i, j = i[ok], j[ok]
            if len(i):
                links += np.bincount(i, minlength=len(ids)) + np.bincount(j, minlength=len(ids))
                label = _merge(label, i, j)
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, label, ids)
        ok = links > 0
        return pa.RecordBatch.from_arrays([pa.array(ids[ok]), pa.array(least[label][ok]), pa.array(links[ok])], ["a", "b", "links"])

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if b.num_rows == 0:
                continue
            r = b.column(0).to_numpy()
            cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
            if held and held[0].column(0)[0].as_py() != r[0]:
                yield join(pa.Table.from_batches(held))
                held = []
            lo = 0
            for c in cuts.tolist():
                if held or c - lo > 1:
                    yield join(pa.Table.from_batches([*held, b.slice(lo, c - lo)]))
                held, lo = [], c
            held.append(b.slice(lo))
        if held:
            yield join(pa.Table.from_batches(held))

    return run


def _merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    sub = forest(len(label), label[i], label[j])
    return sub[label]


def components(edges: DataFrame) -> DataFrame:
    """(doc_id, root) for every node of edges (a, b), root being the least node of its component.
    Rounds of large-star and small-star, each written to the shared folder, until nothing changes."""
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(low.select("a", F.col("m").alias("b")))
        e = written(small.distinct(), "edges")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            return e.groupBy(F.col("a").alias("doc_id")).agg(F.min("b").alias("root"))
        before = tuple(now)


def classes(docs: DataFrame, bits: int = BITS, tables: int = TABLES, budget: int = BUDGET, total: int = TOTAL) -> DataFrame:
    """(doc_id, th, class_id, duplicate_of, n_copies, n_links) for each document of a class of two or more."""
    if bits % (budget + 1) or bits * tables > 256 or bits > 48:
        raise ValueError("bits must be a multiple of budget + 1, at most 48, and bits * tables at most 256")
    s = ["s0", "s1", "s2", "s3"]
    sig = written(signatures(docs).where("n_words > 0").select("doc_id", "th", *s).distinct(), "signatures")
    # Nodes are distinct signatures. They are numbered in a table that is written once, so that the numbers stay.
    nodes = sig.groupBy(*s).agg(F.min(F.struct("doc_id", "th")).alias("least"), F.count("*").alias("n"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    routed = nodes.select("node", *s).mapInArrow(_routes(bits, tables, budget), "route long, node long, s0 long, s1 long, s2 long, s3 long")
    near = written(routed.repartition("route").sortWithinPartitions("route").mapInArrow(_edges(bits, tables, budget, total), "a long, b long, links long"), "links")
    roots = components(near.select("a", "b")).withColumnRenamed("doc_id", "node")
    links = near.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    linked = nodes.join(links.join(roots, "node", "left"), "node", "left").where("links is not null or n > 1")
    linked = written(linked.select("node", *s, "least", "n", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links")), "linked")
    kept = linked.groupBy("root").agg(F.min("least").alias("kept"))
    members = sig.join(linked.join(kept, "root").select(*s, "kept", "n", "links"), s)
    is_kept = (F.col("doc_id") == F.col("kept.doc_id")) & (F.col("th") == F.col("kept.th"))
    return members.select("doc_id", "th", F.col("kept.doc_id").alias("class_id"), F.when(~is_kept, F.col("kept.doc_id")).alias("duplicate_of"), (F.col("n") - 1).alias("n_copies"), F.col("links").alias("n_links"))


def near_duplicates(docs: DataFrame, bits: int = BITS, tables: int = TABLES, budget: int = BUDGET, total: int = TOTAL) -> DataFrame:
    """(doc_id, class_id, duplicate_of, n_copies, n_links) for each document of a class of two or more."""
    return classes(docs, bits, tables, budget, total).drop("th")


def without_near_duplicates(docs: DataFrame) -> DataFrame:
    """docs, with all their columns, without the documents that duplicate the one kept of their class. Of rows equal in doc_id and text one stays. Rows without doc_id stay as they are."""
    names = docs.columns
    gone = classes(docs).where("duplicate_of is not null").select("doc_id", "th")
    row = F.struct(*(F.col(f"`{c}`") for c in names)).alias("row")  # so that no other column clashes
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), row)
    rows = rows.join(gone, ["doc_id", "th"], "left_anti").dropDuplicates(["doc_id", "th"])
    return rows.select("row.*").union(docs.where("doc_id is null"))
