"""Language-model scores by deleted interpolation.

A word w after the words u, v has the probability

    l3(b) c(uvw)/c(uv) + l2(b) c(vw)/c(v) + l1(b) c(w)/N + l0(b) / (V + 1)

with maximum-likelihood estimates from counts, mixed by weights of the bucket b of the contexts' frequencies, floor(log2(c(uv) + 1)) up to ``BUCKETS2`` and floor(log2(c(v) + 1)) up to
``BUCKETS1``. Every document begins after boundaries and ends before one, which is predicted like a word. A tenth of the documents (``HELD``, by the hash of doc_id) is held out:
expectation-maximisation learns the weights from their events, and ``PRIOR`` more for each weight, with counts from which they are deleted. Scores are then given to all documents, each with counts of all documents from which its own are
deleted. So what a document says by itself is new, and what another says as well is known.

For expectation-maximisation, events are gathered as a histogram of (bucket, logarithms of the three estimates, rounded to 1/``STEP``): an estimate is off by a factor of exp(1/(2 STEP)) at most, so the mean
log-likelihood of the weights found is within 1/STEP of the best (tests: weights within 0.1 of exact ones in every bucket, small ones too). The driver holds the histogram, whose size doesn't depend on the number of documents.

Words are those of textops (no ASCII case), as 64-bit hashes; n-grams are counted by the upper bits of 64-bit hashes, ``KEPT`` more than tell shards apart, so that about one n-gram in 250 000 shares its count with
another, at any size of the input. Texts are cut at document boundaries into pieces, written once as sequences of word numbers. A piece asks each shard for the counts of its distinct n-grams: sorted, so that
differences of hashes are sent. A shard adds up all pieces and sends back counts in the same order; n-grams aren't sent again, but made again from the piece. No count is dropped or approximated, nothing is broadcast but the
weights. Pieces and shards grow with the square root of the input beyond 50 GB of text (up to ``GROWTH`` times), so that a request doesn't get small.

Rows without doc_id are left out. Null and empty texts have no words and no score (null). Rows that repeat an id are scored one by one, and each counts. Without a held-out
document with words the weights stay equal. Empty tables give an empty result. Columns besides doc_id and text don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textops as T
from .common import keyed, written

HELD, BUCKETS2, BUCKETS1, STEP, PIECE, SHARD, BYTES_A_GRAM, KEPT, GROWTH, PRIOR = 10, 8, 16, 4, 2 << 20, 2_000_000, 3.3, 40, 8, 1
U = np.uint64
EDGE = U(0x5851F42D4C957F2D)
ZERO = -(1 << 14)  # stands for the logarithm of an estimate of 0


def packed(x: np.ndarray) -> bytes:
    """Non-negative integers, plane by plane of their bytes; planes of zeros at the top are left out, and others that are mostly 0 cost little."""
    x = np.ascontiguousarray(x.astype(U))
    planes = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
    body = np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T[:planes]).tobytes()
    return len(x).to_bytes(5, "little") + bytes([planes]) + (zstandard.ZstdCompressor(level=1).compress(body) if planes else b"")


def unpacked(b: bytes) -> np.ndarray:
    n, planes = int.from_bytes(b[:5], "little"), b[5]
    out = np.zeros((n, 8), np.uint8)
    if planes:
        out[:, :planes] = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[6:]), np.uint8).reshape(planes, -1).T
    return out.view(np.int64).ravel()


def held_out(ids: np.ndarray) -> np.ndarray:
    return T.mix(ids.astype(np.int64).view(U) + U(0x2545F4914F6CDD1D)) % U(HELD) == 0


def pair(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    return T.mix(context * U(0x9E3779B97F4A7C15) + word)


PIECES = "held boolean, n_events long, ids binary, sizes binary, sequence binary, words binary"
ASKED = "shard int, piece long, held boolean, words binary, word_counts binary, grams binary, gram_counts binary"
ANSWERED = "shard int, piece long, held boolean, vocabulary long, words binary, grams binary, train_words binary, train_grams binary"


def _row(schema: str, **values) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([values.get(n)], kinds[t]) for n, t in fields], [n for n, _ in fields])


def _pieces(size: int):
    """A row for each piece of one kind (held out or not): its documents' ids and numbers of words, its words in order, by their rank in frequency, and the hash of each rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held = held_out(b.column(0).to_numpy())
            for kind in (False, True):
                part = b.filter(pa.array(held == kind))
                for w in T.each_words(part.column(1), size=size):
                    words, of, n = np.unique(w.hash, return_inverse=True, return_counts=True)
                    order = np.argsort(-n, kind="stable")
                    rank = np.empty_like(order)
                    rank[order] = np.arange(len(order))
                    sizes = np.diff(w.first)
                    yield _row(PIECES, held=kind, n_events=int((sizes + (sizes > 0)).sum()), ids=part.column(0)[w.lo : w.hi].to_numpy().astype(np.int64).tobytes(), sizes=packed(sizes), sequence=packed(rank[of]), words=words[order].tobytes())

    return run


class Piece:
    """The events of a piece, and the places of their n-grams among its distinct ones, which are sorted by hash."""

    def __init__(self, row: dict, shards: int):
        self.ids = np.frombuffer(row["ids"], np.int64)
        n = self.sizes = unpacked(row["sizes"])
        hashes = np.frombuffer(row["words"], U)
        some = np.flatnonzero(n)
        size = n[some] + 1
        at = np.cumsum(size) - size
        total = int(size.sum())
        word = np.full(total, EDGE, U)
        last = np.zeros(total, bool)
        last[at + size - 1] = True
        word[~last] = hashes[unpacked(row["sequence"])] if total else []
        self.first = np.zeros(total, bool)
        self.first[at] = True
        self.doc = np.repeat(some, size)
        before = np.r_[EDGE, word[:-1]] if total else word  # the boundary that ends a document stands before the next
        two = pair(before, word)
        before_two = np.r_[U(0), two[:-1]] if total else two
        before_two[self.first] = EDGE
        three = T.mix(before_two * U(0xD6E8FEB86659FD93) + word)
        shift = U(max(0, 64 - KEPT - max(shards - 1, 0).bit_length()))
        self.words, self.word, self.word_n = np.unique(T.mix(word + U(0x632BE59BD9B4E019)) >> shift, return_inverse=True, return_counts=True)
        self.grams, inverse, self.gram_n = np.unique(np.r_[two, three] >> shift, return_inverse=True, return_counts=True)
        self.two, self.three = inverse[:total], inverse[total:]
        self.shift, self.shards = shift, shards

    def cuts(self, x: np.ndarray) -> np.ndarray:
        """Where the sorted hashes of each shard begin, and the end."""
        return np.searchsorted(shard_of(x << self.shift, self.shards), np.arange(self.shards + 1))

    def estimates(self, words: np.ndarray, grams: np.ndarray, total: int, own: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bucket, p3, p2, p1) of each event from counts in the order of self.words and self.grams; own: whether the counts hold the documents' own, which are then deleted."""
        c1, c2, c3 = words[self.word], grams[self.two], grams[self.three]
        n = np.full(len(c1), total, np.int64)
        if own and len(c1):
            c1, c2, c3 = c1 - self._own(self.word), c2 - self._own(self.two), c3 - self._own(self.three)
            n = n - (self.sizes + 1)[self.doc]
        # The boundary that ends a document counts as often as the one that begins it.
        end = np.flatnonzero(np.r_[self.first[1:], True])[np.cumsum(self.first) - 1] if len(c1) else np.zeros(0, np.int64)
        begins = c1[end]
        one, two = np.r_[c1[:0], np.roll(c1, 1)], np.r_[c2[:0], np.roll(c2, 1)]
        one, two = np.where(self.first, begins, one), np.where(self.first, begins, two)
        share = lambda a, b: np.where(b > 0, a / np.maximum(b, 1), 0.0)
        bucket = np.minimum(np.log2(two + 1).astype(np.int64), BUCKETS2) * (BUCKETS1 + 1) + np.minimum(np.log2(one + 1).astype(np.int64), BUCKETS1)
        return bucket, share(c3, two), share(c2, one), share(c1, n)

    def _own(self, gram: np.ndarray) -> np.ndarray:
        """How often each event's n-gram stands in its document."""
        _, inverse, n = np.unique(self.doc * (int(gram.max()) + 1) + gram, return_inverse=True, return_counts=True)
        return n[inverse]


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    """The shard of a hash: a range of its upper 24 bits."""
    return ((h >> U(40)) * U(shards) >> U(24)).astype(np.int64)


def differences(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=U(0))


def _asked(shards: int):
    """For each piece, a row for each shard with its distinct n-grams there, as differences, and how often it has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                r = b.slice(k, 1).to_pylist()[0]
                p = Piece(r, shards)
                w, g = p.cuts(p.words), p.cuts(p.grams)
                for s in np.flatnonzero(np.diff(w) + np.diff(g)).tolist():
                    a, z, c, y = w[s], w[s + 1], g[s], g[s + 1]
                    yield _row(ASKED, shard=s, piece=r["piece"], held=r["held"], words=packed(differences(p.words[a:z])), word_counts=packed(p.word_n[a:z]), grams=packed(differences(p.grams[c:y])), gram_counts=packed(p.gram_n[c:y]))

    return run


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each piece that asked: counts over all documents, and for a held-out piece over those not held out, in the order asked. A shard is held whole. One row of each shard has its number of distinct words."""
    rows: list[dict] = []

    def summed(column: str) -> tuple[list[bytes], list[bytes | None], int]:
        hashes = [np.cumsum(unpacked(r[column]).view(U)) for r in rows]
        size = np.array([len(x) for x in hashes])
        n = np.concatenate([unpacked(r[column[:-1] + "_counts"]) for r in rows])
        flat = np.concatenate(hashes)
        keys, inverse = np.unique(flat, return_inverse=True)
        every = np.bincount(inverse, n, len(keys)).astype(np.int64)
        train = np.bincount(inverse, n * ~np.repeat([r["held"] for r in rows], size), len(keys)).astype(np.int64)
        ends = np.cumsum(size)
        parts = list(zip((ends - size).tolist(), ends.tolist()))
        return [packed(every[inverse[a:z]]) for a, z in parts], [packed(train[inverse[a:z]]) if r["held"] else None for r, (a, z) in zip(rows, parts)], len(keys)

    def answer():
        words, train_words, vocabulary = summed("words")
        grams, train_grams, _ = summed("grams")
        for i, r in enumerate(rows):
            yield _row(ANSWERED, shard=r["shard"], piece=r["piece"], held=r["held"], vocabulary=0 if i else vocabulary, words=words[i], grams=grams[i], train_words=train_words[i], train_grams=train_grams[i])

    for b in batches:
        for k in range(b.num_rows):
            r = b.slice(k, 1).to_pylist()[0]
            if rows and rows[0]["shard"] != r["shard"]:
                yield from answer()
                rows = []
            rows.append(r)
    if rows:
        yield from answer()


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[dict]]]:
    """(piece, answers in the order of shards), from rows sorted by piece and shard; the piece's own row comes first."""
    now, answers = None, []
    for b in batches:
        for k in range(b.num_rows):
            r = b.slice(k, 1).to_pylist()[0]
            if r["shard"] < 0:
                if now is not None:
                    yield now, answers
                now, answers = r, []
            else:
                answers.append(r)
    if now is not None:
        yield now, answers


def learned(histogram: list[tuple], vocabulary: int, rounds: int = 200) -> np.ndarray:
    """Weights (l3, l2, l1, l0) of each bucket by expectation-maximisation over rows (bucket, log p3, log p2, log p1, events); ZERO stands for an estimate of 0. Each weight has ``PRIOR`` events more, so that a bucket with few events keeps some of each; one without has equal weights."""
    weights = np.full(((BUCKETS2 + 1) * (BUCKETS1 + 1), 4), 1 / 4)
    if not len(histogram):
        return weights
    x = np.array(histogram, float)
    b, n = x[:, 0].astype(int), x[:, 4]
    p = np.stack([*(np.where(x[:, j] > ZERO, np.exp(x[:, j]), 0) for j in (1, 2, 3)), np.full(len(b), 1 / (vocabulary + 1))], axis=1)
    for _ in range(rounds):
        share = weights[b] * p
        share *= (n / share.sum(axis=1))[:, None]
        new = np.stack([np.bincount(b, share[:, j], len(weights)) for j in range(4)], axis=1)
        new += PRIOR
        new /= new.sum(axis=1, keepdims=True)
        done = np.abs(new - weights).max() < 1e-6
        weights = new
        if done:
            break
    return weights


def scores(docs: DataFrame, piece: int = PIECE, shard: int = SHARD) -> DataFrame:
    """(doc_id, n_words, log_probability, perplexity) for each row: natural logarithm of the text's probability, its end included, and exp of its negative mean."""
    docs = keyed(docs)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    growth = min(max((size / 50e9) ** 0.5, 1), GROWTH)
    shards = min(max(1, round(size / BYTES_A_GRAM / (shard * growth))), 1 << 24)
    # Pieces are written before anything refers to them: their numbers and contents are then the same for every reader, and for tasks that run again.
    pieces = written(docs.mapInArrow(_pieces(int(piece * growth)), PIECES).withColumn("piece", F.monotonically_increasing_id()), "pieces")
    totals = {r.held: (r.n, r.pieces) for r in pieces.groupBy("held").agg(F.sum("n_events").alias("n"), F.count("*").alias("pieces")).collect()}
    everything, train = sum(n for n, _ in totals.values()), totals.get(False, (0, 0))[0]
    n_pieces = sum(n for _, n in totals.values())
    asked = pieces.mapInArrow(_asked(shards), ASKED)
    answers = written(asked.repartitionById(shards, "shard").sortWithinPartitions("shard").mapInArrow(_answers, ANSWERED), "answers")
    vocabulary = answers.agg(F.sum("vocabulary")).first()[0] or 0

    def together(part_pieces: DataFrame, part_answers: DataFrame, words: str, grams: str) -> DataFrame:
        none = F.lit(None).cast("binary")
        a = part_pieces.select("piece", F.lit(-1).alias("shard"), "ids", "sizes", "sequence", "words", none.alias("w"), none.alias("g"))
        b = part_answers.select("piece", "shard", *(none.alias(c) for c in ("ids", "sizes", "sequence", "words")), F.col(words).alias("w"), F.col(grams).alias("g"))
        return a.union(b).repartition(max(1, min(n_pieces, 2 * shards)), "piece").sortWithinPartitions("piece", "shard")

    def counts(answers: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        joined = [np.concatenate([np.zeros(0, np.int64), *(unpacked(x[c]) for x in answers if x[c] is not None)]) for c in ("w", "g")]
        return joined[0], joined[1]

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, answers in _whole(batches):
            bucket, *p = Piece(row, shards).estimates(*counts(answers), train, own=False)
            with np.errstate(divide="ignore"):
                s3, s2, s1 = (np.where(x > 0, np.round(np.log(x) * STEP), ZERO).astype(np.int64) for x in p)
            code = ((bucket * 1024 + np.maximum(s3, -1000) % 1024) * 1024 + np.maximum(s2, -1000) % 1024) * 1024 + np.maximum(s1, -1000) % 1024
            keys, k = np.unique(code, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(k)], ["code", "n"])

    found = together(pieces.where("held"), answers.where("held"), "train_words", "train_grams").mapInArrow(histogram, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    weights = learned(_decoded(found.column("code").to_numpy(), found.column("n").to_numpy()), vocabulary)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, answers in _whole(batches):
            p = Piece(row, shards)
            bucket, p3, p2, p1 = p.estimates(*counts(answers), everything, own=True)
            w = weights[bucket]
            logs = np.log(w[:, 0] * p3 + w[:, 1] * p2 + w[:, 2] * p1 + w[:, 3] / (vocabulary + 1))
            sums = np.bincount(p.doc, logs, len(p.ids))
            none = p.sizes == 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(p.ids), pa.array(p.sizes), pa.array(np.round(sums, 6), mask=none), pa.array(np.round(np.exp(-sums / (p.sizes + 1)), 6), mask=none)], ["doc_id", "n_words", "log_probability", "perplexity"]
            )

    return together(pieces, answers, "words", "grams").mapInArrow(score, "doc_id long, n_words long, log_probability double, perplexity double")


def _decoded(code: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Rows (bucket, log p3, log p2, log p1, events), sorted."""
    order = np.argsort(code)
    code, n = code[order], n[order]
    steps = [(code >> s) & 1023 for s in (20, 10, 0)]
    logs = [np.where(x == -1000 % 1024, ZERO, np.where(x > 0, x - 1024, 0) / STEP) for x in steps]
    return np.stack([code >> 30, *logs, n], axis=1)
