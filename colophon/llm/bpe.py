"""BPE encoding and decoding with forced boundaries.

A pair of bytes that stands inside no token of the vocabulary can never be merged across: between the two is a
certain cut. Texts are cut at all such places (found for a whole batch by one table look-up a byte), the fragments are encoded independently, each distinct one once,
and their ids concatenated. Most fragments are words, so nearly all come from the table of those seen before.

The rank files also go with a pattern that splits a text before any merging, and the cuts must not change what the pattern
sees. So a text is not cut after white space, inside a character, or before an apostrophe that doesn't follow
an ASCII letter or digit. With that the ids equal those of encoding whole texts.

The vocabulary is a rank file (base64 token and rank on each line), read once on the driver and sent to the workers; its
size is that of the file. Null texts count as empty, and empty texts have no ids. Rows without doc_id are left out; rows that
repeat one are encoded one by one. An empty table gives an empty result. Strings that look like special tokens are ordinary text.
Columns besides doc_id and text don't matter.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import tiktoken
from pyspark.sql import DataFrame

from . import textops as T
from .common import keyed

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TABLE = 1_000_000  # distinct fragments remembered by a worker before it starts afresh


def read_ranks(raw: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}


def forced_cuts(tokens) -> np.ndarray:
    """cut[a, b]: bytes a, b never stand side by side inside a token."""
    inside = np.zeros((256, 256), bool)
    for t in tokens:
        if len(t) > 1:
            x = np.frombuffer(t, np.uint8)
            inside[x[:-1], x[1:]] = True
    return ~inside


def _space_ends(data: np.ndarray) -> np.ndarray:
    """Where a white-space character may end (some other characters of those blocks count as well: there is merely no cut)."""
    end = (data <= 32) | (data == 127)
    before, first = np.r_[np.uint8(0), data[:-1]], np.r_[np.uint8(0), np.uint8(0), data[:-2]]
    end |= (before == 0xC2) & ((data == 0x85) | (data == 0xA0))
    return end | ((first == 0xE1) & (before == 0x9A)) | ((first == 0xE2) & ((before == 0x80) | (before == 0x81))) | ((first == 0xE3) & (before == 0x80))


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.codec = tiktoken.Encoding("forced-boundary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        allowed = forced_cuts(ranks)
        alnum = np.zeros(256, bool)
        for a, b in ((48, 58), (65, 91), (97, 123)):
            alnum[a:b] = True
        allowed[~alnum, ord("'")] = False
        allowed[:, 0x80:0xC0] = False
        self.cut = np.ascontiguousarray(allowed.ravel())
        size = max(ranks.values()) + 1
        by_id = [b""] * size
        for t, i in ranks.items():
            by_id[i] = t
        self.token_bytes = np.frombuffer(b"".join(by_id), np.uint8)
        self.token_size = np.array([len(t) for t in by_id])
        self.token_start = np.cumsum(self.token_size) - self.token_size
        self.start_afresh()

    def start_afresh(self) -> None:
        self.table: dict[bytes, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.begin, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)

    def _add(self, fragment: bytes) -> int:
        ids = self.codec.encode_ordinary(fragment.decode())
        k = len(self.table)
        if k == len(self.begin):
            self.begin, self.count = np.resize(self.begin, 2 * k), np.resize(self.count, 2 * k)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.resize(self.flat, 2 * len(self.flat))
        self.begin[k], self.count[k] = self.used, len(ids)
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.table[fragment] = k
        return k

    def fragments(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Where fragments begin in data, and its length at the end; texts are at off and are cut from one another."""
        cut = self.cut[(data[:-1].astype(np.uint16) << 8) | data[1:]] & ~_space_ends(data)[:-1]
        at = np.flatnonzero(cut) + 1
        return np.union1d(at, np.r_[off, len(data)])

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, number of ids of each text)."""
        if len(data) == 0:
            return np.zeros(0, np.int32), np.zeros(len(off) - 1, np.int64)
        at = self.fragments(data, off)
        if len(self.table) > TABLE:
            self.start_afresh()
        raw, table, add = data.tobytes(), self.table, self._add
        edges = at.tolist()
        which = np.fromiter((table[f] if f in table else add(f) for f in map(raw.__getitem__, map(slice, edges, edges[1:]))), np.int64, len(edges) - 1)
        n = self.count[which].astype(np.int64)
        ids = self.flat[T.ragged(self.begin[which], n)]
        ends = np.r_[0, np.cumsum(n)]
        return ids, np.diff(ends[np.searchsorted(at, off)])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts, offsets)."""
        n = self.token_size[ids]
        data = self.token_bytes[T.ragged(self.token_start[ids], n)]
        ends = np.r_[0, np.cumsum(n)]
        return data, ends[np.r_[0, np.cumsum(counts)]]


@lru_cache(2)
def _encoder(raw: bytes, pattern: str) -> Encoder:
    return Encoder(read_ranks(raw), pattern)


def encoded(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(doc_id, n_tokens, token_ids, round_trip) for each row: whether the ids decode to the text, byte for byte."""
    raw = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(raw.value, pattern)
        for b in batches:
            data, off = T.string_buffers(b.column(1))
            for lo, hi in T.pieces(off):
                part, at = data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
                ids, n = encoder.encode(part, at)
                back, back_at = encoder.decode(ids, n)
                same = np.diff(at) == np.diff(back_at)
                if len(back) == len(part):
                    wrong = np.r_[0, np.cumsum(back != part)]
                    same &= wrong[at[1:]] == wrong[at[:-1]]
                else:
                    same &= np.array([np.array_equal(back[x:y], part[p:q]) for x, y, p, q in zip(back_at, back_at[1:], at, at[1:])])
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], pa.array(n.astype(np.int32)), T.list_array(ids, n, pa.int32()), pa.array(same)], ["doc_id", "n_tokens", "token_ids", "round_trip"])

    return keyed(docs).mapInArrow(run, "doc_id long, n_tokens int, token_ids array<int>, round_trip boolean")


def decoded(tokens: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, text) of (doc_id, token_ids); bytes that are no UTF-8 become replacement characters; a null list is an empty text."""
    raw = tokens.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(raw.value, PATTERN)
        for b in batches:
            n = np.array([0 if x is None else x for x in pa.compute.list_value_length(b.column(1)).to_pylist()], np.int64)
            data, at = encoder.decode(b.column(1).flatten().to_numpy(), n)
            flat = data.tobytes()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([flat[x:y].decode(errors="replace") for x, y in zip(at.tolist(), at[1:].tolist())], pa.string())], ["doc_id", "text"])

    return tokens.select("doc_id", "token_ids").mapInArrow(run, "doc_id long, text string")
