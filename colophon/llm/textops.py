"""Vectorised text kernels over Arrow string buffers.

Everything here works on whole Arrow batches with numpy: no Python loop runs per
word or per character. A batch is cut at document boundaries into pieces of about
``PIECE_BYTES``, or ``WORD_BYTES`` where words are hashed (temporary arrays have 8 bytes and more for each
byte of text), so that these stay in cache; a document longer than that is one piece of its own, never truncated.

Word hashes are 64-bit: a polynomial in an odd base modulo 2**64 followed by a
finalising mix. Two different words collide with probability about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES, WORD_BYTES = 1 << 20, 1 << 18
U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
GRAM_BASE = 0xD6E8FEB86659FD93 | 1
GRAM_INV = pow(GRAM_BASE, -1, 1 << 64)

_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_NOT_WORD = np.ones(256, bool)
_NOT_WORD[128:] = False
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    _NOT_WORD[_a:_b] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Powers:
    """Powers of a base modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.p = U(base), np.ones(1, U)

    def upto(self, n: int) -> np.ndarray:
        if len(self.p) < n:
            m = max(n, 2 * len(self.p), 4096)
            grown = np.full(m, self.base, U)
            grown[0] = 1
            self.p = np.multiply.accumulate(grown)
        return self.p[:n]


_P, _PI, _G, _GI = _Powers(BASE), _Powers(BASE_INV), _Powers(GRAM_BASE), _Powers(GRAM_INV)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def string_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty strings."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type)
    if not wide and not pa.types.is_string(col.type):
        col, wide = col.cast(pa.large_string()), True
    kind = np.int64 if wide else np.int32
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], kind)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0] : off[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


@dataclass
class Words:
    """The words of documents ``lo`` to ``hi`` of a batch. ``start`` and ``end`` are byte
    positions in ``data``, ``first`` has the number of each document's first word."""

    lo: int
    hi: int
    data: np.ndarray
    off: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.hi - self.lo), np.diff(self.first))

    @property
    def last(self) -> np.ndarray:
        """For each word, the number of the word after the last one of its document."""
        return np.repeat(self.first[1:], np.diff(self.first))


def pieces(off: np.ndarray, size: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, "right")) - 1)
        yield lo, hi
        lo = hi


def words_of(data: np.ndarray, off: np.ndarray, lo: int = 0, normal: bool = True) -> Words:
    """Words and hashes of the documents at ``off`` (starting at 0) in ``data``. With ``normal``
    a word is a run of ASCII letters and digits and non-ASCII characters, without regard to
    ASCII case; without it, a run without ASCII white space, as it stands."""
    n, k = len(data), len(off) - 1
    z = np.zeros(0, np.int64)
    if n == 0:
        return Words(lo, lo + k, data, off, z, z, np.zeros(0, U), np.zeros(k + 1, np.int64))
    inside = ~(_NOT_WORD if normal else _SPACES)[data]
    head = np.empty(n, bool)
    head[0] = True
    np.logical_not(inside[:-1], out=head[1:])
    head[off[:-1][off[:-1] < n]] = True
    head &= inside
    start = np.flatnonzero(head)
    if len(start) == 0:
        return Words(lo, lo + k, data, off, z, z, np.zeros(0, U), np.zeros(k + 1, np.int64))
    c = (_LOWER[data] if normal else data).astype(U)
    c += U(1)
    c *= inside
    c *= _P.upto(n)
    h = np.add.reduceat(c, start)
    h *= _PI.upto(n)[start]
    tail = np.empty(n, bool)
    tail[-1] = True
    np.logical_not(inside[1:], out=tail[:-1])
    tail[off[1:][off[1:] > 0] - 1] = True
    tail &= inside
    return Words(lo, lo + k, data, off, start, np.flatnonzero(tail) + 1, mix(h), np.searchsorted(start, off))


def each_words(col: pa.Array, normal: bool = True, size: int = WORD_BYTES) -> Iterator[Words]:
    """Words of a string column, piece by piece. Every document is whole within one piece."""
    data, off = string_buffers(col)
    for lo, hi in pieces(off, size):
        yield words_of(data[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], lo, normal)


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n successive entries of h (len(h) - n + 1 of them)."""
    if len(h) < n:
        return np.zeros(0, U)
    m = len(h)
    s = np.zeros(m + 1, U)
    np.cumsum((h | U(1)) * _G.upto(m), out=s[1:])
    return mix((s[n:] - s[:-n]) * _GI.upto(m)[: m - n + 1])


def grams_inside(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of the first word, hash) of each n-word run that lies within one document."""
    g = gram_hashes(w.hash, n)
    at = np.flatnonzero(w.last[: len(g)] >= np.arange(len(g)) + n)
    return at, g[at]


def hash_words(words: list[str], normal: bool = True) -> np.ndarray:
    """Hashes of single words, as words_of has them."""
    return np.array([(words_of(np.frombuffer(x.encode(), np.uint8), np.array([0, len(x.encode())]), 0, normal).hash.tolist() or [0])[0] for x in words], U)


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices start[0], start[0]+1, … for every run, one after another."""
    total = int(length.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ends = np.cumsum(length)
    return np.arange(total) + np.repeat(start - (ends - length), length)


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    off = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(values, type=kind))
