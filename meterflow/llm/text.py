"""Vectorised word scanning over Arrow string columns, used inside Arrow batches.

A batch's text stays one byte buffer. Words are found, and hashed, with a handful of numpy passes
over it; Python objects are made only for the few words an operator reports.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once; a single longer text is one block of its own.
BLOCK = 1 << 20

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of unsigned 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_STEP = 0xD6E8FEB86659FD93
_powers = np.ones(1, _U)


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 256)
        p = np.full(size, _STEP, _U)
        p[0] = 1
        _powers = np.multiply.accumulate(p)
    return _powers


def alnum_table() -> np.ndarray:
    """Byte -> lower-cased byte for digits, letters and all bytes of non-ASCII characters; else 0."""
    t = np.zeros(256, np.uint8)
    t[0x30:0x3A] = np.arange(0x30, 0x3A)
    t[0x61:0x7B] = np.arange(0x61, 0x7B)
    t[0x41:0x5B] = np.arange(0x61, 0x7B)
    t[0x80:] = np.arange(0x80, 0x100)
    return t


def solid_table() -> np.ndarray:
    """Byte -> itself, but 0 for space and \\x09-\\x0D (and NUL): words are what stands between white space."""
    t = np.arange(256).astype(np.uint8)
    t[0x09:0x0E] = 0
    t[0x20] = 0
    return t


ALNUM, SOLID = alnum_table(), solid_table()


@dataclass
class Words:
    """Words of a block of texts. `first[i]:first[i + 1]` are the words of text i."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    @property
    def last(self) -> np.ndarray:
        """For every word, the index after the last word of its text."""
        return np.repeat(self.first[1:], np.diff(self.first))

    def word(self, i: int) -> str:
        return self.data[self.start[i] : self.end[i]].tobytes().decode("utf-8", "replace")


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; null is an empty text."""
    t = pc.fill_null(texts, "").cast(pa.large_binary())
    _, offsets, data = t.buffers()
    offs = np.frombuffer(offsets, np.int64)[t.offset : t.offset + len(t) + 1] if offsets is not None and len(t) else np.zeros(len(t) + 1, np.int64)
    return offs, np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)


def blocks(offs: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes, or of one text."""
    lo = 0
    while lo < len(offs) - 1:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def find_words(offs: np.ndarray, data: np.ndarray, table: np.ndarray = ALNUM, cuts: np.ndarray | None = None) -> Words:
    """Words of the texts `data[offs[i]:offs[i + 1]]`. `cuts`: further positions no word crosses."""
    base = int(offs[0])
    seg = table[data[base : int(offs[-1])]]
    rel = offs - base
    solid = seg != 0
    before = np.empty_like(solid)
    if len(solid):
        before[0] = False
        before[1:] = solid[:-1]
        inner = rel[(rel > 0) & (rel < len(solid))]
        before[inner] = False
    start = np.flatnonzero(solid & ~before)
    if len(start) == 0:
        return Words(seg, start, start.copy(), np.zeros(0, _U), np.zeros(len(offs), np.int64))
    # words end where no word goes on; the arrays over bytes are as narrow as they can be
    ends = np.empty_like(solid)
    ends[-1] = True
    ends[:-1] = ~solid[1:]
    ends[inner - 1] = True
    size = np.flatnonzero(solid & ends) + 1 - start
    at = np.cumsum(size) - size
    del before, ends
    off = np.arange(int(size.sum()), dtype=np.int32)
    off -= np.repeat(at.astype(np.int32), size)
    body = powers(int(size.max()))[off]
    del off
    body *= _BYTE[seg[solid]]
    h = np.add.reduceat(body, at)
    h = mix(h + size.astype(_U))
    return Words(seg, start, start + size, h, np.searchsorted(start, rel).astype(np.int64))


def grams(h: np.ndarray, last: np.ndarray, n: int, skip: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the n-grams (every `skip`-th word) that lie within one text."""
    span = (n - 1) * skip
    if len(h) <= span:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    m = len(h) - span
    g = h[:m] * _U(0x9E3779B97F4A7C15) + _U(n * 1000 + skip)
    for k in range(1, n):
        g = mix(g) + h[k * skip : k * skip + m] * _U(0x9E3779B97F4A7C15)
    at = np.flatnonzero(np.arange(m) + span < last[:m])
    return at, mix(g[at])


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of values[first[i]:first[i + 1]] for each i; empty ranges give 0."""
    total = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def unit(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit hashes as numbers in (0, 1)."""
    return ((x >> _U(11)).astype(np.float64) + 0.5) * 2.0**-53
