"""Words and rolling hashes of many texts at once, in numpy.

All functions work on one byte buffer in which texts follow each other, each closed by a line
feed, so that no word spans two texts.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

U = np.uint64
_BASES = (0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93)
_WORD_BASES = (0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F)
#: Of the usual C library only.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)
#: Bytes that are hashed at once.
_PIECE = 1 << 14
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values; a bijection."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


STEP = 1 << 12
_ladders: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _ladder(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i for i under STEP, and base**(i * STEP) up to n at least, modulo 2**64.

    Only these short tables are kept by a worker; any power is a product of two entries.
    """
    if base not in _ladders or len(_ladders[base][1]) * STEP < n:
        rungs = []
        for b, size in ((base, STEP), (pow(base, STEP, 1 << 64), 1 << (n // STEP).bit_length())):
            a = np.full(size, b, U)
            a[0] = 1
            rungs.append(np.multiply.accumulate(a))
        _ladders[base] = (rungs[0], rungs[1])
    return _ladders[base]


def powers(base: int, n: int) -> np.ndarray:
    """base**i modulo 2**64 for i under n."""
    low, high = _ladder(base, n)
    return np.multiply.outer(high[: -(-n // STEP)], low).ravel()[:n]


def inverse_powers(base: int, at: np.ndarray) -> np.ndarray:
    """base**-i modulo 2**64 for each i of `at`."""
    low, high = _ladder(pow(base, -1, 1 << 64), int(at.max(initial=0)) + 1)
    return low[at % STEP] * high[at // STEP]


def give_back() -> None:
    """Hands memory that this worker has freed back to the machine, which its neighbours share."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[starts[i]:ends[i]], equal for equal contents."""
    sums = np.zeros(len(values) + 1, U)
    np.cumsum((values + U(1)) * powers(base, len(values)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse_powers(base, starts)
    return mix(h + (ends - starts).astype(U) * U(0xFF51AFD7ED558CCD))


class Texts:
    """Byte buffer of many texts; text i is buf[offs[i] : offs[i + 1] - 1]."""

    def __init__(self, texts: Iterable[bytes | None]):
        parts = [t or b"" for t in texts]
        self.n = len(parts)
        self.buf = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8) if parts else np.zeros(0, np.uint8)
        self.offs = np.zeros(self.n + 1, np.int64)
        np.cumsum([len(p) + 1 for p in parts], out=self.offs[1:])

    def lower(self) -> Texts:
        """A-Z in lower case."""
        upper = (self.buf >= 65) & (self.buf <= 90)
        self.buf = np.where(upper, self.buf + np.uint8(32), self.buf)
        return self

    def find_words(self) -> Texts:
        """Words between ASCII white space: byte ranges, and the first word of each text."""
        space = np.concatenate(([True], _SPACE[self.buf]))
        edge = np.flatnonzero(space[1:] != space[:-1])
        self.starts, self.ends = edge[::2], edge[1::2]
        self.first = np.searchsorted(self.starts, self.offs)
        return self

    def word_hashes(self, which: int = 0) -> np.ndarray:
        """Sum of well mixed (byte, place) values of each word: a polynomial modulo 2**64 would not
        tell some words of a thousand letters apart, whatever its base."""
        if not len(self.starts):
            return np.zeros(0, U)
        spread = np.arange(len(self.buf), dtype=U)
        spread -= np.repeat(
            np.concatenate(([0], self.starts)).astype(U), np.diff(np.concatenate(([0], self.starts, [len(spread)])))
        )
        for i in range(0, len(spread), _PIECE):  # pieces stay in the cache
            part = spread[i : i + _PIECE]
            part *= U(_WORD_BASES[which])
            part += (self.buf[i : i + _PIECE].astype(U) + U(1)) * U(_BASES[which])
            part[:] = mix(part)
        edges = np.stack([self.starts, self.ends], axis=1).ravel()
        sums = np.add.reduceat(spread, edges)[::2]
        return mix(sums + (self.ends - self.starts).astype(U) * U(0xFF51AFD7ED558CCD))

    def word_doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), np.diff(self.first))


def sampled(n: int, most: int, *columns: str) -> Column:
    """Condition that about `most` of `n` rows meet, by a hash of the columns; all if there are no more."""
    if n <= most:
        return F.lit(True)
    return F.xxhash64(*columns) < F.lit((most << 64) // n - (1 << 63))


def ngrams(h: np.ndarray, first: np.ndarray, k: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Start index and hash of each run of k words that lies within one text."""
    if len(h) < k:
        return np.zeros(0, np.int64), np.zeros(0, U)
    last = np.repeat(first[1:], np.diff(first))  # of each word's text
    at = np.flatnonzero(np.arange(len(h)) + k <= last)
    return at, spans_hash(h, at, at + k, _WORD_BASES[which])


def runs_hash(h: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hash of each run of words h[starts[i]:ends[i]]."""
    return spans_hash(h, starts, ends, _WORD_BASES[which])


def runs_digest(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A second hash of each run of words, unlike `runs_hash`: a sum of mixed (word, place) values."""
    out = np.zeros(len(starts), U)
    size = ends - starts
    for j in range(int(size.max(initial=0))):
        live = np.flatnonzero(size > j)
        out[live] += mix(h[starts[live] + j] + U(j * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    return mix(out + size.astype(U))


def window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least value of each w consecutive ones."""
    have = 1
    while have * 2 <= w:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (w - have)], x[w - have :]) if have < w else x


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mask of the positions that lie in any of the ranges."""
    d = np.zeros(n + 1, np.int32)
    np.add.at(d, starts, 1)
    np.add.at(d, ends, -1)
    return np.cumsum(d[:-1]) > 0
