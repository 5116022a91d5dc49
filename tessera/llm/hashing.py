"""Vectorised hashing inside tasks: words, windows of words, windows of bytes.

A byte string is hashed as a polynomial over the ring of 64-bit integers, with a random value per
byte, from prefix sums; a bijective finaliser follows.  All hashes are functions of the content
alone, so any two tasks agree on them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np

#: Bytes that are hashed in one go; words longer than this are hashed by BLAKE2.
SLICE = 1 << 18

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (a bijection of 64-bit integers); returns a new array."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@cache
def _tables(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(20240229))
    per_byte = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    base = int(rng.integers(1 << 40, 1 << 62)) * 2 + 1
    inverse = pow(base, -1, 1 << 64)

    def powers(b: int) -> np.ndarray:
        out = np.ones(n, dtype=np.uint64)
        out[1:] = np.uint64(b)
        return np.multiply.accumulate(out)

    return per_byte, powers(base), powers(inverse)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base, and of its inverse."""
    _, up, down = _tables(1 << int(n + 1).bit_length())
    return up, down


class Prefix:
    """Prefix sums of one slice of bytes; ``window`` hashes equal-length strings, ``spans`` others."""

    def __init__(self, data: np.ndarray, room: int = SLICE + 1024):
        per_byte, up, self._down = _tables(max(room, 1 << int(len(data) + 1).bit_length()))
        self._sums = np.zeros(len(data) + 1, dtype=np.uint64)
        values = per_byte[data]
        values *= up[: len(data)]
        np.cumsum(values, out=self._sums[1:])

    def window(self, length: int) -> np.ndarray:
        out = self._sums[length:] - self._sums[:-length]
        out *= self._down[: len(out)]
        return mix(out)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = self._sums[ends] - self._sums[starts]
        out *= self._down[starts]
        return mix(out)


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` in an array of bytes."""
    gap = np.ones(len(data) + 2, dtype=bool)
    gap[1:-1] = IS_SPACE[data]
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    return edges[0::2], edges[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of non-overlapping ascending spans, in bounded memory."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        a = starts[i]
        j = int(np.searchsorted(ends, a + SLICE, side="right"))
        if j <= i:
            digest = hashlib.blake2b(data[a : ends[i]].tobytes(), digest_size=8).digest()
            out[i] = np.frombuffer(digest, dtype=np.uint64)[0]
            i += 1
            continue
        part = Prefix(data[a : ends[j - 1]])
        out[i:j] = part.spans(starts[i:j] - a, ends[i:j] - a)
        i = j
    return out


#: Factor and summand of the left hash.
JOIN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x632BE59BD9B4E019)


def join_hashes(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring strings from their hashes (order counts)."""
    return mix(left * JOIN[0] + right + JOIN[1])


def windows_of(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` items; empty where there are fewer."""
    if len(hashes) < length:
        return np.empty(0, dtype=np.uint64)
    out = hashes[: len(hashes) - length + 1].copy()
    for k in range(1, length):
        out = join_hashes(out, hashes[k : k + len(out)])
    return out


def sliding(op: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """``op`` (minimum or maximum) over ``values[i:i+width]`` for each full window, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = op(out[: len(out) - step], out[step:])
        have += step
    return out


def slices(n: int, size: int) -> Iterator[tuple[int, int]]:
    for a in range(0, n, size):
        yield a, min(a + size, n)
