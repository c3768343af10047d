"""Hashes of ranges of a sequence, in numpy.

A range is a polynomial of its elements modulo the prime 2^31 - 1, at two points, together 62 bits. Over a prime field two unequal
ranges of n elements agree at a point for less than n of its 2^31 values, whatever the ranges; modulo a power of two some would
agree at every odd point.
"""

from __future__ import annotations

import functools

import numpy as np

PRIME = np.uint64((1 << 31) - 1)
_rng = np.random.default_rng(20240607)
#: A random number for each byte.
BYTE_VALUE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
POINTS = tuple(int(x) for x in _rng.integers(1 << 20, (1 << 31) - 2, 2))
#: Powers up to here are kept by a process; longer sequences make theirs anew.
KEPT = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def modulo(x: np.ndarray) -> np.ndarray:
    """x below 2^62 modulo PRIME, where PRIME itself may stand for 0."""
    x = (x & PRIME) + (x >> np.uint64(31))
    return (x & PRIME) + (x >> np.uint64(31))


def powers(n: int, base: int) -> np.ndarray:
    return _kept(base)[:n] if n <= KEPT else _powers(n, base)


@functools.lru_cache(8)
def _kept(base: int) -> np.ndarray:
    return _powers(KEPT, base)


def _powers(n: int, base: int) -> np.ndarray:
    out, done, step = np.ones(n, np.uint32), 1, base
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = modulo(out[:more] * np.uint64(step))
        done, step = done + more, step * step % int(PRIME)
    return out


class Rolling:
    """Hashes of the ranges of a sequence, given as a 64-bit number for each element."""

    def __init__(self, elements: np.ndarray):
        self.sums, self.undo = [], []
        for point, value in zip(POINTS, (elements & PRIME, elements >> np.uint64(33)), strict=True):
            terms = value * powers(len(value), point)
            self.sums.append(np.concatenate((np.zeros(1, np.uint64), np.cumsum(modulo(terms)))))
            self.undo.append(powers(len(value) + 1, pow(point, -1, int(PRIME))))

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """A hash of elements a to b, without b, for arrays of places."""
        parts = []
        for sums, undo in zip(self.sums, self.undo, strict=True):
            part = modulo(modulo(sums[b] - sums[a]) * undo[a])
            parts.append(np.where(part == PRIME, np.uint64(0), part))
        return mix((parts[0] << np.uint64(31) | parts[1]) + np.uint64(7))
