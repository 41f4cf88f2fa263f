"""Fingerprints of many spans of a byte buffer at once, with numpy.

A prefix sum of byte values times powers of an odd base, all modulo 2^64, gives
the fingerprint of any span by one subtraction and one multiplication with the
inverse power. A finishing mix spreads it over all bits.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MASK = (1 << 64) - 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_values = {s: mixed for s in (0, 1) for mixed in [np.random.default_rng(s).integers(1, 1 << 63, 256, dtype=np.uint64)]}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    up, down = _powers.get(seed, (None, None))
    if up is None or len(up) < n:
        size = max(n, 1 << 20)
        base = BASES[seed]
        up, down = np.full(size, base, U), np.full(size, pow(base, -1, 1 << 64), U)
        up[0] = down[0] = 1
        up, down = np.cumprod(up, dtype=U), np.cumprod(down, dtype=U)
        if size <= 1 << 22:
            _powers[seed] = up, down
    return up, down


class Spans:
    """Fingerprints of spans [start, stop) of data, a uint8 array."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        up, self.down = powers(seed, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, U)
        np.cumsum(_values[seed][data] * up[: len(data)], out=self.sums[1:])

    def plain(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.sums[stop] - self.sums[start]) * self.down[start]

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mix(self.plain(start, stop) + (stop - start).astype(U))


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased (A-Z) buffer of all texts, starts and stops of the words
    [^\\x20\\x09-\\x0D]+ in it, and for each text the index of its first word, then the end."""
    data = LOWER[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
    edges = np.diff(np.concatenate(([True], SPACE[data], [True])).astype(np.int8))
    starts, stops = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    begin = np.cumsum([0] + [len(t) + 1 for t in texts])
    return data, starts, stops, np.searchsorted(starts, begin)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit fingerprint of each word, and the word index at which each text begins."""
    data, starts, stops, first = words(texts)
    return Spans(data)(starts, stops), first
