"""Prefix polynomial hashes modulo 2**64: the hash of any run of bytes from two of them."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


@lru_cache(maxsize=2)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """2 ** bits powers of the odd factor, and their inverses."""
    inverse = np.uint64(pow(int(FACTOR), -1, 2**64))
    up, down = np.full(1 << bits, FACTOR), np.full(1 << bits, inverse)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads a polynomial hash, whose low bits are weak, over all bits."""
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


class Prefixes:
    """Hashes of runs of ``data`` (bytes as uint8), equal for equal runs wherever they start."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(max(16, len(data).bit_length()))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def run(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def all_runs(self, size: int) -> np.ndarray:
        """Hashes of the runs of ``size`` bytes at every start."""
        n = len(self.sums) - size
        return (self.sums[size:] - self.sums[:n]) * self.down[:n]
