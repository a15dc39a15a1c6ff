"""Mergesort of suffixes that compares by hash.

The common extension of two suffixes is found by binary search over prefix
hashes, so a comparison takes a logarithm of its length. Many comparisons are
made at once: all runs of all buckets are merged side by side.
"""

from __future__ import annotations

import numpy as np

from seriesloom.llm.polyhash import Prefixes

# Pairs whose bytes are compared at once.
VERIFIED = 1 << 14


class Suffixes:
    """Suffixes of ``data`` cut at ``size`` bytes, each of which must be there."""

    def __init__(self, data: np.ndarray, size: int):
        self.data, self.size = data, size
        self.prefixes = Prefixes(data)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes at ``a`` and ``b``, up to ``size``."""
        low = np.zeros(len(a), np.int64)
        high = np.full(len(a), self.size, np.int64)
        for _ in range(int(self.size).bit_length()):
            middle = (low + high + 1) // 2
            same = self.prefixes.run(a, a + middle) == self.prefixes.run(b, b + middle)
            low = np.where(same, middle, low)
            high = np.where(same, high, middle - 1)
        return low

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether each suffix at ``a`` comes before that at ``b``; ``or_equal`` for the equal ones."""
        shared = self.extension(a, b)
        equal = shared >= self.size
        at = np.where(equal, 0, shared)
        return np.where(equal, or_equal, self.data[a + at] < self.data[b + at])

    def sorted_within(self, starts: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """``starts`` with each bucket, a run of equal ``bucket``, sorted."""
        n = len(starts)
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        sizes = np.diff(np.concatenate([first, [n]]))
        base = np.repeat(first, sizes)
        end = np.repeat(first + sizes, sizes)
        place = np.arange(n)
        run = 1
        while n and run < sizes.max():
            pair = base + (place - base) // (2 * run) * (2 * run)
            middle, last = np.minimum(pair + run, end), np.minimum(pair + 2 * run, end)
            left = place < middle
            # where each element would stand in the other run of its pair
            low, high = np.where(left, middle, pair), np.where(left, last, middle)
            start_low = low.copy()
            todo = np.flatnonzero(low < high)
            while len(todo):
                probe = (low[todo] + high[todo]) // 2
                # equal suffixes keep the order of their runs
                before = self.less(starts[probe], starts[todo], ~left[todo])
                low[todo] = np.where(before, probe + 1, low[todo])
                high[todo] = np.where(before, high[todo], probe)
                todo = todo[low[todo] < high[todo]]
            own = np.where(left, place - pair, place - middle)
            target = pair + own + (low - start_low)
            merged = np.empty_like(starts)
            merged[target] = starts
            starts = merged
            run *= 2
        return starts

    def repeated(self, starts: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """The starts whose ``size`` bytes occur at another start of the same bucket."""
        order = np.argsort(bucket, kind="stable")
        starts, bucket = starts[order], bucket[order]
        several = np.zeros(len(starts), bool)
        same = bucket[1:] == bucket[:-1]
        several[1:] |= same
        several[:-1] |= same
        starts, bucket = self.sorted_within(starts[several], bucket[several]), bucket[several]
        a, b = starts[:-1], starts[1:]
        near = np.flatnonzero((bucket[1:] == bucket[:-1]) & (self.extension(a, b) >= self.size))
        collided = [near[:0]]
        for at in range(0, len(near), VERIFIED):
            part = near[at : at + VERIFIED]
            span = np.arange(self.size)
            differ = (self.data[a[part, None] + span] != self.data[b[part, None] + span]).any(axis=1)
            collided.append(part[differ])
        wrong = np.unique(bucket[np.concatenate(collided)])
        good = near[~np.isin(bucket[near], wrong)]
        found = [a[good], b[good]]
        for name in wrong:  # hashes collided: the bucket is compared byte by byte
            there = starts[bucket == name]
            texts = [self.data[s : s + self.size].tobytes() for s in there]
            found.append(there[[texts.count(t) > 1 for t in texts]])
        return np.unique(np.concatenate(found))
