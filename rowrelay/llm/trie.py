"""Self-join of 64-bit keys within a Hamming distance, by a binary trie in one task."""

from __future__ import annotations

import numpy as np

#: A node pair with at most so many key pairs is a leaf: its pairs are compared.
LEAF = 256
#: Node pairs, and key pairs, that are held in memory at once.
HELD = 1 << 18


class Forest:
    """Sets of positions, merged pairwise; the root of a set is its smallest position."""

    def __init__(self, size: int):
        self.up = np.arange(size, dtype=np.int64)

    def roots(self, at: np.ndarray) -> np.ndarray:
        while True:
            above = self.up[at]
            if np.array_equal(above, at):
                return at
            self.up[at] = self.up[above]
            at = self.up[at]

    def merge(self, i: np.ndarray, j: np.ndarray) -> None:
        while i.size:
            i, j = self.roots(i), self.roots(j)
            apart = i != j
            i, j = i[apart], j[apart]
            np.minimum.at(self.up, np.maximum(i, j), np.minimum(i, j))


def _pairs(lo1, hi1, lo2, hi2):
    """All (i, j) of each pair of ranges, in chunks; a range with itself gives i < j."""
    counts = (hi1 - lo1) * (hi2 - lo2)
    start = 0
    ends = np.cumsum(counts)
    while start < counts.size:
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + 4 * HELD, "right")))
        n = counts[start:stop]
        which = np.repeat(np.arange(start, stop), n)
        at = np.arange(which.size) - np.repeat(np.cumsum(n) - n, n)
        wide = (hi2 - lo2)[which]
        i, j = lo1[which] + at // wide, lo2[which] + at % wide
        own = lo1[which] == lo2[which]
        keep = ~own | (i < j)
        yield i[keep], j[keep]
        start = stop


def link(keys: np.ndarray, same_bits: int, budget: int, sides: np.ndarray | None = None) -> np.ndarray:
    """The root position of each key, where keys within the budget share a root.

    ``keys`` are sorted and unique; only keys that agree in the first ``same_bits``
    bits are compared. The binary trie over the keys is kept as ranges of the sorted
    array. Pairs of nodes go down together, one bit a level: a pair of children with
    different bits adds one to the errors, and a pair beyond the budget is dropped.
    Small pairs of nodes are compared key by key. With ``sides`` (0 or 1 for each key)
    only keys of different sides are compared.
    """
    forest = Forest(keys.size)
    if keys.size < 2:
        return forest.up
    heads = keys >> np.uint64(64 - same_bits) if same_bits else np.zeros_like(keys)
    first = np.flatnonzero(np.r_[True, heads[1:] != heads[:-1]])
    last = np.r_[first[1:], keys.size]
    many = last - first > 1
    lo, hi = first[many], last[many]
    stack = [(lo, hi, lo, hi, np.zeros(lo.size, np.int8), same_bits)]
    while stack:
        lo1, hi1, lo2, hi2, errors, depth = stack.pop()
        if lo1.size > HELD:
            stack.append((lo1[HELD:], hi1[HELD:], lo2[HELD:], hi2[HELD:], errors[HELD:], depth))
            lo1, hi1, lo2, hi2, errors = lo1[:HELD], hi1[:HELD], lo2[:HELD], hi2[:HELD], errors[:HELD]
        small = ((hi1 - lo1) * (hi2 - lo2) <= LEAF) | (depth == 64)
        for i, j in _pairs(lo1[small], hi1[small], lo2[small], hi2[small]):
            near = np.bitwise_count(keys[i] ^ keys[j]) <= budget
            if sides is not None:
                near &= sides[i] != sides[j]
            forest.merge(i[near], j[near])
        if small.all():
            continue
        lo1, hi1, lo2, hi2, errors = (x[~small] for x in (lo1, hi1, lo2, hi2, errors))
        shift = np.uint64(63 - depth)
        mid1 = np.clip(np.searchsorted(keys, (keys[lo1] >> shift | np.uint64(1)) << shift), lo1, hi1)
        mid2 = np.clip(np.searchsorted(keys, (keys[lo2] >> shift | np.uint64(1)) << shift), lo2, hi2)
        other = lo1 != lo2
        children = [
            (lo1, mid1, lo2, mid2, errors, None),
            (mid1, hi1, mid2, hi2, errors, None),
            (lo1, mid1, mid2, hi2, errors + 1, None),
            (mid1, hi1, lo2, mid2, errors + 1, other),
        ]
        parts = []
        for l1, h1, l2, h2, e, only in children:
            keep = (h1 > l1) & (h2 > l2) & (e <= budget) & ((l1 != l2) | (h1 - l1 > 1))
            if only is not None:
                keep &= only
            parts.append((l1[keep], h1[keep], l2[keep], h2[keep], e[keep]))
        joined = tuple(np.concatenate(x) for x in zip(*parts, strict=True))
        if joined[0].size:
            stack.append((*joined, depth + 1))
    return forest.roots(forest.up.copy())
