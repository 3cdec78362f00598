"""Longest common extensions by a difference cover: how far two places of a sequence agree.

Only the suffixes at sampled places are sorted. Of any two places some shift below the
cover's modulus makes both sampled, so a query compares those few words directly and
then takes a range minimum over the sorted sample's common prefixes.
"""

from __future__ import annotations

import numpy as np

#: A difference cover: every number modulo V is the difference of two members of COVER.
V, COVER = 13, (0, 1, 3, 9)
_SHIFT = np.array([[min(d for d in range(V) if (i + d) % V in COVER and (j + d) % V in COVER) for j in range(V)] for i in range(V)])


class Extensions:
    """Common extensions to the right in ``words``, an array of non-negative numbers.

    The last word must occur once, and so must a word between any two texts in it: no
    extension passes such a word. Memory is a few numbers a word, times the logarithm of
    the sample for the range minima. The sample is sorted when a query first needs it.
    """

    def __init__(self, words: np.ndarray):
        self.size = words.size
        self.words = np.append(words.astype(np.int64), np.full(2 * V, -1))
        self._ready = False

    def _sort(self) -> None:
        """Rank the sampled suffixes by prefix doubling over blocks of V words, and take their common prefixes."""
        places = [np.arange(r, self.size, V) for r in COVER]
        ends = np.cumsum([p.size for p in places])
        at = np.concatenate(places)
        self.order_of = np.full(self.size + V, -1)
        self.order_of[at] = np.arange(at.size)  # a block's number; the next block of its class has the next one
        stop = np.repeat(ends, [p.size for p in places])
        bits = max(1, int(self.words.max() + 2).bit_length())
        per = max(1, 62 // bits)
        keys = []
        for a in range(0, V, per):
            key = np.zeros(at.size, np.int64)
            for i in range(a, min(a + per, V)):
                key = (key << bits) | (self.words[at + i] + 1)
            keys.append(key)
        levels = [_ranked(keys[::-1])]
        number = np.arange(at.size)
        while levels[-1].max(initial=-1) + 1 < at.size:
            ahead = number + (1 << (len(levels) - 1))
            onward = np.where(ahead < stop, levels[-1][np.minimum(ahead, at.size - 1)], -1)
            levels.append(_ranked([onward, levels[-1]]))
        rank = levels[-1]
        by_rank = np.empty_like(rank)
        by_rank[rank] = number
        a, b = by_rank[:-1].copy(), by_rank[1:].copy()
        same = np.zeros(a.size, np.int64)
        for k in range(len(levels) - 2, -1, -1):
            inside = (a < stop[by_rank[:-1]]) & (b < stop[by_rank[1:]])
            agree = inside & (levels[k][np.minimum(a, at.size - 1)] == levels[k][np.minimum(b, at.size - 1)])
            step = agree * (1 << k)
            a, b, same = a + step, b + step, same + step * V
        same += self._directly(at[by_rank[:-1]] + same, at[by_rank[1:]] + same, np.full(a.size, V))
        self.rank, self.lows = rank, [same]
        while 2 << (len(self.lows) - 1) <= same.size:
            last, half = self.lows[-1], 1 << (len(self.lows) - 1)
            self.lows.append(np.minimum(last[:-half], last[half:]))
        self._ready = True

    def _directly(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words that agree from i and j on, at most ``most`` of them, below 2 * V."""
        found = np.zeros(i.size, np.int64)
        open_ = np.flatnonzero(most > 0)
        step = 0
        while open_.size:
            agree = self.words[np.minimum(i[open_] + step, self.size)] == self.words[np.minimum(j[open_] + step, self.size)]
            open_ = open_[agree]
            found[open_] += 1
            step += 1
            open_ = open_[most[open_] > step]
        return found

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words agree from places i and j on; i and j differ and lie inside."""
        shift = _SHIFT[i % V, j % V]
        found = self._directly(i, j, shift)
        far = np.flatnonzero(found == shift)
        if far.size:
            if not self._ready:
                self._sort()
            x, y = i[far] + shift[far], j[far] + shift[far]
            inside = (x < self.size) & (y < self.size)
            far, x, y = far[inside], x[inside], y[inside]
            a, b = self.rank[self.order_of[x]], self.rank[self.order_of[y]]
            low, high = np.minimum(a, b), np.maximum(a, b)
            level = np.frexp(high - low)[1] - 1  # the largest power of two that fits
            found[far] += self._least(low, high, level)
        return found

    def _least(self, low: np.ndarray, high: np.ndarray, level: np.ndarray) -> np.ndarray:
        out = np.empty(low.size, np.int64)
        for k in np.unique(level):
            own = np.flatnonzero(level == k)
            table = self.lows[k]
            out[own] = np.minimum(table[low[own]], table[high[own] - (1 << int(k))])
        return out


def _ranked(keys: list[np.ndarray]) -> np.ndarray:
    """The dense rank of each row; the last key counts first."""
    order = np.lexsort(keys)
    new = np.zeros(order.size, bool)
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    rank = np.empty(order.size, np.int64)
    rank[order] = np.cumsum(new)
    return rank
