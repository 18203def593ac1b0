"""A bidirectional FM-index over word codes, for patterns up to a stated depth, in numpy.

Suffixes are sorted by their first `depth` codes only. Backward search over such a Burrows-Wheeler transform is exact
for patterns of up to `depth` codes, as it compares suffixes by no more than those. The text is read as a ring; code 0
stands between pieces and is in no pattern.
"""

from __future__ import annotations

import numpy as np


def _ranks(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place: the number of smaller different keys."""
    ordered = keys[order]
    out = np.empty(keys.size, dtype=np.int64)
    out[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
    return out


def depth_order(text: np.ndarray, depth: int) -> np.ndarray:
    """The places of a ring of codes, sorted by the first `depth` codes read from each; equals in any order."""
    key, known = text, 1
    order = np.argsort(key)
    while known < depth:
        rank, step = _ranks(key, order), min(known, depth - known)
        key = rank * text.size + np.roll(rank, -step)
        order, known = np.argsort(key), known + step
    return order


class Half:
    """One direction: the transform, and for each code the places where it stands in it."""

    def __init__(self, text: np.ndarray, depth: int):
        order = depth_order(text, depth)
        self.n, self.order = text.size, order
        self.bwt = text[order - 1]
        self.stands = np.sort(self.bwt * self.n + np.arange(self.n))

    def back(self, code: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Where the suffixes begin that have `code` before a suffix from `place` on: one step of backward search."""
        return np.searchsorted(self.stands, code * self.n + place)

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first place, number) of the suffixes that begin with each row of a matrix of codes."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), self.n, dtype=np.int64)
        for column in patterns.T[::-1]:
            low, high = self.back(column, low), self.back(column, high)
        return low, high - low

    def before(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """The codes that stand before the suffixes of each interval.

        Returns (interval, code, number, smaller) for each different code but 0; smaller: how many codes of the
        interval are less. The intervals do not overlap and ascend.
        """
        owner = np.repeat(np.arange(low.size), size)
        first = np.cumsum(size) - size
        place = np.arange(owner.size) + np.repeat(low - first, size)
        span = int(self.bwt.max()) + 1
        keys = np.sort(owner * span + self.bwt[place])
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if keys.size else np.zeros(0, np.int64)
        interval, code = keys[new] // span, keys[new] % span
        number = np.diff(np.append(new, keys.size))
        word = code > 0
        return interval[word], code[word], number[word], (new - first[interval])[word]


class Index:
    """The index of a text and of its reverse, whose intervals are moved together."""

    def __init__(self, text: np.ndarray, depth: int):
        self.forward, self.backward = Half(text, depth), Half(text[::-1], depth)

    def extend(self, patterns: np.ndarray) -> tuple[np.ndarray, ...]:
        """Phrases of which both ends, without the last and without the first word, are among the patterns.

        patterns: rows of equally many codes, each once. Every pattern's interval is extended to the left through the
        transform of the text and to the right through that of its reverse; a phrase that both ways reach has the same
        interval in both. Returns (prefix, suffix, number, place): rows of patterns, occurrences, and the place in the
        text of one of them.
        """
        low, size = self.forward.search(patterns)
        other, _ = self.backward.search(patterns[:, ::-1])
        sorted_low, sorted_other = np.argsort(low), np.argsort(other)
        suffix, code, number, _ = self.forward.before(low[sorted_low], size[sorted_low])
        suffix = sorted_low[suffix]
        left = self.forward.back(code, low[suffix])
        prefix, _, _, smaller = self.backward.before(other[sorted_other], size[sorted_other])
        prefix = sorted_other[prefix]
        right = low[prefix] + smaller
        by_left, by_right = np.argsort(left), np.argsort(right)
        if not left.size or not right.size:
            none = np.zeros(0, dtype=np.int64)
            return none, none, none, none
        found = np.minimum(np.searchsorted(right[by_right], left[by_left]), right.size - 1)
        same = right[by_right][found] == left[by_left]
        a, b = by_left[same], by_right[found[same]]
        return prefix[b], suffix[a], number[a], self.forward.order[left[a]]
