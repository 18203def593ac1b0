"""Repetition rules on texts by a suffix array of their words.

The suffixes of all words are sorted by prefix doubling; the longest common prefixes of neighbours (LCP) give the
maximal repeated substrings: position p begins one of length max(LCP to either neighbour). The spans of all repeats
of at least LEAST_REPEAT words are united, and the covered share and the longest repeat are limited.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from wattmirror.llm.common import map_texts

BASE_WINDOW = 5                # words; fixed by the contract
BASE_LEAST_WORDS, BASE_PERCENT = 10, 20
LEAST_REPEAT = 12              # words of a repeat that counts for the method's verdict
MOST_COVERED = 0.15            # share of words that such repeats may cover
MOST_LONGEST, MOST_LONGEST_SHARE = 100, 0.05   # words, and share of words, of the longest repeat
SYMBOLS, SPACES = b"#*$%&|<>", (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")


def repeats(ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each word: the length of the longest substring that begins there and begins elsewhere in its text, too.

    ids: word codes of several texts in a row, owner: the text of each word, ascending. Substrings do not cross
    texts. Suffixes are sorted by prefix doubling; each round sorts again only those that still share a prefix, and
    keeps the classes of equal prefixes, from which the LCP of neighbours follows digit by digit.
    """
    n = ids.size
    longest = np.zeros(n, dtype=np.int64)
    if n < 2:
        return longest
    left = np.searchsorted(owner, owner, side="right") - np.arange(n)     # words to the end of the text
    key = owner.astype(np.int64) * (int(ids.max()) + 1) + ids
    suffixes = np.argsort(key, kind="stable")
    slots = np.arange(n)
    rank = np.empty(n, dtype=np.int64)
    rank[suffixes] = _first_slots(key[suffixes], slots)
    levels, length = [rank], 1
    while True:
        own = rank[suffixes]
        tied = np.zeros(n, dtype=bool)
        tied[1:] = own[1:] == own[:-1]
        tied[:-1] |= tied[1:]
        slots = np.flatnonzero(tied)
        if not slots.size:
            break
        p = suffixes[slots]
        second = np.where(left[p] > length, rank[np.minimum(p + length, n - 1)], -1)
        key = own[slots] * np.int64(n + 1) + second + 1
        order = np.argsort(key, kind="stable")
        suffixes[slots] = p[order]
        rank = rank.copy()
        rank[p[order]] = _first_slots(key[order], slots)
        levels.append(rank)
        length *= 2
    near = np.flatnonzero(levels[0][suffixes[1:]] == levels[0][suffixes[:-1]])
    a, b = suffixes[near], suffixes[near + 1]
    common = np.zeros(a.size, dtype=np.int64)
    room = np.minimum(left[a], left[b])
    for j in range(len(levels) - 1, -1, -1):
        step = 1 << j
        x, y = np.minimum(a + common, n - 1), np.minimum(b + common, n - 1)
        same = (common + step <= room) & (levels[j][x] == levels[j][y])
        common += np.where(same, step, 0)
    np.maximum.at(longest, a, common)
    np.maximum.at(longest, b, common)
    return longest


def _first_slots(ordered: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """For sorted keys in their slots: the first slot of each run of equal keys."""
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    return slots[np.flatnonzero(new)][np.cumsum(new) - 1]


def covered(begin: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in one of the spans."""
    steps = np.bincount(begin, minlength=n + 1) - np.bincount(begin + length, minlength=n + 1)
    return np.cumsum(steps)[:n] > 0


def _count(flags: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    return np.bincount(owner[flags], minlength=texts)


def measure(texts: list[str]) -> dict[str, np.ndarray]:
    """The counts of every text, as arrays."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    words = [r.split() for r in raw]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    total = int(sizes.sum())
    owner = np.repeat(np.arange(len(texts)), sizes)
    if total:
        codes, _ = pd.factorize(np.array([w for own in words for w in own], dtype=object))
        longest = repeats(codes, owner)
    else:
        longest = np.zeros(0, dtype=np.int64)
    base = np.flatnonzero(longest >= BASE_WINDOW)
    long = np.flatnonzero(longest >= LEAST_REPEAT)
    top = np.zeros(len(texts), dtype=np.int64)
    np.maximum.at(top, owner, longest)
    return {
        "n_words": sizes,
        "word_chars": np.array([len(t) - sum(r.count(s) for s in SPACES) for t, r in zip(texts, raw)], dtype=np.int64),
        "n_symbols": np.array([len(r) - len(r.translate(None, SYMBOLS)) for r in raw], dtype=np.int64),
        "n_dup_lines": np.array([_repeated_lines(r) for r in raw], dtype=np.int64),
        "n_repeat_words": _count(covered(base, np.full(base.size, BASE_WINDOW), total), owner, len(texts)),
        "covered_words": _count(covered(long, longest[long], total), owner, len(texts)),
        "longest_repeat": top,
    }


def _repeated_lines(raw: bytes) -> int:
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def judge(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The kept columns with the counts, base_failed and kept.

    base_failed: fewer than BASE_LEAST_WORDS words, or over BASE_PERCENT percent of the words in repeated windows of
    BASE_WINDOW words. kept: neither that, nor repeats of LEAST_REPEAT words or more over MOST_COVERED of the words,
    nor a longest repeat over both MOST_LONGEST words and MOST_LONGEST_SHARE of them. Null and empty texts have no
    words and fail. Each row stands for itself; an empty table gives no rows.
    """
    def work(texts):
        m = measure(texts)
        n = m["n_words"]
        failed = (n < BASE_LEAST_WORDS) | (100 * m["n_repeat_words"] > BASE_PERCENT * n)
        over = (m["covered_words"] > MOST_COVERED * n) | (
            m["longest_repeat"] > np.maximum(MOST_LONGEST, MOST_LONGEST_SHARE * n))
        return [*m.values(), failed, ~failed & ~over]

    return map_texts(docs, keep, "n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                     "n_repeat_words long, covered_words long, longest_repeat long, base_failed boolean, "
                     "kept boolean", work)
