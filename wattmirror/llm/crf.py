"""A linear-chain conditional random field over words with two tags, in numpy."""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np

SPACE = 1 << 18                 # hashed features
EDGES = " \t\n\r\x0b\x0c.,;:!?\"'()[]{}<>*_-"


def features(word: str) -> tuple[int, ...]:
    """Hashed features of one word: itself, its first 4, 5 and 6 letters, its last 3."""
    w = word.strip(EDGES).lower()
    return tuple(zlib.crc32(x.encode("utf-8", "surrogatepass")) % SPACE for x in
                 ("w " + w, "4 " + w[:4], "5 " + w[:5], "6 " + w[:6], "e " + w[-3:]))


KNOWN = 100_000                 # words a task remembers
PER_WORD = 5
LEXICAL = 4                     # of these, the first ones: the word and how it begins


@dataclass
class Field:
    """Weights for the marked tag against the plain one: of a word's features where it stands, and of the words
    before and after it; and how tags follow each other."""
    here: np.ndarray
    before: np.ndarray
    after: np.ndarray
    move: np.ndarray
    start: float
    known: dict[str, tuple[float, float, float]] = field(default_factory=dict, repr=False)
    plain: tuple[list, list, list] | None = field(default=None, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "known": {}, "plain": None}

    @classmethod
    def fresh(cls) -> Field:
        return cls(np.zeros(SPACE), np.zeros(SPACE), np.zeros(SPACE), np.zeros((2, 2)), -2.0)

    def of_word(self, word: str) -> tuple[float, float, float]:
        got = self.known.get(word)
        if got is None:
            if self.plain is None:              # single values come faster from lists
                self.plain = self.here.tolist(), self.before.tolist(), self.after.tolist()
            here, before, after = self.plain
            ids = features(word)
            got = (sum([here[i] for i in ids]), before[ids[0]], after[ids[0]])
            if len(self.known) > KNOWN:
                self.known.clear()
            self.known[word] = got
        return got

    def marginals(self, gains: np.ndarray, live: np.ndarray) -> np.ndarray:
        """P(marked) per step and chain. gains: (steps, n) log weight of marked against plain; live: real steps,
        each chain's first ones."""
        steps, n = gains.shape
        ahead, behind = np.empty((steps, n)), np.zeros((steps, n))
        (a, b), (c, d) = self.move
        x = gains[0] + self.start
        ahead[0] = x
        for t in range(1, steps):              # log odds forward
            x = gains[t] + np.logaddexp(b, x + d) - np.logaddexp(a, x + c)
            ahead[t] = x
        y = np.zeros(n)
        for t in range(steps - 2, -1, -1):
            z = gains[t + 1] + y
            y = np.where(live[t + 1], np.logaddexp(c, z + d) - np.logaddexp(a, z + b), 0.0)
            behind[t] = y
        return 1 / (1 + np.exp(-np.clip(ahead + behind, -60, 60)))

    def fit(self, ids: np.ndarray, tags: np.ndarray, live: np.ndarray, updates: int, rate: float,
            seed: int) -> Field:
        """Adagrad on the log likelihood of tags (n, steps); ids: (n, steps, PER_WORD) features, live: real words."""
        rng = np.random.default_rng(seed)
        size = {k: np.full(SPACE, 1e-2) for k in ("here", "before", "after")}
        size_move, size_start = np.full((2, 2), 1e-2), 1e-2
        done = 0
        while done < updates:
            for rows in np.array_split(rng.permutation(len(ids)), max(1, len(ids) // 256)):
                done += 1
                f, y, ok = ids[rows].transpose(1, 0, 2), tags[rows].T.astype(float), live[rows].T
                gains = self.here[f].sum(axis=2)
                gains[1:] += self.before[f[:-1, :, 0]]
                gains[:-1] += np.where(ok[1:], self.after[f[1:, :, 0]], 0.0)
                p, pair = self._expected(gains, ok)
                d = (y - p) * ok
                for name, where, what in (("here", f.reshape(-1, PER_WORD), np.repeat(d.reshape(-1, 1), PER_WORD, 1)),
                                          ("before", f[:-1, :, 0], d[1:]),
                                          ("after", f[1:, :, 0], d[:-1] * ok[1:])):
                    g = np.bincount(where.ravel(), what.ravel(), SPACE)
                    hit = np.flatnonzero(g)
                    g = g[hit] / len(rows) - 1e-5 * getattr(self, name)[hit]
                    size[name][hit] += g * g
                    getattr(self, name)[hit] += rate * g / np.sqrt(size[name][hit])
                seen = np.zeros((2, 2))
                both = ok[1:] & ok[:-1]
                np.add.at(seen, (y[:-1][both].astype(int), y[1:][both].astype(int)), 1)
                g = (seen - pair) / len(rows)
                size_move += g * g
                self.move = self.move + rate * g / np.sqrt(size_move)
                g0 = float(d[0].mean())
                size_start += g0 * g0
                self.start += rate * g0 / np.sqrt(size_start)
        return self

    def _expected(self, gains: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Marginals and the expected count of each tag pair."""
        steps, n = gains.shape
        e = np.stack([np.zeros_like(gains), gains], axis=2)
        e[0, :, 1] += self.start
        ahead, behind = np.empty((steps, n, 2)), np.zeros((steps, n, 2))
        ahead[0] = e[0]
        for t in range(1, steps):
            now = np.logaddexp(ahead[t - 1][:, :1] + self.move[0], ahead[t - 1][:, 1:] + self.move[1]) + e[t]
            ahead[t] = np.where(live[t][:, None], now, ahead[t - 1])
        for t in range(steps - 2, -1, -1):
            z = behind[t + 1] + e[t + 1]
            now = np.logaddexp(self.move[:, 0] + z[:, :1], self.move[:, 1] + z[:, 1:])
            behind[t] = np.where(live[t + 1][:, None], now, 0.0)
        whole = np.logaddexp(ahead[-1, :, 0], ahead[-1, :, 1])
        p = np.exp(np.minimum(ahead[:, :, 1] + behind[:, :, 1] - whole, 0.0)) * live
        pair = np.zeros((2, 2))
        z = behind[1:] + e[1:]
        for i in range(2):
            for j in range(2):
                joint = np.exp(ahead[:-1, :, i] + self.move[i, j] + z[:, :, j] - whole)
                pair[i, j] = (joint * (live[1:] & live[:-1])).sum()
        return p, pair
