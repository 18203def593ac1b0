"""A small character tagger in numpy: two LSTMs read a window from both sides, a CRF ties the tags."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Character classes the tagger reads: every listed character, digits, letters, and the rest.
SIGNS = "@.-+() _%/:=\"',#"
CLASSES = len(SIGNS) + 6
PAD = CLASSES - 1


def _class_table() -> np.ndarray:
    table = np.full(129, len(SIGNS) + 4, dtype=np.int8)
    for i, sign in enumerate(SIGNS):
        table[ord(sign)] = i
    table[ord("0"):ord("9") + 1] = len(SIGNS)
    table[ord("a"):ord("z") + 1] = len(SIGNS) + 1
    table[ord("A"):ord("Z") + 1] = len(SIGNS) + 2
    table[9:14] = SIGNS.index(" ")
    table[128] = len(SIGNS) + 3
    return table


TABLE = _class_table()


def classes_of(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return TABLE[np.minimum(points, 128)]


@dataclass
class Tagger:
    """Weights: w* per direction (class table, recurrent, bias), output layer, transitions between tags."""
    p: dict[str, np.ndarray]
    hidden: int
    tags: int

    @classmethod
    def fresh(cls, tags: int, hidden: int, seed: int) -> Tagger:
        rng = np.random.default_rng(seed)
        p = {}
        for side in "fb":
            p[f"x{side}"] = rng.normal(0, 0.3, (CLASSES, 4 * hidden))
            p[f"h{side}"] = rng.normal(0, 0.3 / np.sqrt(hidden), (hidden, 4 * hidden))
            p[f"b{side}"] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])
        p["out"] = rng.normal(0, 0.3, (2 * hidden, tags))
        p["bias"] = np.zeros(tags)
        p["move"] = np.zeros((tags, tags))
        return cls(p, hidden, tags)

    def _run(self, x: np.ndarray, side: str, keep: bool):
        """x: (steps, n) classes. Returns hidden states (steps, n, hidden) and, if asked, what backward needs."""
        steps, n = x.shape
        k = self.hidden
        h = c = np.zeros((n, k))
        states, kept = np.empty((steps, n, k)), []
        for t in (range(steps) if side == "f" else range(steps - 1, -1, -1)):
            z = self.p[f"x{side}"][x[t]] + h @ self.p[f"h{side}"] + self.p[f"b{side}"]
            gates = 1 / (1 + np.exp(-z[:, :3 * k]))
            new = np.tanh(z[:, 3 * k:])
            before_h, before_c = h, c
            c = gates[:, k:2 * k] * c + gates[:, :k] * new
            squashed = np.tanh(c)
            h = gates[:, 2 * k:] * squashed
            states[t] = h
            if keep:
                kept.append((t, gates, new, before_h, before_c, squashed))
        return states, kept

    def scores(self, x: np.ndarray, keep: bool = False):
        forward, kept_f = self._run(x, "f", keep)
        backward, kept_b = self._run(x, "b", keep)
        both = np.concatenate([forward, backward], axis=2)
        return both @ self.p["out"] + self.p["bias"], both, kept_f, kept_b

    def chain(self, e: np.ndarray):
        """Log forward and backward sums over tag paths and the log of the whole sum."""
        move = self.p["move"]
        ahead, behind = np.empty_like(e), np.zeros_like(e)
        ahead[0] = e[0]
        for t in range(1, len(e)):
            ahead[t] = _logsum(ahead[t - 1][:, :, None] + move, 1) + e[t]
        for t in range(len(e) - 2, -1, -1):
            behind[t] = _logsum(move + (behind[t + 1] + e[t + 1])[:, None, :], 2)
        return ahead, behind, _logsum(ahead[-1], 1)

    def marginals(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per step and window: the probability of each tag, and the tag on the best path."""
        e = self.scores(x)[0]
        ahead, behind, whole = self.chain(e)
        return np.exp(ahead + behind - whole[None, :, None]), self._best(e)

    def _best(self, e: np.ndarray) -> np.ndarray:
        move, steps = self.p["move"], len(e)
        back, score = np.empty(e.shape, dtype=np.int8), e[0]
        for t in range(1, steps):
            ways = score[:, :, None] + move
            back[t] = ways.argmax(axis=1)
            score = ways.max(axis=1) + e[t]
        path = np.empty(e.shape[:2], dtype=np.int8)
        path[-1] = score.argmax(axis=1)
        rows = np.arange(e.shape[1])
        for t in range(steps - 1, 0, -1):
            path[t - 1] = back[t][rows, path[t]]
        return path

    def gradient(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log likelihood of tag paths y (steps, n)."""
        steps, n = x.shape
        e, both, kept_f, kept_b = self.scores(x, keep=True)
        ahead, behind, whole = self.chain(e)
        hot = np.eye(self.tags)
        d_e = (np.exp(ahead + behind - whole[None, :, None]) - hot[y]) / n
        pair = ahead[:-1, :, :, None] + self.p["move"] + (behind[1:] + e[1:])[:, :, None, :] - whole[None, :, None, None]
        taken = np.zeros((self.tags, self.tags))
        np.add.at(taken, (y[:-1].ravel(), y[1:].ravel()), 1)
        g = {"move": (np.exp(pair).sum(axis=(0, 1)) - taken) / n, "bias": d_e.sum(axis=(0, 1)),
             "out": np.einsum("tnh,tnk->hk", both, d_e)}
        d_both = d_e @ self.p["out"].T
        for side, kept, d in (("f", kept_f, d_both[:, :, :self.hidden]), ("b", kept_b, d_both[:, :, self.hidden:])):
            g |= self._backward(x, side, kept, d)
        return g

    def _backward(self, x, side, kept, d_states):
        k, n = self.hidden, x.shape[1]
        g_x, g_h, g_b = (np.zeros_like(self.p[f"{w}{side}"]) for w in "xhb")
        d_h, d_c = np.zeros((n, k)), np.zeros((n, k))
        for t, gates, new, before_h, before_c, squashed in reversed(kept):
            into, keep, out = gates[:, :k], gates[:, k:2 * k], gates[:, 2 * k:]
            d_h = d_h + d_states[t]
            d_c = d_c + d_h * out * (1 - squashed ** 2)
            d_z = np.concatenate([d_c * new * into * (1 - into), d_c * before_c * keep * (1 - keep),
                                  d_h * squashed * out * (1 - out), d_c * into * (1 - new ** 2)], axis=1)
            np.add.at(g_x, x[t], d_z)
            g_h += before_h.T @ d_z
            g_b += d_z.sum(axis=0)
            d_h, d_c = d_z @ self.p[f"h{side}"].T, d_c * keep
        return {f"x{side}": g_x, f"h{side}": g_h, f"b{side}": g_b}

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int, batch: int, rate: float, seed: int) -> Tagger:
        """Adam over shuffled batches; x and y are (windows, length)."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            rows = rng.integers(0, len(x), min(batch, len(x)))
            g = self.gradient(x[rows].T.astype(np.int64), y[rows].T.astype(np.int64))
            scale = min(1.0, 5.0 / (np.sqrt(sum(float((v ** 2).sum()) for v in g.values())) + 1e-9))
            now = rate * min(1.0, 2.0 * (1 - step / (steps + 1)))
            for k, v in g.items():
                first[k] = 0.9 * first[k] + 0.1 * scale * v
                second[k] = 0.99 * second[k] + 0.01 * (scale * v) ** 2
                self.p[k] = self.p[k] - now * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
        return self


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.log(np.exp(a - top).sum(axis=axis)) + np.squeeze(top, axis)
