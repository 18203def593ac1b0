"""Cheapest repair of a role sequence by block tables, in the manner of the Four Russians.

What is left of a conversation costs, depending on the state that the part before it ends in, one of four amounts. Less
their least, these cost vectors take few values, as an inserted turn leads from any state to any later one. For every
block of BLOCK symbols and every cost vector behind it, tables hold the vector in front, what the block adds, and the
state that the cheapest path leaves the block in. Sequences are gone through block by block from behind by lookup; then
the blocks, expanded backward from the vectors behind them, are traced in order. At each point every edit leads to
one state only, so the least initial on a cheapest path gives the least audit.
"""

from __future__ import annotations

import functools
from itertools import product

import numpy as np

# Fixed by the contract: costs, and the grammar (s?(ua)+)?.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = (USER, USER, ASSISTANT, USER)          # the state that an inserted or reroled turn leads to
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
END = (0, 4, 2, 0)                             # costs at the end: inserts that complete the last pair

BLOCK = 3
OTHER = 3                                      # role class beside s, u, a
MUST_DELETE, SYMBOLS = 8, 9                    # symbols below: 2 * role class + truncated


def symbol(initial: str, truncated: bool) -> int:
    """The symbol of a turn that need not be deleted."""
    return 2 * "sua".find(initial) + truncated if initial in ("s", "u", "a") else 2 * OTHER + truncated


def _keep(state: int, sign: int) -> int | None:
    """The state after keeping a turn of this symbol, if the grammar allows it."""
    to = (SYSTEM, USER, ASSISTANT, None)[sign // 2]
    allowed = state == START if to == SYSTEM else to == AFTER[state]
    return to if allowed else None


def in_front(behind: tuple, sign: int) -> tuple:
    """The cost vector in front of a symbol, from the one behind it."""
    costs = [DELETE + c for c in behind]
    if sign != MUST_DELETE:
        extra = TRUNCATED * (sign % 2)
        for state in range(4):
            kept = _keep(state, sign)
            costs[state] = min(costs[state], REROLE + extra + behind[AFTER[state]],
                               extra + behind[kept] if kept is not None else costs[state])
    user, assistant = costs[USER], costs[ASSISTANT]
    costs[USER], costs[ASSISTANT] = min(user, INSERT + assistant), min(assistant, INSERT + user)
    costs[START], costs[SYSTEM] = min(costs[START], INSERT + costs[USER]), min(costs[SYSTEM], INSERT + costs[USER])
    return tuple(costs)


def _normal(costs: tuple) -> tuple[tuple, int]:
    least = min(costs)
    return tuple(c - least for c in costs), least


def step(front: tuple, behind: tuple, sign: int, state: int) -> tuple[str, int]:
    """The edits of one symbol on the cheapest path with the least initials, and the state they lead to."""
    edits = ""
    while True:
        if front[state] == DELETE + behind[state]:
            return edits + "D", state
        if front[state] == INSERT + front[AFTER[state]]:
            edits, state = edits + "I", AFTER[state]
            continue
        kept, extra = _keep(state, sign), TRUNCATED * (sign % 2)
        if kept is not None and front[state] == extra + behind[kept]:
            return edits + "K", kept
        return edits + "R", AFTER[state]


class Tables:
    """All cost vectors that can occur, and transitions for blocks of 1 to BLOCK symbols."""

    def __init__(self):
        self.vectors, todo = [END], [END]
        while todo:
            vector = todo.pop()
            for sign in range(SYMBOLS):
                front = _normal(in_front(vector, sign))[0]
                if front not in self.vectors:
                    self.vectors.append(front)
                    todo.append(front)
        self.number = {v: i for i, v in enumerate(self.vectors)}
        n = len(self.vectors)
        self.front, self.added, self.leaves = {}, {}, {}
        for length in range(1, BLOCK + 1):
            blocks = list(product(range(SYMBOLS), repeat=length))
            front = np.zeros((len(blocks), n), dtype=np.int64)
            added, leaves = front.copy(), np.zeros((len(blocks), n, 4), dtype=np.int64)
            for code, signs in enumerate(blocks):
                for v in range(n):
                    front[code, v], added[code, v] = self._cross(signs, v)
                    leaves[code, v] = [self.expand(signs, v, state)[1] for state in range(4)]
            self.front[length], self.added[length], self.leaves[length] = front, added, leaves

    def _cross(self, signs: tuple, v: int) -> tuple[int, int]:
        vector, total = self.vectors[v], 0
        for sign in reversed(signs):
            vector, least = _normal(in_front(vector, sign))
            total += least
        return self.number[vector], total

    @functools.lru_cache(maxsize=1 << 16)       # noqa: B019 - one object per worker
    def expand(self, signs: tuple, v: int, state: int) -> tuple[tuple[str, ...], int]:
        """The edits of each symbol of a block before vector v, entered in `state`, and the state it is left in."""
        vectors = [self.vectors[v]]
        for sign in reversed(signs):
            vectors.append(in_front(vectors[-1], sign))
        vectors.reverse()
        edits = []
        for i, sign in enumerate(signs):
            edit, state = step(vectors[i], vectors[i + 1], sign, state)
            edits.append(edit)
        return tuple(edits), state

    @staticmethod
    def blocks(signs: bytes) -> list[tuple[int, int, tuple]]:
        """(length, code, symbols) of the blocks of a sequence; the last may be shorter."""
        out = []
        for i in range(0, len(signs), BLOCK):
            part, code = tuple(signs[i:i + BLOCK]), 0
            for sign in part:
                code = code * SYMBOLS + sign
            out.append((len(part), code, part))
        return out

    def summary(self, signs: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every vector behind a sequence: the vector in front, the cost added, the state left for each entered."""
        cut = self.blocks(signs)
        behind, total, seen = np.arange(len(self.vectors)), np.zeros(len(self.vectors), dtype=np.int64), []
        for length, code, _ in reversed(cut):
            seen.append(behind)
            total = total + self.added[length][code][behind]
            behind = self.front[length][code][behind]
        states = np.tile(np.arange(4), (len(self.vectors), 1))
        for (length, code, _), v in zip(cut, reversed(seen)):
            states = np.take_along_axis(self.leaves[length][code][v], states, axis=1)
        return behind, total, states

    def trace(self, signs: bytes, v: int, state: int) -> tuple[list[str], int]:
        """The edits of each symbol of a sequence before vector v, entered in `state`, and the state it is left in."""
        cut, seen = self.blocks(signs), []
        for length, code, _ in reversed(cut):
            seen.append(v)
            v = int(self.front[length][code][v])
        edits = []
        for (_, _, part), behind in zip(cut, reversed(seen)):
            own, state = self.expand(part, behind, state)
            edits.extend(own)
        return edits, state


@functools.cache
def tables() -> Tables:
    return Tables()


def closing(state: int) -> str:
    """The inserts that complete the last pair."""
    return "I" * (END[state] // INSERT)
