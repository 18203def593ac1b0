"""Settling shared flow edges in waves, in numpy over many graphs at once.

Edges are settled in one order, and an edge depends on those before it at its parent and at its child. In each wave
every parent settles its next edges as far as each of them comes next at its child, too: what the children ask for is
known then, and a clamped running sum gives the flows. Children do the same with their parents' edges. A wave settles
at least the next edge of every graph, mostly whole parents.

The order itself is the edges' own, but for edges at remaining nodes, which wait for others. It is a depth-first order,
so only graphs with remaining nodes are walked for it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd

REMAINING_PARENT, REMAINING_CHILD = "remaining_parent", "remaining_child"
PAYS = 64          # a wave that settles less than this part of what is open is followed by single steps


def waiting_order(parents: list, children: list, kind: dict) -> list[int]:
    """The order in which the edges of one graph are settled, given in their own order.

    An edge at a remaining node waits for the other edges of the node it competes for, so remaining nodes only get what
    is left. The waiting is a stack, not recursion. Every list of rivals is gone through once: whoever comes to it later
    goes on where the others stopped, as what lies before has been started. So the time is in proportion to the edges.
    """
    out_of: dict = {}
    into: dict = {}
    for i, (p, c) in enumerate(zip(parents, children)):
        out_of.setdefault(p, []).append(i)
        into.setdefault(c, []).append(i)
    ahead_into = {n: iter(edges) for n, edges in into.items()}
    ahead_out = {n: iter(edges) for n, edges in out_of.items()}

    def rivals(node) -> Iterator[int]:
        if kind[node] == REMAINING_CHILD:
            for j in out_of.get(node, []):
                yield from ahead_into[children[j]]
        elif kind[node] == REMAINING_PARENT:
            for j in into.get(node, []):
                yield from ahead_out[parents[j]]

    shared = {n: rivals(n) for n, k in kind.items() if k in (REMAINING_PARENT, REMAINING_CHILD)}
    none: Iterator[int] = iter(())
    order, started = [], [False] * len(parents)
    for first in range(len(parents)):
        if started[first]:
            continue
        stack, begin = [], first
        while True:
            if begin is not None:
                started[begin] = True
                stack.append((begin, chain(shared.get(parents[begin], none), shared.get(children[begin], none))))
            i, pending = stack[-1]
            begin = next((j for j in pending if not started[j]), None)
            if begin is None:
                order.append(i)
                stack.pop()
                if not stack:
                    break
    return order


def _zero(values: np.ndarray) -> np.ndarray:
    """Not below zero; infinity less infinity leaves nothing."""
    return np.where(np.isnan(values), 0.0, np.maximum(values, 0.0))


class Graphs:
    """The edges of many graphs in the order they are settled in, and the state of their nodes."""

    def __init__(self, graph, parents, children, parent_kind, child_kind, parent_value, child_value, caps,
                 parent_linked=None, child_linked=None):
        n = len(graph)
        names = pd.factorize(np.concatenate([np.asarray(parents, dtype=object), np.asarray(children, dtype=object)]))[0]
        _, nodes = np.unique(np.tile(np.asarray(graph, dtype=np.int64), 2) * (names.max(initial=0) + 1) + names,
                             return_inverse=True)
        p, c = nodes[:n], nodes[n:]
        size = int(nodes.max(initial=-1)) + 1

        def per_node(of_parent, of_child, start):
            out = np.full(size, start, dtype=object if isinstance(start, str) else float)
            for places, values in ((p, of_parent), (c, of_child)):
                out[places] = values
            return out

        def number(values):
            return np.full(n, np.nan) if values is None else np.asarray(values, dtype=float)

        kind = per_node(np.asarray(parent_kind, dtype=object), np.asarray(child_kind, dtype=object), "")
        gives, takes = kind == REMAINING_CHILD, kind == REMAINING_PARENT
        order = self._order(np.asarray(graph), p, c, kind, gives | takes)
        self.n, self.order, self.p, self.c = n, order, p[order], c[order]
        caps = number(caps)[order]
        self.cap = np.where(np.isnan(caps), np.inf, np.maximum(caps, 0.0))
        linked = per_node(number(parent_linked), number(child_linked), np.nan)
        own = _zero(per_node(number(parent_value), number(child_value), np.nan))

        # A remaining node is worth the flows on its other side, once the last of them is known.
        self.counts_out, self.counts_in = gives[self.p], takes[self.c]
        self.unknown = np.bincount(self.p[self.counts_out], minlength=size) + np.bincount(self.c[self.counts_in], minlength=size)
        last = np.full(size, -1, dtype=np.int64)
        places = np.arange(n)
        np.maximum.at(last, self.p[self.counts_out], places[self.counts_out])
        np.maximum.at(last, self.c[self.counts_in], places[self.counts_in])
        remaining = gives | takes
        self.linked = np.where(np.isnan(linked), 0.0, linked)
        self.worth = np.where(remaining, np.where(self.unknown > 0, np.nan, np.maximum(self.linked, 0.0)), own)
        self.gives = gives
        # Open: the node's worth is not known yet when the edge is settled, and does not limit it.
        self.open_p, self.open_c = remaining[self.p] & (places <= last[self.p]), remaining[self.c] & (places <= last[self.c])
        # An edge that completes the sum of a node with linked ones is judged a second time.
        has = ~np.isnan(linked)
        self.again_p = self.counts_out & has[self.p] & (places == last[self.p])
        self.again_c = self.counts_in & has[self.c] & (places == last[self.c])
        self.again = self.again_p | self.again_c
        self.given, self.taken = np.zeros(size), np.zeros(size)
        self.flow = np.full(n, np.nan)

    @staticmethod
    def _order(graph, p, c, kind, remaining) -> np.ndarray:
        """Graphs of one shape (ends and kinds, by the places of the nodes in their graph) are walked once."""
        order = np.arange(p.size)
        touched = remaining[p] | remaining[c]
        if touched.any():
            starts = np.flatnonzero(np.concatenate([[True], graph[1:] != graph[:-1], [True]]))
            # The nodes of a graph are numbered without gaps, after those of the graphs before it.
            base = np.append(np.minimum.reduceat(np.minimum(p, c), starts[:-1]), kind.size)
            size = np.diff(starts)
            own_p, own_c = p - np.repeat(base[:-1], size), c - np.repeat(base[:-1], size)
            code = np.where(kind == REMAINING_CHILD, 1, np.where(kind == REMAINING_PARENT, 2, 0)).astype(np.int8)
            walked: dict = {}
            bounds, nodes = starts.tolist(), base.tolist()
            for k in np.flatnonzero(np.logical_or.reduceat(touched, starts[:-1])).tolist():
                lo, hi = bounds[k], bounds[k + 1]
                shape = (own_p[lo:hi].tobytes(), own_c[lo:hi].tobytes(), code[nodes[k]:nodes[k + 1]].tobytes())
                if shape not in walked:
                    kinds = dict(enumerate(kind[nodes[k]:nodes[k + 1]]))
                    walked[shape] = np.array(waiting_order(own_p[lo:hi].tolist(), own_c[lo:hi].tolist(), kinds))
                order[lo:hi] = lo + walked[shape]
        return order

    def _limits(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the parent has left and what the child still takes, at this point."""
        with np.errstate(invalid="ignore"):
            room = np.where(self.open_p[e], np.inf, self.worth[self.p[e]]) - self.given[self.p[e]]
            need = np.where(self.open_c[e], np.inf, self.worth[self.c[e]]) - self.taken[self.c[e]]
        return _zero(room), _zero(need)

    def _blocked(self, e: np.ndarray) -> np.ndarray:
        return (~self.open_p[e] & (self.unknown[self.p[e]] > 0)) | (~self.open_c[e] & (self.unknown[self.c[e]] > 0))

    def _settle(self, e: np.ndarray, flow: np.ndarray) -> None:
        """Note the flows of edges, which are in order, and the worth of the nodes they complete."""
        special = np.flatnonzero(self.again[e])
        if special.size:
            s = e[special]
            for mine, node, moved in ((self.again_p[s], self.p[s], self.given), (self.again_c[s], self.c[s], self.taken)):
                self.worth[node[mine]] = np.maximum(moved[node[mine]] + flow[special][mine] + self.linked[node[mine]], 0.0)
            room, need = self._limits(s)
            with np.errstate(invalid="ignore"):
                room = np.where(self.again_p[s], _zero(self.worth[self.p[s]] - self.given[self.p[s]]), room)
                need = np.where(self.again_c[s], _zero(self.worth[self.c[s]] - self.taken[self.c[s]]), need)
            flow[special] = np.minimum(np.minimum(room, need), self.cap[s])
        self.flow[e] = flow
        np.add.at(self.given, self.p[e], flow)
        np.add.at(self.taken, self.c[e], flow)
        changed = np.concatenate([self.p[e][self.counts_out[e]], self.c[e][self.counts_in[e]]])
        np.subtract.at(self.unknown, changed, 1)
        done = np.unique(changed)
        done = done[(self.unknown[done] == 0) & np.isnan(self.worth[done])]
        self.worth[done] = np.maximum(np.where(self.gives[done], self.given[done], self.taken[done]) + self.linked[done], 0.0)

    def _runs(self, e: np.ndarray, node: np.ndarray, first_there: np.ndarray, open_here: np.ndarray, limit: np.ndarray,
              asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next edges of each node that can be settled together, and their flows. e: by node, then in order."""
        head = np.concatenate([[True], node[e[1:]] != node[e[:-1]]])
        start = np.flatnonzero(head)
        run = np.cumsum(head) - 1
        begin = e[start][run]
        bad = ~first_there[e] | (open_here[e] != open_here[begin]) | (~head & (self.again[e] | self.again[begin]))
        seen = np.cumsum(bad)
        ready = seen - seen[start][run] + bad[start][run] == 0
        mine, run = e[ready], run[ready]
        want = np.minimum(asked[mine], self.cap[mine])
        endless = np.isinf(want)
        sums = pd.Series(np.where(endless, 0.0, want)).groupby(run).cumsum().to_numpy()
        ends = np.cumsum(endless)
        new = np.concatenate([[True], run[1:] != run[:-1]]) if mine.size else np.zeros(0, dtype=bool)
        before, ends_before = np.where(new, 0.0, np.roll(sums, 1)), np.roll(ends, 1)
        at = np.flatnonzero(new)
        base = np.where(at > 0, ends[at - 1], 0) if at.size else ends[:0]
        exhausted = ~new & (ends_before > (base[np.cumsum(new) - 1] if at.size else 0))
        with np.errstate(invalid="ignore"):
            left = np.where(exhausted, 0.0, _zero(limit[mine] - before))
        return mine, np.minimum(want, left)

    def flows(self) -> np.ndarray:
        """The flow of every edge, in the edges' own order."""
        by_p, by_c = np.argsort(self.p, kind="stable"), np.argsort(self.c, kind="stable")
        room, need, ready = np.zeros(self.n), np.zeros(self.n), np.zeros(self.n, dtype=bool)
        while by_p.size:
            room[by_p], need[by_p] = self._limits(by_p)
            next_p, next_c = ready.copy(), ready.copy()
            free = ~self._blocked(by_p)
            next_p[by_p] = np.concatenate([[True], self.p[by_p[1:]] != self.p[by_p[:-1]]]) & free
            free = ~self._blocked(by_c)
            next_c[by_c] = np.concatenate([[True], self.c[by_c[1:]] != self.c[by_c[:-1]]]) & free
            one, flow_one = self._runs(by_p, self.p, next_c, self.open_p, room, need)
            two, flow_two = self._runs(by_c, self.c, next_p, self.open_c, need, room)
            # The next edge of both its ends is in both, with the same flow.
            e, at = np.unique(np.concatenate([one, two]), return_index=True)
            self._settle(e, np.concatenate([flow_one, flow_two])[at])
            left = np.isnan(self.flow)
            if e.size * PAYS < by_p.size:
                self._singly(np.flatnonzero(left))
                break
            by_p, by_c = by_p[left[by_p]], by_c[left[by_c]]
        out = np.empty(self.n)
        out[self.order] = self.flow
        return out

    def _singly(self, rest: np.ndarray) -> None:
        """Edge after edge, where waves have become narrow."""
        p, c, cap = self.p[rest].tolist(), self.c[rest].tolist(), self.cap[rest].tolist()
        nodes = np.unique(np.concatenate([self.p[rest], self.c[rest]]))
        worth, unknown, given, taken, linked = (dict(zip(nodes.tolist(), x[nodes].tolist())) for x in (
            self.worth, self.unknown, self.given, self.taken, self.linked))
        inf = float("inf")

        def amount(have, used):
            return max(0.0, have - used) if have != inf or used != inf else 0.0

        for k, i in enumerate(rest.tolist()):
            a, b = p[k], c[k]
            have, take = inf if self.open_p[i] else worth[a], inf if self.open_c[i] else worth[b]
            flow = min(amount(have, given[a]), amount(take, taken[b]), cap[k])
            if self.again[i]:
                if self.again_p[i]:
                    have = worth[a] = max(0.0, given[a] + flow + linked[a])
                if self.again_c[i]:
                    take = worth[b] = max(0.0, taken[b] + flow + linked[b])
                flow = min(amount(have, given[a]), amount(take, taken[b]), cap[k])
            self.flow[i] = flow
            given[a] += flow
            taken[b] += flow
            for node, counts, moved in ((a, self.counts_out[i], given), (b, self.counts_in[i], taken)):
                if counts:
                    unknown[node] -= 1
                    if not unknown[node] and worth[node] != worth[node]:
                        worth[node] = max(0.0, moved[node] + linked[node])
