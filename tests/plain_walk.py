"""Shared flow edges settled one after the other: what the waves are held against."""

from collections.abc import Iterator
from itertools import chain

from wattmirror.operators.flows import REMAINING_CHILD, REMAINING_PARENT


def walk(parents, children, parent_kind, child_kind, parent_value, child_value, caps,
            parent_linked=(), child_linked=()) -> list[float]:
    """Flows of one snapshot's shared edges, given in order.

    An edge touching a remaining node waits for the other edges of the node it competes for, so
    remaining nodes only get what is left. The waiting is a stack, not recursion. Every list of edges
    is gone through once: whoever comes to it later goes on where the others stopped, as what lies
    before has been started. So the time is in proportion to the edges.

    A remaining node with linked nodes is worth its sum and what they make of it. The edge that completes the sum was
    given without that limit, so it is judged a second time; the node keeps the worth it had then.
    """
    number = lambda v: 0.0 if v is None or v != v else max(v, 0.0)
    kind = dict(zip(parents, parent_kind)) | dict(zip(children, child_kind))
    own = dict(zip(parents, map(number, parent_value))) | dict(zip(children, map(number, child_value)))
    linked = {n: x for n, x in chain(zip(parents, parent_linked), zip(children, child_linked))
              if x is not None and x == x}
    out_of: dict[str, list[int]] = {}
    into: dict[str, list[int]] = {}
    for i, (p, c) in enumerate(zip(parents, children)):
        out_of.setdefault(p, []).append(i)
        into.setdefault(c, []).append(i)

    flow: list[float | None] = [None] * len(parents)
    started = [False] * len(parents)
    given = dict.fromkeys(out_of, 0.0)
    taken = dict.fromkeys(into, 0.0)

    # What a remaining node is worth: the flows on its other side, once the last of them is known.
    other_side = {n: into.get(n, []) if k == REMAINING_PARENT else out_of.get(n, [])
                  for n, k in kind.items() if k in (REMAINING_PARENT, REMAINING_CHILD)}
    unknown = {n: len(edges) for n, edges in other_side.items()}
    total = lambda node: max(0.0, sum(flow[j] for j in other_side[node]) + linked.get(node, 0.0))
    summed = {n: total(n) for n, edges in other_side.items() if not edges}

    def worth(node: str) -> float:
        if node not in other_side:
            return own[node]
        return float("inf") if unknown[node] else summed[node]

    ahead_into = {n: iter(edges) for n, edges in into.items()}
    ahead_out = {n: iter(edges) for n, edges in out_of.items()}

    def rivals(node: str) -> Iterator[int]:
        if kind[node] == REMAINING_CHILD:
            for j in out_of.get(node, []):
                yield from ahead_into[children[j]]
        elif kind[node] == REMAINING_PARENT:
            for j in into.get(node, []):
                yield from ahead_out[parents[j]]

    rivals_of = {n: rivals(n) for n in kind}
    waits_for = lambda i: chain(rivals_of[parents[i]], rivals_of[children[i]])

    def passing(i: int) -> float:
        room = max(0.0, worth(parents[i]) - given[parents[i]])
        need = max(0.0, worth(children[i]) - taken[children[i]])
        limit = float("inf") if caps[i] is None or caps[i] != caps[i] else number(caps[i])
        return min(room, need, limit) if room and need else 0.0

    def settle(i: int) -> None:
        p, c = parents[i], children[i]
        flow[i] = passing(i)
        again = False
        for node, role in ((p, REMAINING_CHILD), (c, REMAINING_PARENT)):
            if kind[node] == role:
                unknown[node] -= 1
                if not unknown[node]:
                    summed[node] = total(node)
                    again |= node in linked
        if again:
            flow[i] = passing(i)
        given[p] += flow[i]
        taken[c] += flow[i]

    for first in range(len(parents)):
        if started[first]:
            continue
        started[first] = True
        stack = [(first, waits_for(first))]
        while stack:
            i, pending = stack[-1]
            rival = next((j for j in pending if not started[j]), None)
            if rival is None:
                settle(i)
                stack.pop()
            else:
                started[rival] = True
                stack.append((rival, waits_for(rival)))
    return flow
