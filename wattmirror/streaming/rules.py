"""Detection rules for one entity, fed its events in order.

A rule keeps a small memory (a text, a moment, an event id). ``step`` takes the next event,
``settle`` learns that no event up to and at ``now`` can come any more. Both return what fires.
Times are microseconds. These are the streaming twins of the batch detections.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class Event:
    event_id: int
    us: int
    state: str | None


@dataclass(frozen=True)
class Memory:
    """What a rule remembers; ``us`` NULL means nothing is pending."""

    state: str | None = None
    us: int | None = None
    event_id: int | None = None


@dataclass(frozen=True)
class Fired:
    event_id: int
    us: int
    from_state: str | None
    state: str | None
    fires_us: int


def _wanted(state, allowed) -> bool:
    return allowed is None or state in allowed


@dataclass(frozen=True)
class Transition:
    """A state change from any of ``from_`` to any of ``to``."""

    from_: tuple[str, ...] | None = None
    to: tuple[str, ...] | None = None

    def step(self, event: Event, memory: Memory) -> tuple[list[Fired], Memory]:
        was = memory.state
        if event.state == was:
            return [], memory
        fired = []
        if memory.event_id is not None and was is not None and _wanted(was, self.from_) and _wanted(event.state, self.to):
            fired = [Fired(event.event_id, event.us, was, event.state, event.us)]
        return fired, Memory(event.state, None, event.event_id)

    def settle(self, now: int, memory: Memory) -> tuple[list[Fired], Memory]:
        return [], memory

    def wakes_at(self, memory: Memory) -> int | None:
        return None


@dataclass(frozen=True)
class HeldFor:
    """A wanted state that lasts at least ``wait``."""

    states: tuple[str, ...] | None
    wait: int

    def _due(self, memory: Memory) -> list[Fired]:
        return [Fired(memory.event_id, memory.us, None, memory.state, memory.us + self.wait)]

    def step(self, event: Event, memory: Memory) -> tuple[list[Fired], Memory]:
        if memory.event_id is not None and event.state == memory.state:
            return [], memory
        over = memory.us is not None and event.us >= memory.us + self.wait
        began = event.us if _wanted(event.state, self.states) else None
        return (self._due(memory) if over else []), Memory(event.state, began, event.event_id)

    def settle(self, now: int, memory: Memory) -> tuple[list[Fired], Memory]:
        if memory.us is None or now < memory.us + self.wait:
            return [], memory
        return self._due(memory), replace(memory, us=None)

    def wakes_at(self, memory: Memory) -> int | None:
        return None if memory.us is None else memory.us + self.wait


@dataclass(frozen=True)
class Debounce:
    """A trigger that no other follows within ``wait``."""

    wait: int

    def _due(self, memory: Memory) -> list[Fired]:
        return [Fired(memory.event_id, memory.us, None, memory.state, memory.us + self.wait)]

    def step(self, event: Event, memory: Memory) -> tuple[list[Fired], Memory]:
        quiet = memory.us is not None and event.us > memory.us + self.wait
        return (self._due(memory) if quiet else []), Memory(event.state, event.us, event.event_id)

    def settle(self, now: int, memory: Memory) -> tuple[list[Fired], Memory]:
        if memory.us is None or now < memory.us + self.wait:
            return [], memory
        return self._due(memory), replace(memory, us=None)

    def wakes_at(self, memory: Memory) -> int | None:
        return None if memory.us is None else memory.us + self.wait


@dataclass(frozen=True)
class CoolDown:
    """A trigger at least ``wait`` after the last one that counted."""

    wait: int

    def step(self, event: Event, memory: Memory) -> tuple[list[Fired], Memory]:
        if memory.us is not None and event.us < memory.us + self.wait:
            return [], memory
        return ([Fired(event.event_id, event.us, None, event.state, event.us)],
                Memory(event.state, event.us, event.event_id))

    def settle(self, now: int, memory: Memory) -> tuple[list[Fired], Memory]:
        return [], memory

    def wakes_at(self, memory: Memory) -> int | None:
        return None


@dataclass(frozen=True)
class Latch:
    """A flag set by some states and cleared by others; fires when it changes."""

    sets: tuple[str, ...]
    resets: tuple[str, ...]

    def step(self, event: Event, memory: Memory) -> tuple[list[Fired], Memory]:
        if event.state not in self.sets and event.state not in self.resets:
            return [], memory
        flag = "true" if event.state in self.sets else "false"
        was = memory.state or "false"
        fired = [] if flag == was else [Fired(event.event_id, event.us, was, flag, event.us)]
        return fired, Memory(flag, None, event.event_id)

    def settle(self, now: int, memory: Memory) -> tuple[list[Fired], Memory]:
        return [], memory

    def wakes_at(self, memory: Memory) -> int | None:
        return None


def run(rule, events: Iterator[Event], memory: Memory, now: int) -> tuple[list[Fired], Memory]:
    """Feed ordered events, then tell the rule how far time has come."""
    fired: list[Fired] = []
    for event in events:
        out, memory = rule.step(event, memory)
        fired += out
    out, memory = rule.settle(now, memory)
    return fired + out, memory
