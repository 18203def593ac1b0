"""Detections on a stream of state events, in event-time order per entity."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wattmirror.streaming.rules import Event, Memory, run

FIRED_SCHEMA = ("entity_id bigint, event_id bigint, ts timestamp, from_state string, state string, "
                "fires_at timestamp")
CHUNK = 10_000          # rows of one state value
GROUPS = 4096           # groups that entities are hashed to; fixed for the life of a checkpoint
ROWS_SCHEMA = "rows binary"
WAITING = pa.schema([("entity_id", pa.int64()), ("known", pa.bool_()), ("event_id", pa.int64()), ("us", pa.int64()), ("state", pa.string())])
MEMORY = pa.schema([("entity_id", pa.int64()), ("known", pa.bool_()), ("state", pa.string()), ("us", pa.int64()), ("event_id", pa.int64())])


def _packed(rows: pa.Table) -> list[tuple[bytes]]:
    """The rows as Arrow streams of at most CHUNK rows, one state value each."""
    return [(_stream(rows.slice(at, CHUNK)),) for at in range(0, rows.num_rows, CHUNK)]


def _stream(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(values, schema: pa.Schema) -> pa.Table:
    return pa.concat_tables([schema.empty_table(), *(pa.ipc.open_stream(v[0]).read_all() for v in values)])


class OrderedDetector(StatefulProcessor):
    """Holds the events of a group of entities until the watermark has reached them, then feeds them in order, entity by entity.

    Events up to and including the watermark are complete: Spark drops whatever else comes for that time.

    Every call for state or a timer is a message to the JVM, so entities share them by groups. State per group: the events
    inside the watermark delay and the rule's small memory of every entity, both as Arrow streams. A single timer per group
    wakes it for the next waiting event or the next pending firing.
    """

    def __init__(self, rule):
        self.rule = rule

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", ROWS_SCHEMA)
        self.memory = handle.getListState("memory", ROWS_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, came = None, []
        for pdf in rows:
            us = pdf["us"].astype("int64")
            states = [None if pd.isna(s) else s for s in pdf["state"]]
            came.append(pa.table([pdf["entity_id"].astype("int64"), pdf["known"].astype("bool"), pdf["event_id"].astype("int64"), us, states],
                                 schema=WAITING))
            first = int(us.min()) if first is None else min(first, int(us.min()))
        if first is not None:
            self.waiting.appendList([value for table in came for value in _packed(table)])
            self._wake(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        held = _unpacked(self.waiting.get() if self.waiting.exists() else (), WAITING)
        reached = pc.less_equal(held["us"], now)
        ready, later = held.filter(reached), held.filter(pc.invert(reached))
        remembered = {}
        if self.memory.exists():
            for *who, state, us, event_id in zip(*(c.to_pylist() for c in _unpacked(self.memory.get(), MEMORY).columns)):
                remembered[tuple(who)] = Memory(state, us, event_id)
        due = {who: [] for who, memory in remembered.items() if (at := self.rule.wakes_at(memory)) is not None and at <= now}
        # The order is a stable one: what comes first stays first among equals.
        for entity, known, event_id, us, state in zip(*(c.to_pylist() for c in ready.take(
                np.lexsort([ready[c].to_numpy() for c in ("event_id", "us", "entity_id", "known")])).columns)):
            due.setdefault((entity, known), []).append(Event(event_id, us, state))
        fired, whose = [], []
        for who, events in due.items():
            out, remembered[who] = run(self.rule, events, remembered.get(who, Memory()), now)
            fired += out
            whose += [who[0] if who[1] else None] * len(out)
        if due:
            self.memory.put(_packed(pa.table(list(zip(*((*who, m.state, m.us, m.event_id) for who, m in remembered.items()))), schema=MEMORY)))
        if later.num_rows:
            self.waiting.put(_packed(later))
        else:
            self.waiting.clear()
        next_due = [at for m in remembered.values() if (at := self.rule.wakes_at(m)) is not None]
        if later.num_rows:
            next_due.append(pc.min(later["us"]).as_py())
        if next_due:
            self._wake(min(next_due), expiredTimerInfo.getExpiryTimeInMs())
        if fired:
            when = lambda values: pd.to_datetime(pd.Series(values), unit="us", utc=True)
            yield pd.DataFrame({
                "entity_id": pd.Series(whose, dtype="Int64"), "event_id": [f.event_id for f in fired],
                "ts": when([f.us for f in fired]), "from_state": [f.from_state for f in fired],
                "state": [f.state for f in fired], "fires_at": when([f.fires_us for f in fired])})

    def _wake(self, us: int, expired: int | None = None) -> None:
        """One timer: the earliest moment there is something to do. It goes off once the watermark is beyond it.

        An expired timer is still listed while it is handled, and taken away afterwards.
        """
        due = -(-us // 1000) - 1
        pending = [t[0] if isinstance(t, tuple) else t for t in self.handle.listTimers()]
        pending = [t for t in pending if t != expired]
        if any(t <= due for t in pending):
            return
        for t in pending:
            self.handle.deleteTimer(t)
        self.handle.registerTimer(due)

    def close(self) -> None:
        pass


def detect(stream: DataFrame, rule, delay: str, groups: int = GROUPS) -> DataFrame:
    """Run a rule over a stream of entity_id, event_id, ts, state.

    Events later than the watermark are dropped; corrections belong to ``late_upsert``. What lies beyond the watermark
    waits. A row without an event_id is a clock: it fires nothing, but time has come as far as its ts. A source that
    has ended, or is silent for long, sends one (ts: that moment plus the delay), and everything up to it is emitted.
    Needs the RocksDB state store. Entities are held by ``groups`` hashes; with very many, raise it so that the events that a
    group holds fit into a task. A checkpoint keeps the number it began with.
    """
    # Clock rows go once the watermark has seen them. The condition names ts, so Spark does not move it ahead of that.
    event = F.col("event_id").isNotNull() | F.col("ts").isNull()
    entity = F.col("entity_id")
    rows = (stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay).where(event)
                  .select(F.pmod(F.xxhash64(entity.cast("bigint")), F.lit(groups)).alias("group"),
                          F.coalesce(entity.cast("bigint"), F.lit(0)).alias("entity_id"), entity.isNotNull().alias("known"),
                          "event_id", "ts", F.unix_micros("ts").alias("us"), "state"))
    return rows.groupBy("group").transformWithStateInPandas(
        OrderedDetector(rule), FIRED_SCHEMA, "append", "eventTime")
