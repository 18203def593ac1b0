"""Repairing the turn structure of conversations: the cheapest edits to system?, then user and assistant in turns.

Turns are classified and put in order as narrow rows without texts. The order is made by range partitioning, so a very
long conversation lies over several tasks; it is cut into segments, each summed up by Four-Russians block tables. A
conversation's segments are then chained (a few numbers each), which tells every segment the costs behind it and the
state before it, and the segments are traced apart from each other. Texts join the edits last.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattmirror.llm.common import pin, typed
from wattmirror.llm.four_russians import (AFTER, END, MUST_DELETE, OTHER, ROLE_OF, START, SYMBOLS, closing, tables)

FOLDS = 20                     # of the damage that the registered query does
DROPPED, EMPTIED, STRIPPED, REPEATED, MISLABELLED = range(5)
SPACE = r"\x20\x09-\x0D"
SEGMENT = 4096                 # turns of a segment
HEAD = 64                      # characters of role and text that order turns of one number

_CUT = """conv_id long, part int, seg long, signs binary, keys array<binary>, copies array<long>, first string, last string,
illegal long, blank long, duplicate long, truncated long, low long, high long, turns long, deleted long, front binary,
added binary, leaves binary"""
_SOLVED = """conv_id long, part int, seg long, behind int, state int, is_last boolean, gaps long, blank long, duplicate long,
truncated long, illegal long, cost long"""
_EDITS = "conv_id long, part int, seg long, place long, edit string, count long, role string, key binary"
_DIGEST = "conv_id long, audit string, repaired_sha256 string"
_ARROW = {"array<binary>": pa.list_(pa.binary())}


def _schema(ddl: str) -> pa.Schema:
    own = {name: kind for name, kind in (part.split() for part in ddl.split(",")) if kind in _ARROW}
    plain = typed(",".join(p if p.split()[0] not in own else f"{p.split()[0]} binary" for p in ddl.split(",")))
    return pa.schema([(f.name, _ARROW[own[f.name]] if f.name in own else f.type) for f in plain])


def damage(turns: DataFrame) -> DataFrame:
    """Turns with the faults that the contract plants by crc32 of `conv_id:turn`; nulls become one space first."""
    def shown(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fold = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % FOLDS
    text = F.when(F.col("fold") == EMPTIED, "").when(F.col("fold") == STRIPPED, F.regexp_replace(shown("text"), "[.!?]", "")) \
        .otherwise(shown("text"))
    rows = turns.select("conv_id", "turn", "role", "text", fold.alias("fold")).where(F.col("fold") != DROPPED)
    return rows.select("conv_id", "turn", F.when(F.col("fold") == MISLABELLED, "user").otherwise(shown("role")).alias("role"),
                       text.alias("text"),
                       F.explode(F.sequence(F.lit(1), F.when(F.col("fold") == REPEATED, 2).otherwise(1))).alias("copy")).drop("copy")


def _keyed(turns: DataFrame) -> DataFrame:
    """Rows with `same` (digest of conversation, role and text) and `key` (that and the turn)."""
    def shown(name):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), shown("role").alias("role"),
                        shown("text").alias("text"))
    said = F.concat_ws(":", shown("conv_id"), F.length("role").cast("string"), "role", "text")
    return rows.withColumn("same", F.unhex(F.sha2(said, 256))) \
        .withColumn("key", F.unhex(F.sha2(F.concat_ws(":", shown("turn"), said), 256)))


def _ordered(rows: DataFrame) -> DataFrame:
    """One row per different turn, without its text, in order over range partitions."""
    initial = F.substring("role", 1, 1)
    classes = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    narrow = pin(rows.groupBy("key", "same", "conv_id", "turn", F.substring("role", 1, HEAD).alias("role"),
                              F.substring("text", 1, HEAD).alias("head"), classes.alias("class"), blank.alias("blank"),
                              (~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")).alias("truncated"))
                 .agg(F.count("*").alias("copies")), "turns")
    first = pin(narrow.groupBy("same").agg(F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("unset")),
                "firsts")
    later = F.when(F.col("unset"), F.col("turn").isNotNull()).otherwise(F.col("turn") != F.col("first"))
    deleted = F.col("blank") | F.col("later")
    joined = narrow.join(first, "same").withColumn("later", later).select(
        "conv_id", "turn", "role", "head", "key", "copies", "blank", "later",
        (~deleted & F.col("truncated")).alias("truncated"), F.substring("role", 1, 1).alias("initial"),
        F.when(deleted, MUST_DELETE).otherwise(2 * F.col("class") + F.col("truncated").cast("int")).alias("sign"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "turn", "role", "head"]
    return joined.repartitionByRange(parts, *order).sortWithinPartitions(*order, "key")


def _segment(rows: list[dict], part: int, seg: int) -> dict:
    """What the chain needs to know of consecutive turns of one conversation."""
    signs = bytes(r["sign"] for r in rows)
    front, added, leaves = tables().summary(signs)
    illegal = blank = duplicate = truncated = deleted = distinct = 0
    low = high = None
    before = None
    for r in rows:
        own, extra = r["initial"], r["copies"] - 1
        illegal += (before is not None and before + own not in ("su", "ua", "au")) + extra * (own + own not in ("su", "ua", "au"))
        before = own
        blank += r["copies"] if r["blank"] else 0
        duplicate += 0 if r["blank"] else (r["copies"] if r["later"] else extra)
        truncated += r["truncated"]
        deleted += extra
        if r["turn"] is not None:
            distinct += r["turn"] != high
            low, high = r["turn"] if low is None else low, r["turn"]
    return {"conv_id": rows[0]["conv_id"], "part": part, "seg": seg, "signs": signs, "keys": [r["key"] for r in rows],
            "copies": [r["copies"] for r in rows], "first": rows[0]["initial"], "last": before, "illegal": illegal,
            "blank": blank, "duplicate": duplicate, "truncated": truncated, "low": low, "high": high, "turns": distinct,
            "deleted": deleted, "front": front.astype(np.uint8).tobytes(), "added": added.astype("<i8").tobytes(),
            "leaves": leaves.astype(np.uint8).tobytes()}


def _cut(rows: DataFrame, segment: int) -> DataFrame:
    schema = _schema(_CUT)

    def run(batches):
        part, seg, held, made = TaskContext.get().partitionId(), 0, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["conv_id"] != held[0]["conv_id"] or len(held) >= segment):
                    made.append(_segment(held, part, seg))
                    seg, held = seg + 1, []
                held.append(row)
            if made:
                yield pa.RecordBatch.from_pylist(made, schema=schema)
                made = []
        if held:
            yield pa.RecordBatch.from_pylist([_segment(held, part, seg)], schema=schema)

    return rows.select("conv_id", "turn", "key", "copies", "blank", "later", "truncated", "initial", "sign") \
        .mapInArrow(run, _CUT)


def _chain(segments: list[dict]) -> list[dict]:
    """For the segments of a conversation: the costs behind each, the state before it; with the last one, the totals."""
    own = tables()
    v, cost, behind = own.number[END], 0, []
    for s in reversed(segments):
        behind.append(v)
        cost += int(np.frombuffer(s["added"], dtype="<i8")[v]) + 3 * s["deleted"]
        v = s["front"][v]
    cost += own.vectors[v][START]
    state, out = START, []
    for s, v in zip(segments, reversed(behind)):
        out.append({"conv_id": s["conv_id"], "part": s["part"], "seg": s["seg"], "behind": v, "state": state, "is_last": False})
        state = s["leaves"][4 * v + state]
    known = [s for s in segments if s["low"] is not None]
    joints = list(zip(segments, segments[1:]))
    gaps = known[-1]["high"] - known[0]["low"] + 1 - sum(s["turns"] for s in known) \
        + sum(a["high"] == b["low"] for a, b in zip(known, known[1:])) if known else 0
    illegal = sum(s["illegal"] for s in segments) + sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in joints)
    out[-1] |= {"is_last": True, "gaps": gaps, "illegal": illegal, "cost": cost,
                **{c: sum(s[c] for s in segments) for c in ("blank", "duplicate", "truncated")}}
    return out


def _by_conversation(df: DataFrame, order: list[str], begin, take, end, ddl: str) -> DataFrame:
    """Go through each conversation's rows in order: begin() makes its record, take(record, row), end(record) gives rows."""
    schema = _schema(ddl)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches):
        now, own, made = None, None, []
        for batch in batches:
            for row in batch.to_pylist():
                if now is None or row["conv_id"] != own:
                    made += end(own, now) if now is not None else []
                    now, own = begin(), row["conv_id"]
                take(now, row)
            if made:
                yield pa.RecordBatch.from_pylist(made, schema=schema)
                made = []
        if now is not None:
            yield pa.RecordBatch.from_pylist(end(own, now), schema=schema)

    return df.repartition(parts, "conv_id").sortWithinPartitions("conv_id", *order).mapInArrow(run, ddl)


def _traced(segments: DataFrame) -> DataFrame:
    schema = _schema(_EDITS)

    def rows(s):
        own, state, place = tables(), s["state"], 0
        edits, left = own.trace(s["signs"], s["behind"], state)
        if s["is_last"]:
            edits = [*edits, closing(left)]
        for i, text in enumerate(edits):
            more = s["copies"][i] - 1 if i < len(s["copies"]) else 0
            for edit, count in [*((e, 1) for e in text), *([("D", more)] if more else [])]:
                role = None
                if edit == "K":
                    state = (START + 1 if state == START and s["signs"][i] // 2 == 0 else AFTER[state])
                elif edit != "D":
                    state = AFTER[state]
                    role = ROLE_OF[state]
                yield {"conv_id": s["conv_id"], "part": s["part"], "seg": s["seg"], "place": place, "edit": edit,
                       "count": count, "role": role, "key": s["keys"][i] if edit in "KR" else None}
                place += 1

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                for s in batch.slice(i, 1).to_pylist():
                    yield pa.RecordBatch.from_pylist(list(rows(s)), schema=schema)

    return segments.mapInArrow(run, _EDITS)


def repair(turns: DataFrame, segment: int = SEGMENT) -> tuple[DataFrame, DataFrame]:
    """The edits of every conversation, and its measures.

    turns: conv_id and turn (whole numbers), role, text; further columns are not read. Null roles and texts read as one
    space; a null conv_id is a conversation of its own, null turns come first. Turns of one number are ordered by the
    first HEAD characters of role and of text, then by digest; repeated rows are adjacent. Texts of any length are read
    whole where they are judged and joined. An empty table gives no rows.

    Edits, in order of (conv_id, part, seg, place): edit (K, R, D, I), count (of D for repeated rows), role and text of
    the repaired turn (null where deleted). Measures: one row per conversation with gaps, blank, duplicate, truncated,
    illegal and cost. A conversation's turns lie over several tasks; only its segments' summaries, about 250 bytes for
    `segment` turns, come together in one.
    """
    rows = _keyed(turns)
    cut = pin(_cut(_ordered(rows), segment), "segments")
    chain = _by_conversation(cut.drop("signs", "keys", "copies"), ["part", "seg"], list, list.append,
                             lambda own, held: _chain(held), _SOLVED)
    chained = pin(chain, "chained")
    held = cut.select("conv_id", "part", "seg", "signs", "keys", "copies") \
        .join(chained.select("part", "seg", "behind", "state", "is_last"), ["part", "seg"])
    edits = pin(_traced(held), "edits")
    said = rows.groupBy("key").agg(F.first("role").alias("own"), F.first("text").alias("text"))
    spoken = edits.where("edit IN ('K', 'R')").join(said, "key").select(
        *[c for c in edits.columns if c not in ("key", "role")], F.coalesce("role", "own").alias("role"), "text")
    others = edits.where("edit IN ('D', 'I')").select(
        *[c for c in edits.columns if c not in ("key", "role")], "role", F.when(F.col("edit") == "I", "").alias("text"))
    return spoken.union(others), chained.where("is_last").select("conv_id", "gaps", "blank", "duplicate", "truncated",
                                                                 "illegal", "cost")


class _Said:
    """The audit and the digest of a conversation so far; the digest needs its turns one after the other."""

    def __init__(self):
        self.audit, self.digest, self.begun = [], hashlib.sha256(), False

    def take(self, row: dict) -> None:
        self.audit.append(row["edit"] * row["count"])
        if row["edit"] != "D":
            self.digest.update((("\n" if self.begun else "") + f"{row['role']}:{row['text']}").encode("utf-8"))
            self.begun = True


def digests(edits: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256) from edits: the initials, and the sha256 of the repaired `role:text` lines."""
    return _by_conversation(edits, ["part", "seg", "place"], _Said, _Said.take,
                            lambda own, said: [{"conv_id": own, "audit": "".join(said.audit),
                                                "repaired_sha256": said.digest.hexdigest()}], _DIGEST)


def report(turns: DataFrame, ids: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Measures, audit and digest for every conv_id of `ids`; zeros, an empty audit and the digest of nothing where
    `turns` has no rows of it. ids may repeat ids and hold null."""
    edits, measures = repair(turns, segment)
    every = ids.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    known = measures.join(digests(edits).withColumnRenamed("conv_id", "own"), F.col("conv_id").eqNullSafe(F.col("own"))) \
        .drop("own").withColumnRenamed("conv_id", "own")
    nothing = hashlib.sha256().hexdigest()
    return every.join(known, F.col("conv_id").eqNullSafe(F.col("own")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
