import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from wattmirror.llm import conversations, four_russians
from wattmirror.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
NOTHING = hashlib.sha256(b"").hexdigest()


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        def shown(x):
            return " " if x is None else str(x)
        fold = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        if fold == 0:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fold, text)
        out += [(conv, turn, "user" if fold == 4 else role, text)] * (2 if fold == 3 else 1)
    return out


def plain_faults(rows):
    """Rows of one conversation in order, each with its fault."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, out = set(), []
    for _, turn, role, text in rows:
        shown = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not shown else "duplicate" if (role, text) in seen else \
            "truncated" if shown[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def plain_best(rows):
    """The cheapest edits, then the least initials, of (initial, must delete, truncated) rows by trying every edit."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    memo = {}

    def best(i, state, inserts):
        if (i, state, inserts) in memo:
            return memo[i, state, inserts]
        options = []
        if i == len(rows):
            if state in ("", "a"):
                options.append((0, ""))
        else:
            initial, delete, cut = rows[i]
            cost, audit = best(i + 1, state, 0)
            options.append((cost + 3, "D" + audit))
            if not delete:
                if initial == after[state] or (initial == "s" and state == ""):
                    cost, audit = best(i + 1, initial, 0)
                    options.append((cost + cut, "K" + audit))
                cost, audit = best(i + 1, after[state], 0)
                options.append((cost + cut + 2, "R" + audit))
        if inserts < 4:
            cost, audit = best(i, after[state], inserts + 1)
            options.append((cost + 2, "I" + audit))
        memo[i, state, inserts] = min(options, default=(10 ** 9, ""))
        return memo[i, state, inserts]

    for i in range(len(rows), 0, -200):          # from behind, so that no recursion is deep
        for state in after:
            best(i, state, 0)
    return best(0, "", 0)


def plain_report(rows, ids):
    out = {}
    for conv in set(ids):
        own = plain_faults([r for r in rows if r[0] == conv])
        turns = [t for t, *_ in own if t is not None]
        initials = [role[:1] for _, role, _, _ in own]
        cost, audit = plain_best([(role[:1], fault in ("blank", "duplicate"), fault == "truncated") for _, role, _, fault in own])
        said, state, rest = [], "", iter(own)
        for edit in audit:
            row = None if edit == "I" else next(rest)
            if edit == "D":
                continue
            state = row[1][:1] if edit == "K" else {"": "u", "s": "u", "u": "a", "a": "u"}[state]
            said.append(f"{row[1]}:{row[2]}" if edit == "K" else
                        f"{ {'u': 'user', 'a': 'assistant'}[state]}:{row[2] if row else ''}")
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in said))
        faults = [f for *_, f in own]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"),
                     faults.count("duplicate"), faults.count("truncated"),
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
                     hashlib.sha256("\n".join(said).encode()).hexdigest())
    return out


def answers(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def test_every_short_sequence_is_repaired_as_by_trying_every_edit():
    own, kinds = four_russians.tables(), [(i, False, t) for i in "suax" for t in (False, True)] + [("u", True, False)]
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            signs = bytes(8 if d else four_russians.symbol(i, t) for i, d, t in rows)
            edits, state = own.trace(signs, own.number[four_russians.END], 0)
            front, added, leaves = own.summary(signs)
            end = own.number[four_russians.END]
            cost = added[end] + own.vectors[front[end]][0]
            assert (cost, "".join(edits) + four_russians.closing(state)) == plain_best(rows), rows
            assert leaves[end][0] == state


def test_long_sequences_and_split_points():
    rng, own = random.Random(5), four_russians.tables()
    end = own.number[four_russians.END]
    for _ in range(300):
        rows = [(rng.choice("suax"), rng.random() < .2, rng.random() < .3) for _ in range(rng.randint(0, 40))]
        signs = bytes(8 if d else four_russians.symbol(i, t) for i, d, t in rows)
        edits, state = own.trace(signs, end, 0)
        assert "".join(edits) + four_russians.closing(state) == plain_best(rows)[1]
        k = rng.randint(0, len(signs))
        front, added, _ = own.summary(signs[k:])
        left, middle = own.trace(signs[:k], int(front[end]), 0)
        assert middle == own.summary(signs[:k])[2][front[end]][0]
        assert left + own.trace(signs[k:], end, middle)[0] == edits


def random_turns(rng, conversations_, most):
    roles, texts = ["user", "assistant", "system", "tool", "", None, "a"], ["Hi.", "Yes!", "No", " \n", "", None, "ü? ", "Hi."]
    rows = []
    for conv in range(conversations_):
        n = rng.randint(1, most)
        rows += [(conv, rng.choice([None, i, i, i + 1, 2 * i]), rng.choice(roles[:4] if rng.random() < .8 else roles),
                  rng.choice(texts + [f"t{rng.randrange(9)}{e}" for e in ("", ".", "!")])) for i in range(n)]
    return rows


@pytest.mark.parametrize("segment", [2, 4096])
def test_report_equals_brute_force(spark, segment):
    rows = random_turns(random.Random(segment), 60, 25)
    turns = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = answers(conversations.report(conversations.damage(turns), turns, segment))
    damaged = plain_damage(rows)
    assert got == plain_report(damaged, [r[0] for r in rows])


def test_one_conversation_with_most_turns_lies_over_several_tasks(spark):
    rng = random.Random(3)
    rows = [(1, i, rng.choice(["user", "assistant"]), f"t{rng.randrange(1100)}.") for i in range(1500)] + \
        [(1, 5, "user", "again.")] * 500 + random_turns(rng, 8, 5)
    turns = spark.createDataFrame(rows, SCHEMA).repartition(8)
    ordered = conversations._cut(conversations._ordered(conversations._keyed(turns)), 100).where("conv_id = 1")
    assert ordered.select("part").distinct().count() > 1
    got = answers(conversations.report(turns, turns, 100))
    shown = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert got == plain_report(shown, [r[0] for r in rows])


def test_repaired_turns_are_rows(spark):
    turns = spark.createDataFrame([(1, 0, "assistant", "A."), (1, 1, "user", "B."), (1, 2, "user", "B.")], SCHEMA)
    edits, measures = conversations.repair(turns)
    got = [tuple(r) for r in edits.orderBy("part", "seg", "place").select("edit", "count", "role", "text").collect()]
    assert got == [("I", 1, "user", ""), ("K", 1, "assistant", "A."), ("K", 1, "user", "B."), ("D", 1, None, None),
                   ("I", 1, "assistant", "")]
    assert measures.first()["cost"] == 7


def test_nulls_empties_and_clashes(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.report(conversations.damage(empty), empty).count() == 0
    rows = [(None, None, None, None), (None, None, None, None), (7, None, "user", "x" * 300_000 + "."), (8, 1, "system", "S.")]
    turns = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS key", "1 AS sign", "'y' AS same", "2 AS part", "3 AS copies")
    got = answers(conversations.report(turns, turns))
    assert got == plain_report([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows], [None, 7, 8])
    none = spark.createDataFrame([(9, 0, "user", "x")], SCHEMA)
    assert answers(conversations.report(empty, none)) == {9: (0, 0, 0, 0, 0, 0, "", NOTHING)}


def test_query_equals_brute_force(spark):
    out = QUERIES["op13_conversation_repair"](spark, "/root/testdata/sf0.01")
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint"] * 7 + ["string"] * 2
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert answers(out) == plain_report(plain_damage(rows), [r[0] for r in rows])
    assert out.where(F.col("cost") > 0).count() > 10
