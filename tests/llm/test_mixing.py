import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from wattmirror.llm import mixing
from wattmirror.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free, rest = {}, set(names), sum(sizes.values())
    while free:
        level = rest / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            rest -= 3 * sizes[s]
            free.remove(s)
    return target


@pytest.mark.parametrize("sizes", [{"a": 10}, {"a": 1, "b": 1000, "c": 50, "d": 2, None: 400}, {"é": 5, "z": 5, "Z": 5},
                                   {"a": 0, "b": 0}, {"a": 0, "b": 7}, {None: 3}, {"a": 1, "b": 1, "c": 3000, "d": 1}])
def test_targets_equal_repeated_resharing(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_position_inverts_the_demand(spark):
    rows = [(s / 20, slope) for s in range(21) for slope in (-0.5, 0.0, 0.5, 0.9)]
    df = spark.createDataFrame(rows, "share double, slope double") \
        .withColumn("t", mixing.position(F.col("share"), F.col("slope")))
    for r in df.collect():
        assert (1 - r.slope) * r.t + r.slope * r.t ** 2 == pytest.approx(r.share, abs=1e-12) and 0 <= r.t <= 1


def check(rows, docs):
    sizes, taken, target = Counter(), Counter(), {}
    for doc_id, text, _, source in docs:
        sizes[source] += len(WORD.findall(text or ""))
    for r in rows:
        words = sum(v.words for v in r["__visits"])
        taken[r.source] += words
        target[r.source] = r["__target"]
        assert words <= 3 * r["__size"] and r["__source_size"] == sizes[r.source]
        assert all(0 <= v.position <= 1 and 0 < v.words <= r["__size"] for v in r["__visits"])
    assert target == pytest.approx(plain_targets(sizes))
    assert all(taken[s] == pytest.approx(target[s], abs=1) for s in target)


def test_odd_rows(spark, docs_of, odd_rows, clashes):
    docs = docs_of(odd_rows, clashes)
    rows = mixing.curriculum(docs).collect()
    assert len(rows) == len(odd_rows)
    check(rows, odd_rows)
    out = mixing.mix(docs)
    assert out.dtypes == docs.dtypes and out.count() == sum(len(r["__visits"]) for r in rows)
    words = Counter()
    for r in out.collect():
        words[r.source] += len(WORD.findall(r.text))
    taken = Counter()
    for r in rows:
        taken[r.source] += sum(v.words for v in r["__visits"])
    assert {s: n for s, n in words.items() if n} == {s: n for s, n in taken.items() if n}
    assert mixing.mix(docs.limit(0)).count() == mixing.curriculum(docs.limit(0)).count() == 0


def test_hot_source_and_reruns(spark):
    docs = [(i, "w " * (i % 17 + 1), "en", "hot" if i % 3 else f"s{i % 5}") for i in range(900)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    one = mixing.curriculum(df).collect()
    check(one, docs)
    two = mixing.curriculum(df.repartition(7)).collect()
    assert {r.doc_id: r["__visits"] for r in one} == {r.doc_id: r["__visits"] for r in two}


def test_mix_is_in_training_order_and_late_sources_come_late(spark):
    docs = [(i, "w " * 5, "en", "abc"[i % 3]) for i in range(300)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    order = [r.source for r in mixing.mix(df).collect()]
    half = len(order) // 2
    first, last = Counter(order[:half]), Counter(order[half:])
    assert first["a"] > last["a"] and first["c"] < last["c"]           # slopes of the first and third weight


def test_native_plan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = mixing.mix(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_query_meets_targets(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    sizes = Counter()
    for d in docs:
        sizes[d.source] += len(WORD.findall(d.text or ""))
    source = {d.doc_id: d.source for d in docs}
    rows = QUERIES["op3_mix_sources"](spark, sf).collect()
    want, taken = plain_targets(sizes), Counter()
    assert len(rows) == len(docs)
    for r in rows:
        taken[source[r.doc_id]] += r.taken
        assert r.target == pytest.approx(want[source[r.doc_id]]) and r.taken <= 3 * r.size
    assert all(taken[s] == pytest.approx(want[s], abs=1) for s in want)
