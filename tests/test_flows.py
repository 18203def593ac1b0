import random
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wattmirror.operators import flows as fl

NODES = "snapshot_at int, node string, kind string, value double"
EDGES = "snapshot_at int, edge_no int, parent string, child string, cap double"


def allocate(spark, nodes, edges):
    out = fl.allocate_edges(spark.createDataFrame(nodes, NODES), spark.createDataFrame(edges, EDGES))
    return {(r.snapshot_at, r.edge_no): r.flow for r in out.collect()}


def in_order(nodes, edges):
    """Plain walk over one snapshot of entities only."""
    value = {n: v for _, n, _, v in nodes}
    left_p, left_c = dict(value), dict(value)
    flow = {}
    for s, no, p, c, cap in sorted(edges, key=lambda e: e[1]):
        x = max(0.0, min(left_p[p], left_c[c], float("inf") if cap is None else cap))
        flow[(s, no)] = x
        left_p[p] -= x
        left_c[c] -= x
    return flow


@pytest.mark.parametrize("split", [False, True])
def test_entities_equal_plain_walk(spark, split):
    rng = random.Random(5)
    nodes, edges = [], []
    for s in range(40):
        names = [f"p{i}" for i in range(4)] + [f"c{i}" for i in range(9)]
        mine = [(s, n, "entity", float(rng.randrange(40))) for n in names]
        pairs = [(f"p{rng.randrange(4)}", f"c{i}") for i in range(9)]
        pairs += [(f"p{rng.randrange(4)}", f"c{rng.randrange(9)}") for _ in range(0 if s % 2 else 4)]
        pairs = list(dict.fromkeys(pairs))
        nodes += mine
        edges += [(s, i, p, c, float(rng.randrange(20)) if rng.random() < 0.2 else None) for i, (p, c) in enumerate(pairs)]
    if split:
        spark.conf.set("wattmirror.spanWidth", "2")
    try:
        got = allocate(spark, nodes, edges)
    finally:
        spark.conf.unset("wattmirror.spanWidth")
    want = {}
    for s in range(40):
        want |= in_order([n for n in nodes if n[0] == s], [e for e in edges if e[0] == s])
    assert got == want


def test_remaining_child_takes_what_is_left_even_when_listed_first(spark):
    nodes = [(1, "grid", "entity", 10.0), (1, "rest", fl.REMAINING_PARENT, None), (1, "tv", "entity", 4.0),
             (1, "lamp", "entity", 3.0)]
    edges = [(1, 0, "grid", "rest", None), (1, 1, "grid", "tv", None), (1, 2, "grid", "lamp", None)]
    assert allocate(spark, nodes, edges) == {(1, 0): 3.0, (1, 1): 4.0, (1, 2): 3.0}


def test_remaining_parent_gives_what_the_child_lacks(spark):
    nodes = [(1, "solar", "entity", 2.0), (1, "other", fl.REMAINING_CHILD, None), (1, "house", "entity", 5.0)]
    edges = [(1, 0, "other", "house", None), (1, 1, "solar", "house", None)]
    assert allocate(spark, nodes, edges) == {(1, 0): 3.0, (1, 1): 2.0}


def test_remaining_node_passes_its_sum_on(spark):
    nodes = [(1, "grid", "entity", 10.0), (1, "tv", "entity", 4.0), (1, "rest", fl.REMAINING_PARENT, None),
             (1, "known", "entity", 5.0), (1, "gone", fl.REMAINING_PARENT, None)]
    edges = [(1, 0, "grid", "tv", None), (1, 1, "grid", "rest", None), (1, 2, "rest", "known", None),
             (1, 3, "rest", "gone", None)]
    assert allocate(spark, nodes, edges) == {(1, 0): 4.0, (1, 1): 6.0, (1, 2): 5.0, (1, 3): 1.0}


@pytest.mark.parametrize("linked, got", [(None, [4.0, 6.0, 6.0]), (-2.0, [4.0, 4.0, 4.0]), (-9.0, [4.0, 0.0, 0.0]),
                                         (3.0, [4.0, 6.0, 9.0])])
def test_linked_nodes_bound_a_remaining_child(linked, got):
    """grid feeds tv, then rest takes what is left; other nodes add to rest or subtract from it, and it feeds a sink."""
    flow = fl._settle(["grid", "grid", "rest"], ["tv", "rest", "sink"], ["entity", "entity", fl.REMAINING_PARENT],
                      ["entity", fl.REMAINING_PARENT, "entity"], [10.0, 10.0, None], [4.0, None, 99.0], [None] * 3,
                      [None, None, linked], [None, linked, None])
    assert flow == got


def test_linked_nodes_bound_a_remaining_parent(spark):
    nodes = [(1, "solar", "entity", 2.0, None), (1, "other", fl.REMAINING_CHILD, None, -1.0), (1, "house", "entity", 5.0, None),
             (1, "barn", "entity", 4.0, None)]
    edges = [(1, 0, "other", "house", None), (1, 1, "solar", "house", None), (1, 2, "other", "barn", None)]
    out = fl.allocate_edges(spark.createDataFrame(nodes, NODES + ", linked double"), spark.createDataFrame(edges, EDGES))
    assert {r.edge_no: r.flow for r in out.collect()} == {0: 2.0, 1: 2.0, 2: 4.0}


def test_a_large_shared_snapshot_takes_time_in_proportion():
    """A remaining child with all edges of a snapshot: each list of rivals is gone through once."""
    def seconds(m):
        began = time.perf_counter()
        flow = fl._settle(["rest"] * m, [f"c{i % (m // 2)}" for i in range(m)], [fl.REMAINING_CHILD] * m,
                             ["entity"] * m, [None] * m, [1.0] * m, [None] * m)
        assert sum(flow) == m // 2
        return time.perf_counter() - began
    assert seconds(100_000) < 60 * max(seconds(10_000), 0.02)


def test_batches_may_cut_a_snapshot():
    import pandas as pd
    rows = pd.DataFrame({"snapshot_at": [1, 1, 1, 2], "edge_no": [0, 1, 2, 0], "parent": ["a", "b", "a", "a"],
                         "child": ["x", "x", "y", "x"], "parent_kind": "entity", "child_kind": "entity",
                         "parent_value": [3.0, 3.0, 3.0, 1.0], "child_value": [4.0, 4.0, 9.0, 5.0], "cap": None})
    whole = pd.concat(fl._settle_snapshots(iter([rows])))
    pieces = pd.concat(fl._settle_snapshots(iter([rows.iloc[:1], rows.iloc[1:1], rows.iloc[1:2], rows.iloc[2:]])))
    assert whole["flow"].tolist() == pieces["flow"].tolist() == [3.0, 1.0, 0.0, 1.0]


def test_node_value_rules(spark):
    df = spark.createDataFrame([("a", "1500", "Wh"), ("b", "-2", "kWh"), ("c", "x", "kWh"), ("d", "3", "monetary"),
                                ("e", "2", ""), ("f", "2", None), ("g", "7", "m")], "n string, value string, unit string")
    got = {r.n: (r.value, r.unit) for r in fl.node_value(df, prefix="k").collect()}
    assert got == {"a": (1.5, "kWh"), "b": (0.0, "kWh"), "c": (0.0, "kWh"), "d": (3.0, "monetary"), "e": (2.0, ""),
                   "f": (2.0, None), "g": (0.007, "km")}


def test_period_by_span():
    day = lambda n: datetime(2024, 1, 1 + n)
    assert fl.flow_period(day(0), day(2)) == "hour"
    assert fl.flow_period(day(0), day(3)) == "day"
    assert fl.flow_period(datetime(2024, 1, 1), datetime(2024, 2, 6)) == "month"


def test_sum_of_nothing_is_null(spark):
    df = spark.createDataFrame([("a", datetime(2024, 1, 1, 5), None), ("b", datetime(2024, 1, 1, 5), 2.0)],
                               "statistic_id string, start_at timestamp, change double")
    got = {r.statistic_id: r.change for r in fl.node_change(df, datetime(2024, 1, 1), datetime(2024, 1, 2)).collect()}
    assert got == {"a": None, "b": 2.0}


def test_reconcile_scales_relatives(spark):
    at = datetime(2024, 1, 1)
    nodes = spark.createDataFrame([(1, "t", 10.0, at), (1, "a", 3.0, at), (1, "b", 1.0, at)],
                                  "snapshot_at int, node string, value double, updated_at timestamp")
    edges = spark.createDataFrame([(1, "t", "a"), (1, "t", "b")], "snapshot_at int, parent string, child string")
    rules = spark.createDataFrame([(1, "t", "equal", "max")], "snapshot_at int, node string, should_be string, reconcile_to string")
    got = {r.node: r.value for r in fl.reconcile_sums(nodes, edges, rules, "children").collect()}
    assert got == {"t": 10.0, "a": 7.5, "b": 2.5}


def mixed_snapshots(spark):
    """Stars, shared edges and remaining nodes, some node rows there twice and some missing."""
    rng = random.Random(8)
    nodes, edges = [], []
    for s in range(30):
        names = [f"p{i}" for i in range(3)] + [f"c{i}" for i in range(6)]
        kinds = {n: fl.REMAINING_PARENT if n == "c5" and s % 3 == 0 else "entity" for n in names}
        nodes += [(s, n, kinds[n], float(rng.randrange(40))) for n in names if n != "c4" or s % 5]
        if s % 7 == 0:
            nodes.append((s, "c0", "entity", nodes[-1][3]))
        pairs = dict.fromkeys((f"p{rng.randrange(3)}", f"c{i % 6}") for i in range(6 if s % 2 else 9))
        edges += [(s, i, p, c, None) for i, (p, c) in enumerate(pairs)]
    nodes.append((None, "p0", "entity", 1.0))
    edges.append((None, 0, "p0", "c0", None))
    return spark.createDataFrame(nodes, NODES), spark.createDataFrame(edges, EDGES)


def test_snapshots_kept_together_equal_those_cut_by_their_nodes(spark):
    nodes, edges = mixed_snapshots(spark)
    rows = lambda df: sorted(map(tuple, df.collect()))
    told = ["kind", "value"]
    side = lambda df: sorted(map(str, df.drop("hash").select(sorted(set(df.columns) - {"hash", "alone", "alone_fed"})).collect()))
    assert side(fl._side_by_side(nodes, edges, told)) == side(fl._joined(nodes, edges, told))
    plain = nodes.dropDuplicates(["snapshot_at", "node"])
    whole = rows(fl.allocate_edges(plain, edges))
    assert whole and whole == rows(fl.allocate_edges(plain, edges, most=15)) == rows(fl.allocate_edges(plain, edges, most=1))


def test_a_small_snapshot_is_shuffled_once(spark):
    out = fl.allocate_edges(*mixed_snapshots(spark))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Join" not in plan
