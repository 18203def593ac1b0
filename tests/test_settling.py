import random
import sys
import time
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from plain_walk import walk  # noqa: E402
from wattmirror.operators import flows as fl  # noqa: E402
from wattmirror.operators import settling  # noqa: E402
from wattmirror.plans.components import components  # noqa: E402


def graph(rng, edges, nodes, kinds, linked):
    """Columns of a random graph in which any node may be parent and child."""
    kind = {f"n{i}": rng.choice(kinds) for i in range(nodes)}
    value = {n: None if rng.random() < .1 else float(rng.randrange(-3, 30)) for n in kind}
    extra = {n: float(rng.randrange(-9, 9)) if linked and rng.random() < .5 else None for n in kind}
    pairs = [rng.sample(sorted(kind), 2) for _ in range(edges)]
    p, c = [a for a, _ in pairs], [b for _, b in pairs]
    caps = [float(rng.randrange(-2, 15)) if rng.random() < .3 else None for _ in pairs]
    return [p, c, [kind[x] for x in p], [kind[x] for x in c], [value[x] for x in p], [value[x] for x in c], caps,
            [extra[x] for x in p], [extra[x] for x in c]]


MIXED = ["entity", "entity", "passthrough", fl.REMAINING_PARENT, fl.REMAINING_CHILD]


@pytest.mark.parametrize("kinds", [["entity"], MIXED])
@pytest.mark.parametrize("pays", [0, 64, 1 << 40])
def test_waves_equal_the_plain_walk(monkeypatch, kinds, pays):
    """With PAYS at 0 all edges are settled in waves, at its largest nearly all singly."""
    monkeypatch.setattr(settling, "PAYS", pays)
    rng = random.Random(11)
    for k in range(1500):
        columns = graph(rng, rng.randint(1, 24), rng.randint(2, 9), kinds, k % 2)
        assert fl._settle(*columns) == walk(*columns), columns


def test_graphs_of_one_batch_do_not_mix():
    rng = random.Random(2)
    graphs = [graph(rng, rng.randint(1, 12), 6, MIXED, True) for _ in range(60)]
    together = [sum((g[i] for g in graphs), []) for i in range(9)]
    number = np.repeat(np.arange(60), [len(g[0]) for g in graphs])
    assert settling.Graphs(number, *together).flows().tolist() == [x for g in graphs for x in walk(*g)]


def test_many_edges_are_settled_in_few_waves(monkeypatch):
    waves = []
    settle = settling.Graphs._settle
    monkeypatch.setattr(settling.Graphs, "_settle", lambda self, *a: (waves.append(len(a[0])), settle(self, *a))[1])
    monkeypatch.setattr(settling.Graphs, "_singly", None)
    p = [f"p{i // 1000}" for i in range(200_000)]
    c = [f"c{(i * 7919) % 90_000}" for i in range(200_000)]
    rng = random.Random(1)
    value = {n: float(rng.randrange(1000)) for n in {*p, *c}}
    columns = [p, c, ["entity"] * len(p), ["entity"] * len(p), [value[x] for x in p], [value[x] for x in c], [None] * len(p)]
    assert fl._settle(*columns) == walk(*columns)
    assert len(waves) < 30


def test_a_long_chain_takes_time_in_proportion():
    """Every edge waits for the one before: waves would settle one edge each."""
    def seconds(n):
        columns = [[f"a{i // 2}" for i in range(n)], [f"b{(i + 1) // 2}" for i in range(n)], ["entity"] * n, ["entity"] * n,
                   [3.0] * n, [2.0] * n, [None] * n]
        began = time.perf_counter()
        assert fl._settle(*columns) == walk(*columns)
        return time.perf_counter() - began
    assert seconds(100_000) < 60 * max(seconds(10_000), 0.05)


def test_batches_may_cut_graphs_anywhere():
    rng, rows = random.Random(4), []
    for s in range(8):
        for g in ("", "x", "y")[:1 + s % 3]:
            own = graph(rng, rng.randint(1, 7), 5, MIXED, True)
            rows += [(s, g, i, *[col[i] for col in own]) for i in range(len(own[0]))]
    frame = pd.DataFrame(rows, columns=["snapshot_at", "graph", "edge_no", *fl._TOLD])
    whole = pd.concat(fl._settle_snapshots(iter([frame])), ignore_index=True)
    for _ in range(30):
        cuts = sorted(rng.sample(range(len(frame)), 9))
        pieces = [frame.iloc[a:b] for a, b in zip([0, *cuts], [*cuts, len(frame)])]
        pd.testing.assert_frame_equal(pd.concat(fl._settle_snapshots(iter(pieces)), ignore_index=True), whole)


def test_components_equal_union_find(spark):
    rng = random.Random(8)
    rows = [(s, f"n{rng.randrange(40)}", f"n{rng.randrange(40)}") for s in range(5) for _ in range(rng.choice([5, 20, 40]))]
    rows += [(9, f"k{i:04}", f"k{i + 1:04}") for i in range(200)] + [(10, "hub", f"x{i}") for i in range(500)] + [(11, "a", "a")]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for s, a, b in rows:
        a, b = sorted([find((s, a)), find((s, b))])
        root[b] = a
    got = components(spark.createDataFrame(rows, "s int, a string, b string"), ["s"], "a", "b").collect()
    assert {(r["s"], r["node"]): r["root"] for r in got} == {x: find(x)[1] for x in root} and len(got) == len(root)
    assert components(spark.createDataFrame([], "s int, a string, b string"), ["s"], "a", "b").count() == 0


def test_one_large_snapshot_spreads_over_tasks(spark):
    """A snapshot with most of the edges in many components: no task holds more than a part of it, and nothing changes."""
    n = 60_000
    edges = spark.range(n).selectExpr("1 AS snapshot_at", "id AS edge_no", "concat('p', id div 6) AS parent",
                                      "concat('c', id div 6, '-', id % 4) AS child", "CAST(NULL AS DOUBLE) AS cap") \
        .unionByName(spark.range(40).selectExpr("2 AS snapshot_at", "id AS edge_no", "concat('p', id % 3) AS parent",
                                                "concat('c', id % 4, '-') AS child", "2.0D AS cap"))
    nodes = edges.selectExpr("snapshot_at", "explode(array(parent, child)) AS node").distinct() \
        .selectExpr("*", "'entity' AS kind", "CAST(abs(hash(node)) % 20 AS DOUBLE) AS value")
    told = [nodes.selectExpr("snapshot_at", f"node AS {x}", f"kind AS {x}_kind", f"value AS {x}_value") for x in ("parent", "child")]
    shared = edges.join(told[0], ["snapshot_at", "parent"]).join(told[1], ["snapshot_at", "child"])
    grouped = fl._graphs(shared, 1000)
    assert grouped.where("snapshot_at = 2").select("graph").distinct().count() == 1
    dealt = grouped.repartition(8, "snapshot_at", "graph").groupBy(F.spark_partition_id()).count()
    assert dealt.agg(F.max("count")).first()[0] < n / 4
    one, many = (fl._allocate_shared(shared, most) for most in (10 * n, 1000))
    assert one.count() == n + 40 and one.exceptAll(many).count() == 0


def test_graphs_of_one_shape_are_walked_once(monkeypatch):
    walks = []
    plain = settling.waiting_order
    monkeypatch.setattr(settling, "waiting_order", lambda *a: (walks.append(1), plain(*a))[1])
    rng = random.Random(3)
    shapes = [graph(rng, 6, 4, MIXED, True) for _ in range(3)]
    graphs = [shapes[i % 3] for i in range(60)]
    number = np.repeat(np.arange(60), 6)
    together = [[x for g in graphs for x in g[k]] for k in range(9)]
    assert settling.Graphs(number, *together).flows().tolist() == [x for g in graphs for x in walk(*g)]
    assert len(walks) <= 3
