import numpy as np

from wattmirror.llm import ann
from wattmirror.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(ids, rows, query, k):
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    score = unit @ unit[query]
    keep = [i for i in range(len(ids)) if ids[i] != ids[query]]
    return [(ids[i], score[i]) for i in sorted(keep, key=lambda i: (-round(score[i], 12), ids[i]))[:k]]


def points_of(spark, rows, start=0):
    return spark.createDataFrame([(start + i, [float(x) for x in r], 0) for i, r in enumerate(rows)], SCHEMA)


def test_recall_on_clusters_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 1, (40, 16))
    rows = (centres[rng.integers(0, 40, 6000)] + rng.normal(0, 0.3, (6000, 16))).astype(np.float32).astype(float)
    points = ann.usable(points_of(spark, rows))
    got = {}
    for r in ann.search(points, points.where("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, []).append(r)
    ids = list(range(6000))
    hit = 0
    for q, own in got.items():
        own.sort(key=lambda r: r.rank)
        assert [r.rank for r in own] == [1, 2, 3, 4, 5]
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        for r in own:
            a, b = rows[q], rows[r.vec_id]
            assert abs(r.score - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12
        hit += len({r.vec_id for r in own} & {i for i, _ in plain(ids, rows, q, 5)})
    assert len(got) == 120 and hit >= 0.9 * 600


def test_tree_finds_all_with_all_visits():
    rng = np.random.default_rng(2)
    rows = rng.normal(0, 1, (700, 8))
    tree = ann.fit(rows)
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    assert sorted(tree.visits(unit[3], tree.leaves)) == list(range(tree.leaves))
    leaf = tree.leaf_of(unit)
    first = [tree.visits(u, 1)[0] for u in unit[:200]]
    assert np.mean(np.array(first) == leaf[:200]) > 0.6


def test_very_common_vector_is_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 64)
    rng = np.random.default_rng(3)
    rows = rng.normal(0, 1, (900, 6)).astype(np.float32).astype(float)
    rows[::3] = rows[0]
    points = ann.usable(points_of(spark, rows))
    got = {}
    for r in ann.search(points, points.where("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for q in (0, 150, 300):                                     # queries with that vector: ties to smaller ids
        same = [i for i in range(0, 900, 3) if i != q][:5]
        assert [i for _, i in sorted(got[q])] == same


def test_equal_vectors_tie_in_64_dimensions_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 64)
    rng = np.random.default_rng(4)
    rows = rng.normal(0, 1, (1200, 64))
    rows[::3] = rows[0]
    near = [i for i in range(0, 1200, 50) if i % 3]             # queries close to that vector
    rows[near] = rows[0] + rng.normal(0, 0.3, (len(near), 64))
    rows = rows.astype(np.float32).astype(float)
    points = ann.usable(points_of(spark, rows))
    got = {}
    for r in ann.search(points, points.where("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert len(got) == 24
    for q, own in got.items():
        assert [i for _, i, _ in sorted(own)] == [i for i in range(0, 1200, 3) if i != q][:5]
        assert len({s for _, _, s in own}) == 1


def test_scores_do_not_depend_on_the_block():
    rng = np.random.default_rng(5)
    common, query = rng.normal(0, 1, (2, 64))
    found = set()
    for n in (1, 2, 3, 5, 8, 17, 64, 255, 1000):
        for at in sorted({0, n // 2, n - 1}):
            rows = rng.normal(0, 0.01, (n, 64)) - query
            rows[at] = common
            own = ann._best(np.array([-1] * 7), np.tile(query, (7, 1)), np.arange(n), rows, 1)
            assert {i for _, i, _ in own} == {at}
            found |= {s for _, _, s in own}
    assert len(found) == 1


def test_own_id_is_left_out_of_equal_vectors():
    rows = np.ones((9, 3))
    ids = np.array([4, 4, 4, 4, 4, 4, 9, 7, 4])
    got = ann._best(np.array([4, 7]), np.ones((2, 3)), ids, rows, 3)
    assert [(q, i) for q, i, _ in got] == [(4, 7), (4, 9), (7, 4), (7, 4), (7, 4)]
    assert ann._best(np.array([4]), np.ones((1, 3)), ids[:6], rows[:6], 3) == []


def test_each_vector_length_is_a_set_of_its_own(spark):
    rng = np.random.default_rng(6)
    rows = [rng.normal(0, 1, 4 if i % 7 == 0 else 6 if i == 150 else 8) for i in range(400)]
    points = ann.usable(points_of(spark, rows))
    got = {}
    for r in ann.search(points, points.where("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for q in range(0, 400, 50):
        ids = [i for i in range(400) if len(rows[i]) == len(rows[q])]
        want = plain(ids, np.array([np.float32(rows[i]) for i in ids], dtype=float), ids.index(q), 5)
        assert sorted(got.get(q, [])) == list(enumerate([i for i, _ in want], 1)) and len(want) == 5 * (q != 150)


def test_walks_go_on_until_k_rows_are_held(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF_SAMPLE", 1)                  # leaves of one row each, four visits
    rng = np.random.default_rng(7)
    rows = rng.normal(0, 1, (300, 8))
    points = ann.usable(points_of(spark, rows))
    copies = points.where("vec_id = 50").crossJoin(spark.range(30)).select("vec_id", "v")
    for table in (points, points.union(copies)):                # the own id of a query is no candidate, however often
        asked = table.where("vec_id % 50 = 0").dropDuplicates(["vec_id"])
        got = {}
        for r in ann.search(table, asked, 5, aim=0.0).collect():
            got.setdefault(r.query_id, []).append(r.vec_id)
        assert sorted(map(len, got.values())) == [5] * 6 and all(q not in own for q, own in got.items())


def test_empty_leaves_do_not_end_a_walk():
    rng = np.random.default_rng(8)
    tree = ann.fit(rng.normal(0, 1, (30_000, 4)))
    walk = tree.visits(np.array([1.0, 0, 0, 0]), tree.leaves)
    assert len(walk) > 100
    held = {x: 2 for x in walk[90:]}
    assert ann._reached(tree, held, np.array([1.0, 0, 0, 0]), 4, 3) == walk[90:94]
    assert ann._reached(tree, held, np.array([1.0, 0, 0, 0]), 1, 5) == walk[90:93]
    assert ann._reached(tree, {walk[-1]: 1}, np.array([1.0, 0, 0, 0]), 4, 6) == walk[-1:]


def test_queries_of_a_leaf_are_cut_into_parts(spark, monkeypatch):
    rng = np.random.default_rng(9)
    points = ann.usable(points_of(spark, rng.normal(0, 1, (1500, 6))))
    asked = points.where("vec_id % 3 = 0")

    def found():
        return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in ann.search(points, asked).collect())

    whole, groups, deal = found(), [], ann._dealt
    monkeypatch.setattr(ann, "BLOCK", 128)
    monkeypatch.setattr(ann, "ASKED", 32)

    def watched(*given):
        left, right = deal(*given)
        for side, most in ((left, 32), (right, 128)):
            groups.append(max(r["count"] for r in side.groupBy("leaf", "block", "part").count().collect()) / most)
        return left, right

    monkeypatch.setattr(ann, "_dealt", watched)
    assert found() == whole and len(whole) == 2500
    assert max(groups) < 2


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (50, [0.0, 1.0], 1), (1, None, 1), (2, [0.0, 0.0], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1),
            (5, [None, 1.0], 1), (6, [1.0, 1.0], 1), (7, [1.0, 1.0], 2), (7, [1.0, 1.0], 2), (None, [1.0, 0.0], 1), (8, [], 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS leaf", "'x' AS score", "2 AS v", "3 AS block")
    points = ann.usable(df)
    assert sorted(r.vec_id for r in points.collect()) == [0, 6, 7, 7, 50]
    got = sorted((r.query_id, r.rank, r.vec_id) for r in ann.search(points, points.where("vec_id % 50 = 0")).collect())
    assert got == [(0, 1, 6), (0, 2, 7), (0, 3, 7), (0, 4, 50), (50, 1, 6), (50, 2, 7), (50, 3, 7), (50, 4, 0)]
    assert ann.search(points.limit(0), points.limit(0)).count() == 0
    assert ann.search(points, points.limit(0)).count() == 0
    alone = points.where("vec_id = 0")
    assert ann.search(alone, alone).count() == 0


def test_query_recall(spark):
    sf = "/root/testdata/sf0.01"
    table = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    ids, rows = [i for i, _ in table], np.array([v for _, v in table], dtype=float)
    got = {}
    for r in QUERIES["op5_nearest_neighbours"](spark, sf).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = sum(len(got[ids[q]] & {i for i, _ in plain(ids, rows, q, 5)}) for q in range(len(ids)) if ids[q] % 50 == 0)
    assert hit >= 0.9 * 5 * len(got)
