"""Nearest neighbours by cosine with a hierarchical k-means tree.

The tree is fitted on a bounded sample of the rows; every row is then put into a leaf. A query walks the tree best
bin first: a priority queue holds branches by their closeness, and leaves are visited in that order. How many leaves
suffice is calibrated: sample queries are compared with all rows, and visits are widened until the recall aimed at
is reached; a walk goes on while its leaves hold fewer rows than asked for. Leaves with many rows, and the queries of
a leaf, are cut into blocks; a group compares one block of rows with one of queries.
"""

from __future__ import annotations

import functools
import heapq
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattmirror.llm.common import pin

SAMPLE = 16_384                 # rows the tree is fitted on, those of least vec_id hash
BRANCH, LEAF_SAMPLE = 8, 256    # children of a node; a node with at most so many sample rows is a leaf
BLOCK = 4_096                   # rows of a leaf that one group compares, on average
ASKED = 16_384                  # queries of a leaf that one group compares, on average
PROBES, AIM = 96, 0.97          # calibrating queries, and the recall they have to reach
SEED = 5
ROWS = 2_048                    # rows of one matrix product
MARGIN = 1e-9                   # cosines this close to the k-th are scored anew; far above the noise of a product


@dataclass
class Tree:
    """Nodes in arrays: unit centre, first child and number of children (0: a leaf), number of the leaf."""
    centre: np.ndarray
    child: np.ndarray
    count: np.ndarray
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int((self.leaf >= 0).sum())

    def leaf_of(self, unit: np.ndarray) -> np.ndarray:
        """The leaf that each row falls into, from the root down to the closest child."""
        node = np.zeros(len(unit), dtype=np.int64)
        while True:
            inner = np.flatnonzero(self.count[node])
            if not inner.size:
                return self.leaf[node]
            for at in np.unique(node[inner]):
                rows = inner[node[inner] == at]
                first = self.child[at]
                near = unit[rows] @ self.centre[first:first + self.count[at]].T
                node[rows] = first + near.argmax(axis=1)

    def visits(self, unit: np.ndarray, most: int) -> list[int]:
        """The first leaves of a walk."""
        return list(itertools.islice(self.walk(unit), most))

    def walk(self, unit: np.ndarray) -> Iterator[int]:
        """All leaves for one query, best bin first."""
        queue = [(-1.0, 0)]
        while queue:
            _, at = heapq.heappop(queue)
            if self.leaf[at] >= 0:
                yield int(self.leaf[at])
                continue
            first = int(self.child[at])
            near = self.centre[first:first + self.count[at]] @ unit
            for k, s in enumerate(near.tolist()):
                heapq.heappush(queue, (-s, first + k))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def fit(sample: np.ndarray, seed: int = SEED) -> Tree:
    """Spherical k-means, split by split. Equal rows that k-means cannot part stay in one leaf."""
    rng = np.random.default_rng(seed)
    unit = _unit(sample)
    centre, child, count, leaf = [unit.mean(axis=0)], [0], [0], [-1]
    todo, leaves = [(0, np.arange(len(unit)))], 0
    while todo:
        at, rows = todo.pop()
        label, centres = (None, None) if len(rows) <= LEAF_SAMPLE else _kmeans(unit[rows], rng)
        if label is None:
            leaf[at] = leaves
            leaves += 1
            continue
        child[at], count[at] = len(centre), len(centres)
        for k, c in enumerate(centres):
            todo.append((len(centre), rows[label == k]))
            centre.append(c)
            child.append(0)
            count.append(0)
            leaf.append(-1)
    return Tree(np.array(centre), np.array(child), np.array(count), np.array(leaf))


def _kmeans(unit: np.ndarray, rng) -> tuple[np.ndarray | None, np.ndarray | None]:
    centres = np.unique(unit[rng.choice(len(unit), min(BRANCH, len(unit)), replace=False)], axis=0)
    label = None
    for _ in range(12):
        label = (unit @ centres.T).argmax(axis=1)
        used = np.unique(label)
        if len(used) < 2:
            return None, None
        centres = np.stack([unit[label == k].mean(axis=0) for k in used])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    label = (unit @ centres.T).argmax(axis=1)
    used = np.unique(label)
    if len(used) < 2:
        return None, None
    return np.searchsorted(used, label), centres[used]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the rows that take part: a vector that is not null or empty, of finite components, not zero."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")) \
        .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)) \
        .where(~bad & F.exists("v", lambda x: x != 0.0))


def _matrix(column: pa.Array) -> np.ndarray:
    rows = len(column)
    return np.asarray(column.flatten(), dtype=np.float64).reshape(rows, -1) if rows else np.zeros((0, 1))


def _best(q_ids, q, ids, rows, k) -> list[tuple[int, int, float]]:
    """Per query its k nearest rows by cosine, ties to smaller ids, without rows of the query's own id.

    Products of whole blocks only choose candidates, as their last bits depend on the block: every vector within
    MARGIN of the k-th product is scored anew by `_scores`. Equal vectors are one candidate with all their ids.
    """
    out = []
    if not len(rows):
        return out
    rows, own_ids = _distinct(ids, rows)
    least, largest = (np.array([own[end] for own in own_ids]) for end in (0, -1))
    q_norm, norm = np.linalg.norm(q, axis=1), np.linalg.norm(rows, axis=1)
    for at in range(0, len(q), 256):
        score = (q[at:at + 256] @ rows.T) / (q_norm[at:at + 256, None] * norm[None, :])
        for i, s in enumerate(score):
            me = int(q_ids[at + i])
            keep = np.flatnonzero((least != me) | (largest != me))
            if keep.size > k:
                floor = np.partition(s[keep], keep.size - k)[keep.size - k]
                keep = keep[s[keep] >= floor - MARGIN]
            near = [(-x, v) for j, x in zip(keep.tolist(), _scores(q[at + i], rows[keep]).tolist())
                    for v in _first_ids(own_ids[j], me, k)]
            out += [(me, v, -x) for x, v in heapq.nsmallest(k, near)]
    return out


def _distinct(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The different rows, and for each the sorted ids that have it."""
    rows = np.ascontiguousarray(rows) + 0.0                                       # -0.0 becomes 0.0
    _, first, label = np.unique(rows.view(np.dtype((np.void, rows.shape[1] * 8))).ravel(),
                                return_index=True, return_inverse=True)
    order = np.lexsort((ids, label))
    return rows[first], np.split(ids[order], np.flatnonzero(np.diff(label[order])) + 1)


def _first_ids(own: np.ndarray, me: int, k: int) -> list[int]:
    """The k smallest of the sorted ids that are not `me`."""
    a, b = np.searchsorted(own, me, "left"), np.searchsorted(own, me, "right")
    return [*own[:min(a, k)].tolist(), *own[b:b + k].tolist()][:k]


def _scores(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The cosine of the query with each row, in steps that treat every row alike: equal rows get equal scores."""
    norm = np.sqrt(_sums(rows * rows)) * np.sqrt(_sums((query * query)[None, :]))
    return _sums(rows * query) / norm


def _sums(x: np.ndarray) -> np.ndarray:
    """Sums of rows by adding one half of the columns to the other, again and again.

    Only additions of whole columns, so a sum depends on its row alone and not on the other rows or the row's place.
    """
    while x.shape[1] > 1:
        half = x.shape[1] // 2
        folded = x[:, :half] + x[:, half:2 * half]
        x = np.concatenate([folded, x[:, 2 * half:]], axis=1)
    return x[:, 0]


def _pairs(out) -> pa.RecordBatch:
    q, v, s = zip(*out) if out else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())],
                                      ["query_id", "vec_id", "score"])


def brute(points: DataFrame, q_ids: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    """Each task's k nearest rows of its own for a bounded set of queries."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield _pairs(_best(q_ids, q, batch.column(0).to_numpy(), _matrix(batch.column(1)), k))

    return points.mapInArrow(run, "query_id long, vec_id long, score double")


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(points: DataFrame, queries: DataFrame, k: int = 5, aim: float = AIM) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each query, nearest first, ties to smaller vec_id.

    points and queries are results of `usable`; a row is no candidate of a query with its own vec_id. Fewer than k
    rows are returned only if fewer candidates exist. Repeated ids are rows of their own. Empty sides give no rows.
    Vectors of different lengths have no cosine: the rows of each length are a set with a tree of its own, made one
    after the other, and a query's candidates are the rows of its own length.
    The index is written to the shared folder by leaf and block; the driver holds the sample, the tree and PROBES
    queries. All rows are indexed, and leaves of any size are compared in full.
    """
    wide = F.size("v")
    lengths = [r.n for r in queries.select(wide.alias("n")).distinct().orderBy("n").collect()]
    parts = [_found(points.where(wide == n), queries.where(wide == n), n, k, aim) for n in lengths]
    parts = [part for part in parts if part is not None]
    if not parts:
        return points.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return _top(functools.reduce(DataFrame.unionAll, parts), k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _found(points: DataFrame, queries: DataFrame, wide: int, k: int, aim: float) -> DataFrame | None:
    """(query_id, vec_id, score) of every group that a query meets, where all vectors are `wide` long; not yet cut to k."""
    sample = points.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    probes = queries.orderBy(F.xxhash64("vec_id", F.lit(2)), "vec_id").limit(PROBES).collect()
    if not sample or not probes:
        return None
    tree = fit(np.array([r.v for r in sample]))

    def into_leaves(batches):
        for batch in batches:
            unit = _unit(_matrix(batch.column(1))) if batch.num_rows else np.zeros((0, wide))
            leaf = [tree.leaf_of(unit[i:i + ROWS]) for i in range(0, len(unit), ROWS)]
            leaf = np.concatenate(leaf) if leaf else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], ["vec_id", "v", "leaf"])

    placed = points.mapInArrow(into_leaves, "vec_id long, v array<double>, leaf int")
    index = pin(placed.withColumn("salt", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(1 << 20)).cast("int")), "index")
    held = {r.leaf: r["count"] for r in index.groupBy("leaf").count().collect()}
    blocks = {x: -(-n // BLOCK) for x, n in held.items()}
    repeated = index.groupBy("vec_id").agg(F.count("*").alias("own")).where("own > 1")
    counted = queries.join(repeated, "vec_id", "left").select("vec_id", "v", F.coalesce("own", F.lit(1)).alias("own"))
    most = _calibrate(index, tree, blocks, probes, k, aim)

    def walk(batches):
        for batch in batches:
            rows, leaf = [], []
            unit = _unit(_matrix(batch.column(1))) if batch.num_rows else []
            for i, (u, own) in enumerate(zip(unit, batch.column(2).to_pylist())):
                reached = _reached(tree, held, u, most, k + own)
                rows += [i] * len(reached)
                leaf += reached
            own = batch.select(["vec_id", "v"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(leaf, pa.int32())], ["vec_id", "v", "leaf"])

    asked = counted.mapInArrow(walk, "vec_id long, v array<double>, leaf int")
    parts = dict.fromkeys(held, 1)
    if queries.count() > ASKED:
        parts |= {r.leaf: -(-r["count"] // ASKED) for r in asked.groupBy("leaf").count().collect()}
    left, right = _dealt(asked, index, blocks, parts)

    def compare(key, left, right):
        if not left.num_rows or not right.num_rows:
            return _table([])
        return _table(_best(left["vec_id"].to_numpy(), _matrix(left["v"].combine_chunks()), right["vec_id"].to_numpy(),
                            _matrix(right["v"].combine_chunks()), k))

    def _table(out):
        return pa.Table.from_batches([_pairs(out)])

    groups = ["leaf", "block", "part"]
    return left.groupBy(*groups).cogroup(right.groupBy(*groups)) \
        .applyInArrow(compare, "query_id long, vec_id long, score double")


def _dealt(asked: DataFrame, index: DataFrame, blocks: dict[int, int], parts: dict[int, int]) -> tuple[DataFrame, DataFrame]:
    """Queries and rows by leaf, block of rows and part of queries: every query of a leaf meets every row of it once."""
    def per_leaf(numbers):
        if max(numbers.values()) == 1:
            return F.lit(1)
        return F.element_at(F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair]), F.col("leaf"))

    def each(numbers):
        return F.explode(F.sequence(F.lit(0), per_leaf(numbers) - 1))

    left = asked.withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(3)), per_leaf(parts)).cast("int")) \
        .withColumn("block", each(blocks))
    right = index.withColumn("block", F.pmod("salt", per_leaf(blocks)).cast("int")).withColumn("part", each(parts))
    names = ["leaf", "block", "part", "vec_id", "v"]
    return left.select(*names), right.select(*names)


def _reached(tree: Tree, held: dict[int, int], unit: np.ndarray, most: int, want: int) -> list[int]:
    """The first `most` leaves of a walk that hold rows at all, and further ones until they hold `want` rows."""
    found, rows = [], 0
    for x in tree.walk(unit):
        if len(found) >= most and rows >= want:
            break
        if x in held:
            found.append(x)
            rows += held[x]
    return found


def _calibrate(index: DataFrame, tree: Tree, blocks: dict[int, int], probes, k: int, aim: float) -> int:
    """The least number of leaf visits (by doubling, then halving steps) at which the probes reach the recall aimed at.

    True neighbours come from a comparison with all rows, in blocks; for every one the rank of its leaf on the walk
    tells how many visits find it.
    """
    ids, rows = np.array([r.vec_id for r in probes]), np.array([r.v for r in probes])
    truth = _top(brute(index.select("vec_id", "v"), ids, rows, k), k).select("query_id", "vec_id")
    leaf = truth.join(index.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").collect()
    order = {}
    for i, u in zip(ids.tolist(), _unit(rows)):
        order[i] = {x: n for n, x in enumerate(y for y in tree.visits(u, tree.leaves) if y in blocks)}
    ranks = np.sort([order[r.query_id][r.leaf] for r in leaf])
    if not ranks.size:
        return 1
    most = 1
    while most < tree.leaves and (ranks < most).mean() < aim:
        most += max(1, most // 4)
    return max(most, 4)
