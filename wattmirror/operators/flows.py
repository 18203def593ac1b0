"""Energy-flow roll-ups: residuals, node values, edge allocation, sum reconciliation.

A snapshot is one state of a flow graph: nodes with a value and ordered edges from parent to
child. Node kinds: entity (has its own value), remaining_parent (takes what its parents have
left), remaining_child (gives what its children still lack), passthrough (sums its edges).
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattmirror.functions.values import float_or
from wattmirror.operators.settling import REMAINING_CHILD, REMAINING_PARENT, Graphs
from wattmirror.plans.components import components
from wattmirror.plans.ordered import ordered_scan
from wattmirror.plans.pinned import pin

# Unit prefixes, and the spans in days above which coarser periods are used.
PREFIX = {"m": 1e-3, "k": 1e3, "M": 1e6, "G": 1e9, "T": 1e12}
MONTH_ABOVE_DAYS, DAY_ABOVE_DAYS = 35, 2
SNAPSHOT_EDGES = 100_000       # edges and nodes of a snapshot above which it is not kept together; also shared edges above which its components are found
TASK_ROWS = 250_000            # edges and nodes of a task, where snapshots are kept together
HASHES = 65_536                # numbers that snapshots are hashed to, to find large ones


def residual(totals: DataFrame, parts: DataFrame, keys: list[str]) -> DataFrame:
    """What the parts leave of a total, never negative, to three places.

    Values may be text; a part that is not a number counts as zero.
    """
    tracked = parts.groupBy(*keys).agg(F.sum(float_or(F.col("value"))).alias("__tracked"))
    left = float_or(F.col("value")) - F.coalesce("__tracked", F.lit(0.0))
    return totals.join(tracked, keys, "left").select(
        *keys, F.round(F.greatest(left, F.lit(0.0)), 3).alias("untracked"))


def flow_period(start: datetime, end: datetime) -> str:
    """The statistics period for a span: months beyond 35 days, days beyond 2, else hours."""
    days = (end - start).days
    return "month" if days > MONTH_ABOVE_DAYS else "day" if days > DAY_ABOVE_DAYS else "hour"


def period_change(changes: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Change per node and period of [start, end); NULL where a period holds no change at all.

    ``changes``: statistic_id, start_at, change.
    """
    period = flow_period(start, end)
    inside = changes.where((F.col("start_at") >= F.lit(start)) & (F.col("start_at") < F.lit(end)))
    return inside.groupBy("statistic_id", F.date_trunc(period, "start_at").alias("period_start")).agg(
        F.sum("change").alias("change")).withColumn("period", F.lit(period))


def node_change(changes: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Change per node over the whole span."""
    return period_change(changes, start, end).groupBy("statistic_id").agg(F.sum("change").alias("change"))


def _unit_prefix(unit: Column) -> Column:
    """The scale letter a unit starts with; a bare one-letter unit has none."""
    bare = F.regexp_replace(unit, "[²³]", "")
    chain = F
    for letter in PREFIX:
        chain = chain.when((F.length(bare) > 1) & unit.startswith(letter), letter)
    return chain.otherwise("")


def _factor(prefix: Column) -> Column:
    chain = F
    for letter, factor in PREFIX.items():
        chain = chain.when(prefix == letter, F.lit(factor))
    return chain.otherwise(F.lit(1.0))


def node_value(nodes: DataFrame, filters: list[tuple[str, float]] | None = None,
               prefix: str = "") -> DataFrame:
    """Node values ready to draw: filters in order, clamped at zero, scaled to one prefix.

    ``nodes`` has ``value`` (text or number) and ``unit``. Filters are ("multiply" | "divide" |
    "offset", operand). Unitless and monetary values are not scaled.
    """
    value = F.col("value").try_cast("double")
    for kind, operand in filters or []:
        value = {"multiply": lambda v: v * operand, "divide": lambda v: v / operand,
                 "offset": lambda v: v + operand}[kind](value)
    clamped = F.when(F.isnan(value) | value.isNull(), 0.0).otherwise(F.greatest(value, F.lit(0.0)))
    unit = F.col("unit")
    own = _unit_prefix(unit)
    ratio = _factor(own) / F.lit(PREFIX.get(prefix, 1.0))
    scalable = unit.isNotNull() & (unit != "") & (unit != "monetary") & (ratio != 1.0)
    new_unit = F.concat(F.lit(prefix), F.when(own != "", F.expr("substring(unit, 2)")).otherwise(unit))
    return nodes.withColumns({"value": F.when(scalable, clamped * ratio).otherwise(clamped),
                              "unit": F.when(scalable, new_unit).otherwise(unit)})


def linked_sums(links: DataFrame, keys: list[str]) -> DataFrame:
    """What linked nodes add to a node less what they subtract, as ``linked``.

    ``links``: keys, role (add | subtract), value. Every linked value is clamped at zero, so
    taking min(value, rest) off one after the other equals one subtraction clamped at zero, and
    the result does not depend on the order of the links.
    """
    value = F.greatest(F.col("value"), F.lit(0).cast(links.schema["value"].dataType))
    signed = F.when(F.col("role") == "add", value).when(F.col("role") == "subtract", -value)
    return links.groupBy(*keys).agg(F.sum(signed).alias("linked"))


def combine_nodes(nodes: DataFrame, links: DataFrame, keys: list[str]) -> DataFrame:
    """Node value plus its added nodes, minus its subtracted ones, not below zero."""
    rest = F.col("value") + F.coalesce("linked", F.lit(0))
    return (nodes.join(linked_sums(links, keys), keys, "left")
                 .withColumn("value", F.greatest(rest, F.lit(0))).drop("linked"))


# --- edge allocation -----------------------------------------------------------------------

FLOWS = ["snapshot_at", "edge_no", "parent", "child", "flow"]
EDGE_OUT = "snapshot_at {snapshot}, edge_no bigint, parent string, child string, flow double"


def allocate_edges(nodes: DataFrame, edges: DataFrame, most: int = SNAPSHOT_EDGES) -> DataFrame:
    """How much flows along every edge: min(parent left, child left, cap), in edge order.

    ``nodes``: snapshot_at, node, kind, value and, where remaining nodes have linked ones, linked
    (see ``linked_sums``; entities take theirs in beforehand, by ``combine_nodes``); ``edges``:
    snapshot_at, edge_no, parent, child, cap. A parent whose children have no other parent depends on nobody else, so its edges are
    a clamped running sum, which scales whatever the size of one snapshot. Edges whose endpoints
    are really shared are settled in waves of running sums, a connected graph at a time.

    A snapshot of up to ``most`` edges and nodes is shuffled once, as a whole, and all else happens where it lies. Larger
    ones are cut by their nodes. The driver sees two counts. Nodes and edges are read more than once: write them
    where they are costly.
    """
    edges = edges.select("snapshot_at", "edge_no", "parent", "child", "cap")
    told = ["kind", "value", *(["linked"] if "linked" in nodes.columns else [])]
    nodes = nodes.select("snapshot_at", "node", *told)
    large, count = _large(nodes.select("snapshot_at").union(edges.select("snapshot_at")), most)
    parts = -(-count // TASK_ROWS) or 1
    if large is None:
        return _allocate_whole(nodes, edges, told, parts)
    of = lambda df, how: df.join(large, "snapshot_at", how)
    rows = pin(_joined(of(nodes, "left_semi"), of(edges, "left_semi"), told), "edges")
    return (_allocate_whole(of(nodes, "left_anti"), of(edges, "left_anti"), told, parts)
            .unionByName(_allocate_stars(rows.where("star"))).unionByName(_allocate_shared(rows.where("NOT star"), most)))


def _large(rows: DataFrame, most: int) -> tuple[DataFrame | None, int]:
    """The snapshots with more than ``most`` rows, and how many rows there are. Rows are counted by a hash first, and by
    snapshot only where that is crowded."""
    rows = rows.select("snapshot_at", F.pmod(F.xxhash64("snapshot_at"), F.lit(HASHES)).alias("hash"))
    hashes = rows.groupBy("hash").count()
    total, fullest = hashes.agg(F.coalesce(F.sum("count"), F.lit(0)), F.coalesce(F.max("count"), F.lit(0))).first()
    if fullest <= most:
        return None, total
    crowded = hashes.where(F.col("count") > most).select("hash")
    large = pin(rows.join(crowded, "hash", "left_semi").groupBy("snapshot_at").count()
                    .where(F.col("count") > most).select("snapshot_at"), "large")
    return (None if large.isEmpty() else large), total


def _allocate_whole(nodes: DataFrame, edges: DataFrame, told: list[str], parts: int) -> DataFrame:
    """Snapshots that are kept together. Every step works inside a snapshot, on the one shuffle by it."""
    rows = _demanding(_side_by_side(nodes, edges, told, parts))
    upto = F.sum("demand").over(Window.partitionBy("hash", "snapshot_at", "parent").orderBy("edge_no")
                                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    flow = F.when(F.col("star"), _left_for(F.col("demand"), F.col("upto")))
    return _settled(rows.withColumn("upto", upto).withColumn("flow", flow), ["snapshot_at"], ["star", "flow"])


def _side_by_side(nodes: DataFrame, edges: DataFrame, told: list[str], parts: int = 1) -> DataFrame:
    """Every edge with what is known of its child and its parent, and whether it is a star's: ``_joined`` for snapshots that
    are kept together. Nodes lie between the edges and are looked up in windows; an edge has a row for each row of its ends."""
    edges = edges.where("snapshot_at IS NOT NULL AND parent IS NOT NULL AND child IS NOT NULL")
    nodes = nodes.where("snapshot_at IS NOT NULL AND node IS NOT NULL").withColumn("told", F.struct(*told)).drop(*told)
    rows = edges.unionByName(nodes, allowMissingColumns=True).repartition(parts, "snapshot_at")
    is_edge = F.col("node").isNull()

    def placed(df, end):
        """The hash comes first in the windows, as sorting by one number is far cheaper."""
        df = df.withColumn("place", F.coalesce("node", end)).withColumn("hash", F.xxhash64("snapshot_at", "place"))
        return df, Window.partitionBy("hash", "snapshot_at", "place")

    def looked_up(df, end):
        """Node rows stay single; an edge without a row of its end stays, too."""
        return df.withColumn(f"{end}_told", F.explode_outer(F.when(is_edge, F.col(f"{end}_told"))))

    rows, here = placed(rows, "child")
    rows = looked_up(rows.withColumns({"child_told": F.collect_list("told").over(here),
                                       "alone": F.count("child").over(here) == 1}), "child")
    plain = F.when(is_edge, F.coalesce(F.col("alone") & (F.col("child_told.kind") == "entity"), F.lit(False)))
    rows, here = placed(rows.withColumn("plain", plain), "parent")
    rows = looked_up(rows.withColumns({"parent_told": F.collect_list("told").over(here),
                                       "alone_fed": F.bool_and("plain").over(here)}).where(is_edge), "parent")
    star = F.col("alone_fed") & F.coalesce(F.col("parent_told.kind") == "entity", F.lit(False))
    return rows.select("snapshot_at", "edge_no", "parent", "child", "cap", "hash", star.alias("star"), *[
        F.col(f"{end}_told.{c}").alias(f"{end}_{c}") for end in ("child", "parent") for c in told])


def _joined(nodes: DataFrame, edges: DataFrame, told: list[str]) -> DataFrame:
    """Every edge with what is known of its child and its parent, and whether it is a star's."""
    # Nodes and edges grow together, hence the merge hints: neither side may be broadcast just
    # because it compresses well.
    side = lambda name: nodes.select("snapshot_at", F.col("node").alias(name),
                                     *[F.col(c).alias(f"{name}_{c}") for c in told]).hint("merge")
    # One row per child and per parent carries its node and what its edges say about it.
    children = (edges.groupBy("snapshot_at", "child").agg((F.count(F.lit(1)) == 1).alias("alone"))
                     .join(side("child"), ["snapshot_at", "child"], "left"))
    fed = edges.join(children.hint("merge"), ["snapshot_at", "child"])
    plain = F.coalesce(F.col("alone") & (F.col("child_kind") == "entity"), F.lit(False))
    parents = (fed.groupBy("snapshot_at", "parent").agg(F.bool_and(plain).alias("alone_fed"))
                  .join(side("parent"), ["snapshot_at", "parent"], "left"))
    star = F.col("alone_fed") & F.coalesce(F.col("parent_kind") == "entity", F.lit(False))
    return fed.join(parents.hint("merge"), ["snapshot_at", "parent"]).withColumn("star", star)


def _allocate_stars(stars: DataFrame) -> DataFrame:
    summed = ordered_scan(_demanding(stars), ["snapshot_at", "parent"], "edge_no", total={"upto": "demand"})
    return summed.select("snapshot_at", "edge_no", "parent", "child",
                         _left_for(F.col("demand"), F.col("upto")).alias("flow"))


def _demanding(stars: DataFrame) -> DataFrame:
    demand = F.least("child_value", F.coalesce("cap", "child_value"))
    return stars.withColumn("demand", F.greatest(demand, F.lit(0)))


def _left_for(demand: Column, upto: Column) -> Column:
    """The flow of a star's edge: what it demands of what those before it leave."""
    return F.least(demand, F.greatest(F.col("parent_value") - (upto - demand), F.lit(0))).cast("double")


def _allocate_shared(shared: DataFrame, most: int = SNAPSHOT_EDGES) -> DataFrame:
    """Shared edges, a whole graph per group: a snapshot, or a component of one with more than ``most`` edges."""
    parts = int(shared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["snapshot_at", "graph"]
    return _settled(_graphs(shared, most).repartition(parts, *keys), keys)


def _settled(shared: DataFrame, keys: list[str], known: list[str] | None = None) -> DataFrame:
    """Settle shared edges; the rows of a graph, told by the keys, lie in one partition. ``known``: star and flow, where
    edges of stars, whose flow is known, are among them."""
    snapshot = shared.schema["snapshot_at"].dataType.simpleString()
    numbers = [F.col(c).cast("double").alias(c) for c in shared.columns if c == "cap" or c.endswith(("_value", "_linked"))]
    return (shared.select(*keys, F.col("edge_no").cast("bigint").alias("edge_no"), "parent", "child", "parent_kind", "child_kind",
                          *numbers, *(known or []))
                  .sortWithinPartitions(*keys).mapInPandas(_settle_snapshots, EDGE_OUT.format(snapshot=snapshot)))


def _graphs(shared: DataFrame, most: int) -> DataFrame:
    """The edges with the graph they belong to. No flow depends on edges of another component, so those of a large
    snapshot are settled apart from each other; the driver sees whether there is one."""
    large = shared.groupBy("snapshot_at").count().where(F.col("count") > most).select("snapshot_at")
    if large.isEmpty():
        return shared.withColumn("graph", F.lit(""))
    large = pin(large, "large")
    roots = components(shared.join(large, "snapshot_at", "left_semi"), ["snapshot_at"], "parent", "child")
    return shared.join(roots.select("snapshot_at", F.col("node").alias("parent"), F.col("root").alias("graph")).hint("merge"),
                       ["snapshot_at", "parent"], "left").withColumn("graph", F.coalesce("graph", F.lit("")))


def _settle_snapshots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Settle graph after graph of a partition sorted by them; one may straddle batches."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if "star" in batch:
            star = batch["star"].to_numpy(dtype=bool)
            if star.any():
                yield batch.loc[star, FLOWS]
                batch = batch.loc[~star]
        if batch.empty:
            continue
        starts = _starts([*rest[-1:], batch])
        if rest and starts.size == 1:
            rest.append(batch)
            continue
        rows = pd.concat([*rest, batch], ignore_index=True)
        last = _starts([rows])[-1]
        if last:
            yield _settle_rows(rows.iloc[:last])
        rest = [rows.iloc[last:]]
    if rest:
        yield _settle_rows(pd.concat(rest, ignore_index=True))


def _starts(pieces: list[pd.DataFrame]) -> np.ndarray:
    """Where the graphs begin in rows that follow each other; of a piece before the last, only its last row counts."""
    rows = pd.concat([*(p.iloc[-1:] for p in pieces[:-1]), pieces[-1]], ignore_index=True)
    new = np.zeros(len(rows), dtype=bool)
    for key in ("snapshot_at", "graph"):
        if key in rows:
            new |= (rows[key] != rows[key].shift()).to_numpy()
    return np.flatnonzero(new)


def _settle_rows(rows: pd.DataFrame) -> pd.DataFrame:
    starts = _starts([rows])
    graph = np.repeat(np.arange(starts.size), np.diff(np.append(starts, len(rows))))
    number = rows["edge_no"].to_numpy(dtype=float, na_value=-np.inf) if rows["edge_no"].hasnans else rows["edge_no"].to_numpy()
    rows = rows.iloc[np.lexsort((number, graph))]
    told = [rows[c] if c in rows else None for c in _TOLD]
    return rows[FLOWS[:-1]].assign(flow=Graphs(graph, *told).flows())


_TOLD = ("parent", "child", "parent_kind", "child_kind", "parent_value", "child_value", "cap", "parent_linked", "child_linked")


def _settle(parents, children, parent_kind, child_kind, parent_value, child_value, caps,
            parent_linked=None, child_linked=None) -> list[float]:
    """Flows of the shared edges of one graph, given in order."""
    return Graphs(np.zeros(len(parents), dtype=np.int64), parents, children, parent_kind, child_kind, parent_value,
                  child_value, caps, parent_linked, child_linked).flows().tolist()


def passthrough_flows(allocated: DataFrame, via: DataFrame) -> DataFrame:
    """Flow through every passthrough node: the sum of the edges that run over it.

    ``via``: snapshot_at, edge_no, node.
    """
    return (via.join(allocated.select("snapshot_at", "edge_no", "flow"), ["snapshot_at", "edge_no"])
               .groupBy("snapshot_at", "node").agg(F.sum("flow").alias("flow")))


def reconcile_sums(nodes: DataFrame, edges: DataFrame, rules: DataFrame, side: str) -> DataFrame:
    """Bring a node and the sum of its ``side`` (parents | children) into agreement.

    ``nodes``: snapshot_at, node, value, updated_at. ``edges``: snapshot_at, parent, child.
    ``rules``: snapshot_at, node, should_be (equal | or_more | or_less), reconcile_to
    (min | max | mean | latest | NULL for the node's own value). Where the rule is broken the
    node takes the agreed value and its relatives are scaled to sum up to it. Returns the nodes
    that change; a relative claimed by two rules takes the one of the later node id.
    """
    me, other = ("child", "parent") if side == "parents" else ("parent", "child")
    values = nodes.select("snapshot_at", F.col("node").alias(other), F.col("value").alias("other_value"),
                          F.col("updated_at").alias("other_at"))
    links = edges.select("snapshot_at", F.col(me).alias("node"), other).join(values, ["snapshot_at", other])
    sums = links.groupBy("snapshot_at", "node").agg(F.sum("other_value").alias("total"),
                                                    F.max("other_at").alias("newest"))
    own, total = F.col("value"), F.col("total")
    broken = (((F.col("should_be") == "equal") & (total != own))
              | ((F.col("should_be") == "or_more") & (total < own))
              | ((F.col("should_be") == "or_less") & (total > own)))
    agreed = (F.when(F.col("reconcile_to") == "min", F.least(total, own))
               .when(F.col("reconcile_to") == "max", F.greatest(total, own))
               .when(F.col("reconcile_to") == "mean", (total + own) / 2)
               .when((F.col("reconcile_to") == "latest") & (F.col("newest") > F.col("updated_at")), total)
               .otherwise(own))
    fixed = (rules.join(nodes, ["snapshot_at", "node"]).join(sums, ["snapshot_at", "node"]).where(broken)
                  .select("snapshot_at", "node", agreed.alias("agreed"), "total"))
    mine = fixed.select("snapshot_at", "node", F.col("agreed").alias("value"), F.col("node").alias("by"))
    theirs = links.join(fixed, ["snapshot_at", "node"]).select(
        "snapshot_at", F.col(other).alias("target"),
        F.when(F.col("total") == 0, F.lit(0.0))
         .otherwise(F.col("other_value") / F.col("total") * F.col("agreed")).alias("value"),
        F.col("node").alias("by"))
    changes = mine.unionByName(theirs.withColumnRenamed("target", "node"))
    return changes.groupBy("snapshot_at", "node").agg(F.max_by("value", "by").alias("value"))
