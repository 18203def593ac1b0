"""Flow roll-ups against their oracles; orders are parents, their lines children."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from wattmirror.checks import model as m
from wattmirror.checks import reporting_checks as r
from wattmirror.checks.registry import check, with_ctes
from wattmirror.operators import flows as fl
from wattmirror.plans.pinned import pin

DEC = "decimal(18,2)"


def orders(spark, sf_dir):
    return m.table(spark, sf_dir, "orders")


def lines(spark, sf_dir):
    """One row per order line; (number, part, supplier) orders the lines of an order."""
    return m.table(spark, sf_dir, "lineitem")


@check("fl_01_residual", """
SELECT o_custkey AS custkey, round(greatest(coalesce(max(total), 0) - coalesce(sum(part), 0), 0), 3) AS untracked
FROM (SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY 1) o
LEFT JOIN (SELECT o_custkey AS ck, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END)
             AS DOUBLE) AS part FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1) l ON l.ck = o.o_custkey
GROUP BY 1""")
def residual(spark, sf_dir):
    """Returned lines read as unavailable and count as zero."""
    od = orders(spark, sf_dir)
    totals = od.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.sum(F.col("o_totalprice").cast(DEC)).cast("string").alias("value"))
    parts = lines(spark, sf_dir).join(od, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("custkey"),
        F.when(F.col("l_returnflag") == "R", "unavailable").otherwise(F.col("l_extendedprice").cast("string")).alias("value"))
    return fl.residual(totals, parts, ["custkey"])


START, END = datetime(2024, 1, 3, 5), datetime(2024, 1, 28, 7)


@check("fl_02_period_change", f"""
SELECT statistic_id, CAST(date_trunc('day', h) AS TIMESTAMP) AS period_start, CAST(sum(change) AS DOUBLE) AS change, 'day' AS period
FROM (SELECT {m.METRIC_SQL} AS statistic_id, date_trunc('hour', ts) AS h,
        CASE WHEN count(*) > 1 THEN sum(CAST(value AS DECIMAL(18,2))) END AS change FROM events GROUP BY 1, 2)
WHERE h >= TIMESTAMP '{START}' AND h < TIMESTAMP '{END}' GROUP BY 1, 2""")
def change(spark, sf_dir):
    out = fl.period_change(hour_changes(spark, sf_dir), START, END)
    return out.withColumn("change", F.col("change").cast("double"))


def hour_changes(spark, sf_dir):
    """Change per hour, NULL where only one reading arrived."""
    ev = m.events(spark, sf_dir)
    return (ev.groupBy(m.metric(F.col("state"), F.col("entity_id")).alias("statistic_id"), F.date_trunc("hour", "ts").alias("start_at"))
              .agg(F.when(F.count(F.lit(1)) > 1, F.sum(F.col("value").cast(DEC))).alias("change")))


@check("fl_02_node_change", f"""
SELECT statistic_id, CAST(sum(change) AS DOUBLE) AS change
FROM (SELECT {m.METRIC_SQL} AS statistic_id, date_trunc('hour', ts) AS h,
        CASE WHEN count(*) > 1 THEN sum(CAST(value AS DECIMAL(18,2))) END AS change FROM events GROUP BY 1, 2)
WHERE h >= TIMESTAMP '{START}' AND h < TIMESTAMP '{END}' GROUP BY 1""")
def total_change(spark, sf_dir):
    return fl.node_change(hour_changes(spark, sf_dir), START, END).withColumn("change", F.col("change").cast("double"))


@check("fl_03_node_value", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(CASE WHEN unit IN ('kWh', 'MWh') THEN v * f / 1000 WHEN unit = 'Wh' THEN v / 1000 ELSE v END, 6) AS value,
  CASE unit WHEN 'MWh' THEN 'kWh' WHEN 'Wh' THEN 'kWh' ELSE unit END AS unit
FROM (SELECT *, CASE l_linenumber % 5 WHEN 0 THEN 'Wh' WHEN 1 THEN 'kWh' WHEN 2 THEN 'MWh' WHEN 3 THEN 'monetary' END AS unit,
        CASE l_linenumber % 5 WHEN 1 THEN 1000.0 WHEN 2 THEN 1000000.0 ELSE 1 END AS f,
        CASE WHEN l_returnflag = 'N' THEN 0 ELSE greatest(l_extendedprice * 2.0 / 4.0 - 9000, 0) END AS v FROM lineitem)""")
def value(spark, sf_dir):
    n = F.col("l_linenumber") % 5
    nodes = lines(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_returnflag") == "N", "unknown").otherwise(F.col("l_extendedprice").cast("string")).alias("value"),
        F.when(n == 0, "Wh").when(n == 1, "kWh").when(n == 2, "MWh").when(n == 3, "monetary").alias("unit"))
    out = fl.node_value(nodes, [("multiply", 2.0), ("divide", 4.0), ("offset", -9000.0)], prefix="k")
    return out.withColumn("value", F.round("value", 6))


@check("fl_04_combine_nodes", """
SELECT o_orderkey AS node, CAST(greatest(CAST(o_totalprice AS DECIMAL(18,2)) + coalesce(a, 0) - coalesce(s, 0), 0) AS DOUBLE) AS value
FROM orders LEFT JOIN (SELECT l_orderkey, sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (WHERE l_returnflag = 'A') AS a,
    sum(CAST(l_extendedprice * 4 AS DECIMAL(18,2))) FILTER (WHERE l_returnflag <> 'A') AS s FROM lineitem GROUP BY 1) l
  ON l_orderkey = o_orderkey""")
def combined(spark, sf_dir):
    nodes = orders(spark, sf_dir).select(F.col("o_orderkey").alias("node"), F.col("o_totalprice").cast(DEC).alias("value"))
    add = F.col("l_returnflag") == "A"
    links = lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("node"), F.when(add, "add").otherwise("subtract").alias("role"),
        F.when(add, F.col("l_quantity").cast(DEC)).otherwise((F.col("l_extendedprice") * 4).cast(DEC)).alias("value"))
    return fl.combine_nodes(nodes, links, ["node"]).withColumn("value", F.col("value").cast("double"))


def line_no():
    return (F.col("l_linenumber").cast("bigint") * 1_000_000_000 + F.col("l_partkey") * 10_000 + F.col("l_suppkey"))


def star_graph(spark, sf_dir):
    """An order as parent of its lines; a line's cap is a quantity-based limit on some lines.

    Stored first, as a flow graph would be, so that its derivation runs once.
    """
    ln = lines(spark, sf_dir).groupBy(F.col("l_orderkey").alias("snapshot_at"), line_no().alias("edge_no")).agg(
        F.max(F.col("l_extendedprice").cast(DEC) * 4).cast(DEC).alias("value"), F.max("l_quantity").alias("q"))
    ln = pin(ln.withColumn("node", F.col("edge_no").cast("string")), "lines")
    od = orders(spark, sf_dir).select(F.col("o_orderkey").alias("snapshot_at"), F.lit("total").alias("node"),
                                      F.col("o_totalprice").cast(DEC).alias("value"))
    nodes = ln.select("snapshot_at", "node", "value").unionByName(od).withColumn("kind", F.lit("entity"))
    edges = ln.select("snapshot_at", "edge_no", F.lit("total").alias("parent"), F.col("node").alias("child"),
                      F.when(F.col("q") > 25, (F.col("q") * 400).cast(DEC)).alias("cap"))
    return nodes, edges


@check("fl_05_allocate_stars", """
WITH ln AS (SELECT l_orderkey AS snapshot_at, l_linenumber * 1000000000::BIGINT + l_partkey * 10000 + l_suppkey AS edge_no,
    CAST(max(CAST(l_extendedprice AS DECIMAL(18,2)) * 4) AS DECIMAL(18,2)) AS v, max(l_quantity) AS q
  FROM lineitem GROUP BY 1, 2),
d AS (SELECT *, CASE WHEN q > 25 THEN least(v, CAST(q * 400 AS DECIMAL(18,2))) ELSE v END AS demand FROM ln),
c AS (SELECT *, coalesce(sum(demand) OVER (PARTITION BY snapshot_at ORDER BY edge_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM d)
SELECT snapshot_at, edge_no, 'total' AS parent, CAST(edge_no AS VARCHAR) AS child,
  CAST(least(demand, greatest(CAST(o_totalprice AS DECIMAL(18,2)) - used, 0)) AS DOUBLE) AS flow
FROM c JOIN orders ON o_orderkey = snapshot_at""")
def stars(spark, sf_dir):
    return fl.allocate_edges(*star_graph(spark, sf_dir))


def shared_graph(spark, sf_dir):
    """Return flags feed line statuses inside an order, with a remaining child for the rest."""
    nodes, edges = flags_and_statuses(spark, sf_dir)
    return pin(nodes, "nodes"), pin(edges, "edges")


def flags_and_statuses(spark, sf_dir):
    """Nodes and edges of the shared graph, from the lines read once: one row per order, flag and status is stored."""
    base = pin(lines(spark, sf_dir).groupBy(F.col("l_orderkey").alias("snapshot_at"), "l_returnflag", "l_linestatus").agg(
        F.sum("l_extendedprice").alias("price"), F.sum("l_quantity").alias("quantity")), "lines")
    child = F.concat(F.lit("to "), "l_linestatus")
    flags = base.groupBy("snapshot_at", F.col("l_returnflag").alias("node")).agg(F.sum("price").alias("value"))
    statuses = base.groupBy("snapshot_at", child.alias("node")).agg((F.sum("quantity") * 700).alias("value"))
    pairs = base.select("snapshot_at", F.col("l_returnflag").alias("parent"), child.alias("child"))
    rest = base.select("snapshot_at", F.col("l_returnflag").alias("parent"), F.lit("untracked").alias("child")).distinct()
    number = (F.ascii("parent") * 1000 + F.ascii(F.substring("child", -1, 1))).cast("bigint")
    edges = pairs.unionByName(rest).select("snapshot_at", number.alias("edge_no"), "parent", "child",
                                           F.lit(None).cast("double").alias("cap"))
    spare = base.select("snapshot_at", F.lit("untracked").alias("node"), F.lit(0.0).alias("value")).distinct()
    nodes = (flags.unionByName(statuses).withColumn("kind", F.lit("entity"))
             .unionByName(spare.withColumn("kind", F.lit(fl.REMAINING_PARENT))))
    return nodes, edges


# The edges of an order in order: A, N, R each to F, to O, then to the rest. Written out step by step.
SHARED_SQL = """
WITH v AS (SELECT l_orderkey AS s,
    coalesce(sum(l_extendedprice) FILTER (WHERE l_returnflag = 'A'), 0) AS a,
    coalesce(sum(l_extendedprice) FILTER (WHERE l_returnflag = 'N'), 0) AS n,
    coalesce(sum(l_extendedprice) FILTER (WHERE l_returnflag = 'R'), 0) AS r,
    coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'F'), 0) * 700 AS f,
    coalesce(sum(l_quantity) FILTER (WHERE l_linestatus = 'O'), 0) * 700 AS o,
    list_distinct(list(l_returnflag || l_linestatus)) AS pairs, list_distinct(list(l_returnflag)) AS flags
  FROM lineitem GROUP BY 1),
a1 AS (SELECT *, CASE WHEN list_contains(pairs, 'AF') THEN least(a, f) ELSE 0 END AS af FROM v),
a2 AS (SELECT *, CASE WHEN list_contains(pairs, 'AO') THEN least(a - af, o) ELSE 0 END AS ao FROM a1),
n1 AS (SELECT *, CASE WHEN list_contains(pairs, 'NF') THEN least(n, f - af) ELSE 0 END AS nf FROM a2),
n2 AS (SELECT *, CASE WHEN list_contains(pairs, 'NO') THEN least(n - nf, o - ao) ELSE 0 END AS no FROM n1),
r1 AS (SELECT *, CASE WHEN list_contains(pairs, 'RF') THEN least(r, f - af - nf) ELSE 0 END AS rf FROM n2),
r2 AS (SELECT *, CASE WHEN list_contains(pairs, 'RO') THEN least(r - rf, o - ao - no) ELSE 0 END AS ro FROM r1),
flows AS (SELECT s, pairs, flags, unnest([
    {'p': 'A', 'c': 'F', 'x': af}, {'p': 'A', 'c': 'O', 'x': ao}, {'p': 'A', 'c': 'd', 'x': a - af - ao},
    {'p': 'N', 'c': 'F', 'x': nf}, {'p': 'N', 'c': 'O', 'x': no}, {'p': 'N', 'c': 'd', 'x': n - nf - no},
    {'p': 'R', 'c': 'F', 'x': rf}, {'p': 'R', 'c': 'O', 'x': ro}, {'p': 'R', 'c': 'd', 'x': r - rf - ro}], recursive := true) FROM r2)
SELECT s AS snapshot_at, CAST(ascii(p) * 1000 + ascii(c) AS BIGINT) AS edge_no, p AS parent,
  CASE WHEN c = 'd' THEN 'untracked' ELSE 'to ' || c END AS child, abs(round(x, 2)) AS flow
FROM flows WHERE CASE WHEN c = 'd' THEN list_contains(flags, p) ELSE list_contains(pairs, p || c) END"""


@check("fl_05_allocate_shared", SHARED_SQL)
def shared(spark, sf_dir):
    """Order-dependent allocation over shared endpoints."""
    return fl.allocate_edges(*shared_graph(spark, sf_dir)).withColumn("flow", F.abs(F.round("flow", 2)))


def linked_graph(spark, sf_dir):
    """The shared graph, where other nodes add to the remaining child and subtract from it, and it feeds a node."""
    nodes, edges = flags_and_statuses(spark, sf_dir)
    ln = lines(spark, sf_dir).withColumnRenamed("l_orderkey", "snapshot_at")
    links = ln.where("l_returnflag = 'A'").select("snapshot_at", F.lit("add").alias("role"), (F.col("l_quantity") * 50).alias("value")) \
        .unionByName(ln.select("snapshot_at", F.lit("subtract").alias("role"), (F.col("l_quantity") * 40).alias("value")))
    linked = pin(fl.linked_sums(links, ["snapshot_at"]), "linked").withColumn("node", F.lit("untracked"))
    spare = linked.select("snapshot_at")
    sink = spare.select("snapshot_at", F.lit("to Z").alias("node"), F.lit(1e12).alias("value"), F.lit("entity").alias("kind"))
    is_rest = F.col("node").eqNullSafe(F.lit("untracked"))
    nodes = (nodes.where(is_rest).join(linked, ["snapshot_at", "node"], "left")
             .unionByName(nodes.where(~is_rest).unionByName(sink), allowMissingColumns=True))
    edges = edges.unionByName(spare.select("snapshot_at", F.lit(117_090).cast("bigint").alias("edge_no"), F.lit("untracked").alias("parent"),
                                           F.lit("to Z").alias("child"), F.lit(None).cast("double").alias("cap")))
    return pin(nodes, "nodes"), pin(edges, "edges")


@check("fl_05_remaining_linked", f"""
WITH base AS ({SHARED_SQL}),
net AS (SELECT l_orderkey AS snapshot_at, coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'A'), 0) * 50 - sum(l_quantity) * 40 AS net
  FROM lineitem GROUP BY 1)
SELECT snapshot_at, edge_no, parent, child, flow FROM base WHERE child <> 'untracked'
UNION ALL SELECT snapshot_at, edge_no, parent, child, round(CASE WHEN row_number() OVER (PARTITION BY snapshot_at ORDER BY edge_no) = 1
    THEN greatest(0, least(flow, flow + net)) ELSE flow END, 2)
  FROM base JOIN net USING (snapshot_at) WHERE child = 'untracked'
UNION ALL SELECT snapshot_at, 117090, 'untracked', 'to Z', round(greatest(0, sum(flow) + any_value(net)), 2)
  FROM base JOIN net USING (snapshot_at) WHERE child = 'untracked' GROUP BY 1""")
def remaining_linked(spark, sf_dir):
    """The edge that completes the remaining child's sum comes first in its order, as it waits for all the others."""
    return fl.allocate_edges(*linked_graph(spark, sf_dir)).withColumn("flow", F.abs(F.round("flow", 2)))


@check("fl_05_flow_conservation", """
SELECT l_orderkey AS snapshot_at, l_returnflag AS parent, round(sum(l_extendedprice), 2) AS flow
FROM lineitem GROUP BY 1, 2""")
def conserved(spark, sf_dir):
    """With a remaining child every parent gives away exactly what it has."""
    out = fl.allocate_edges(*shared_graph(spark, sf_dir))
    return out.groupBy("snapshot_at", "parent").agg(F.round(F.sum("flow"), 2).alias("flow"))


@check("fl_05_passthrough", """
WITH ln AS (SELECT l_orderkey AS snapshot_at, l_linenumber * 1000000000::BIGINT + l_partkey * 10000 + l_suppkey AS edge_no,
    CAST(max(CAST(l_extendedprice AS DECIMAL(18,2)) * 4) AS DECIMAL(18,2)) AS v, max(l_quantity) AS q, max(l_returnflag) AS flag
  FROM lineitem GROUP BY 1, 2),
d AS (SELECT *, CASE WHEN q > 25 THEN least(v, CAST(q * 400 AS DECIMAL(18,2))) ELSE v END AS demand FROM ln),
c AS (SELECT *, coalesce(sum(demand) OVER (PARTITION BY snapshot_at ORDER BY edge_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM d)
SELECT snapshot_at, 'via ' || flag AS node, round(CAST(sum(least(demand, greatest(CAST(o_totalprice AS DECIMAL(18,2)) - used, 0))) AS DOUBLE), 2) AS flow
FROM c JOIN orders ON o_orderkey = snapshot_at GROUP BY 1, 2""")
def passthrough(spark, sf_dir):
    ln = lines(spark, sf_dir)
    via = ln.groupBy(F.col("l_orderkey").alias("snapshot_at"), line_no().alias("edge_no")).agg(
        F.concat(F.lit("via "), F.max("l_returnflag")).alias("node"))
    out = fl.passthrough_flows(fl.allocate_edges(*star_graph(spark, sf_dir)), via)
    return out.withColumn("flow", F.round("flow", 2))


@check("fl_06_reconcile_sums", """
WITH kids AS (SELECT l_orderkey AS o, CAST(l_suppkey AS VARCHAR) AS kid, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v, max(l_shipdate) AS ts
  FROM lineitem GROUP BY 1, 2),
tot AS (SELECT o, sum(v) AS total, max(ts) AS newest FROM kids GROUP BY 1),
p AS (SELECT o_orderkey AS o, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS own, CAST(total AS DOUBLE) AS total, newest, o_orderdate AS ts,
  o_orderstatus AS st, left(o_orderpriority, 1) AS pr FROM orders JOIN tot ON o = o_orderkey),
f AS (SELECT o, total, CASE pr WHEN '1' THEN least(total, own) WHEN '2' THEN greatest(total, own) WHEN '3' THEN (total + own) / 2
    WHEN '4' THEN CASE WHEN newest > ts THEN total ELSE own END ELSE own END AS agreed
  FROM p WHERE (st = 'F' AND total <> own) OR (st = 'O' AND total < own) OR (st = 'P' AND total > own))
SELECT o AS snapshot_at, 'total' AS node, round(agreed, 4) AS value FROM f
UNION ALL SELECT k.o, kid, round(CAST(v AS DOUBLE) / total * agreed, 4) FROM kids k JOIN f ON f.o = k.o""")
def reconciled(spark, sf_dir):
    kids = lines(spark, sf_dir).groupBy(F.col("l_orderkey").alias("snapshot_at"), F.col("l_suppkey").cast("string").alias("node")) \
        .agg(F.sum(F.col("l_extendedprice").cast(DEC)).cast("double").alias("value"),
             F.max(F.col("l_shipdate").cast("timestamp")).alias("updated_at"))
    od = orders(spark, sf_dir)
    top = od.select(F.col("o_orderkey").alias("snapshot_at"), F.lit("total").alias("node"),
                    F.col("o_totalprice").cast(DEC).cast("double").alias("value"),
                    F.col("o_orderdate").cast("timestamp").alias("updated_at"))
    status, priority = F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)
    rules = od.select(F.col("o_orderkey").alias("snapshot_at"), F.lit("total").alias("node"),
                      F.when(status == "F", "equal").when(status == "O", "or_more").otherwise("or_less").alias("should_be"),
                      F.when(priority == "1", "min").when(priority == "2", "max").when(priority == "3", "mean")
                       .when(priority == "4", "latest").alias("reconcile_to"))
    edges = kids.select("snapshot_at", F.lit("total").alias("parent"), F.col("node").alias("child"))
    return fl.reconcile_sums(top.unionByName(kids), edges, rules, "children").withColumn("value", F.round("value", 4))
