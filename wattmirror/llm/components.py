"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattmirror.llm.common import pin


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def _print_of(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    row = edges.agg(F.count("*"), F.bit_xor(h), F.sum(F.shiftright(h, 24))).first()
    return tuple(row)


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge table (u long, v long).

    root is the smallest node of the component. Rounds grow with the logarithm of the longest chain; each
    writes its edges to the shared folder, so no round is computed twice and a lost executor costs one round.
    Only a count and a checksum of the edges reach the driver. Empty edges give no rows; loops and repeated
    edges are ignored.
    """
    now = pin(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
              "edges")
    before, after = None, _print_of(now)
    while after != before and after[0]:
        now = pin(_small_star(_large_star(now).distinct()).distinct(), "edges")
        before, after = after, _print_of(now)
    own = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .union(own.select("node", F.col("node").alias("root")))
