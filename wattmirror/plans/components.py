"""Connected components of large graphs, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattmirror.plans.pinned import pin


def _near_least(links: DataFrame, keys: list[str]) -> DataFrame:
    """Every larger neighbour of a node hangs on the least node around it."""
    both = links.select(*keys, "u", "v").union(links.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
    least = pin(both.groupBy(*keys, "u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.where("v > u").join(least.hint("merge"), [*keys, "u"]).select(*keys, F.col("v").alias("u"), F.col("m").alias("v"))


def _below_least(links: DataFrame, keys: list[str]) -> DataFrame:
    """A node and its smaller neighbours hang on the least of them."""
    least = pin(links.groupBy(*keys, "u").agg(F.min("v").alias("m")), "least")
    moved = links.join(least.hint("merge"), [*keys, "u"]).where("v > m")
    return moved.select(*keys, F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(*keys, "u", F.col("m").alias("v")))


def components(links: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """(keys, node, root) for every node of the links (keys, a, b): root is the least node it is connected with.

    Graphs are told apart by the keys; keys and nodes are not NULL. Rounds grow with the logarithm of the longest chain,
    and each writes its links, so a lost executor costs one round. The driver sees a count and a checksum per round. Who
    is next to a node is aggregated before the shuffle and written, so that a hub's join can be split.
    """
    far = links.where(F.col(a) != F.col(b)).select(*keys, F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    now = pin(far.distinct(), "links")
    before, after = None, _print_of(now, keys)
    while after != before and after[0]:
        pinned = pin(_near_least(now, keys).distinct(), "links")
        now = pin(_below_least(pinned, keys).distinct(), "links")
        before, after = after, _print_of(now, keys)
    alone = links.select(*keys, F.col(a).alias("node")).union(links.select(*keys, F.col(b).alias("node"))).distinct()
    hung = now.groupBy(*keys, F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return alone.join(hung, [*keys, "node"], "left").select(*keys, "node", F.coalesce("root", "node").alias("root"))


def _print_of(links: DataFrame, keys: list[str]) -> tuple:
    h = F.xxhash64(*keys, "u", "v")
    return tuple(links.agg(F.count("*"), F.bit_xor(h), F.sum(F.shiftright(h, 24))).first())
