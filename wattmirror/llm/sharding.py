"""Shuffling documents into shards by a two-pass external shuffle, with DataFrame functions only.

Pass one scatters the rows over buckets by a seeded hash; the number of buckets follows from the bytes, so that a
bucket fits in memory. Rows that occur very often are counted, and their copies scattered by number. Pass two shuffles each bucket by Fisher-Yates (Spark's seeded shuffle of the row numbers of
the bucket) and writes it: buckets in a row, cut into shards of equal row counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattmirror.llm.common import pin

SHARDS = 40
BUCKET_BYTES = 16 << 20         # of a bucket, on average
BUCKET_ROWS = 20_000            # rows of a bucket, on average, where rows are short
BUCKETS_PER_TASK = 4
CROWD = 1_000                   # rows of one hash above which copies are numbered
PIECE = 10_000                  # copies made at a time
SEED = 23
OWN = ["__size", "__shard", "__slot"]


def external_shuffle(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The documents with __size (UTF-8 bytes of the text plus 16; null text: 16), __shard and __slot.

    Law `rows`: the row counts of the shards are at most one apart, slots are gapless from 0. A bucket's rows are
    sorted by hash and content before they are drawn, and buckets are dealt to partitions by number, so reruns
    agree; equal rows are interchangeable. The driver sees two sums. Copies of a text under different ids are scattered
    like any rows; so are rows equal in everything, over CROWD of which are counted and made again by number (where
    -0.0 then reads 0.0). Null ids and texts are values like any other; columns must be comparable (no maps). Input
    columns named like the three new ones are replaced by them. An empty table gives no rows.
    """
    names = [c for c in docs.columns if c not in OWN]
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16
    scatter = F.xxhash64(F.lit(seed), F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")))
    row = F.struct(*[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(names)])
    rows = docs.select(scatter.alias("hash"), row.alias("row"), size.alias("size"))
    total = rows.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    n = max(total["n"], 1)
    buckets = max(1, -(-(total["bytes"] or 0) // BUCKET_BYTES), -(-n // BUCKET_ROWS))
    tasks = -(-buckets // BUCKETS_PER_TASK)
    bucket = F.pmod("hash", F.lit(buckets))
    rows = _scattered(rows, tasks).withColumn("bucket", bucket) \
        .withColumn("task", F.floor(F.col("bucket") / BUCKETS_PER_TASK).cast("int"))

    order = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = rows.groupBy("task", "bucket").agg(F.count("*").alias("n")) \
        .select("task", "bucket", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("ahead"))
    held = rows.repartitionById(tasks, "task").groupBy("task", "bucket") \
        .agg(F.sort_array(F.collect_list(F.struct("hash", "row", "size"))).alias("rows"))
    drawn = held.join(ahead.repartitionById(tasks, "task"), ["task", "bucket"]).sortWithinPartitions("bucket") \
        .select("ahead", F.shuffle("rows", F.lit(seed)).alias("rows"))
    placed = drawn.select("ahead", F.posexplode("rows").alias("at", "one")) \
        .select("one.row", "one.size", (F.col("ahead") + F.col("at")).alias("place"))
    shard = f"((place * {shards}L) div {n}L)"
    return placed.select(*[F.col("row")[f"f{i}"].alias(c) for i, c in enumerate(names)], F.col("size").alias("__size"),
                         F.expr(f"CAST({shard} AS INT)").alias("__shard"),
                         F.expr(f"place - ({shard} * {n}L + {shards - 1}L) div {shards}L").alias("__slot"))


def _scattered(rows: DataFrame, tasks: int) -> DataFrame:
    """The rows (hash, row, size), those of a crowded hash with hashes of their own, by number and all columns.

    Equal rows are combined to a count before they are shuffled; the copies are made again in pieces, in many tasks.
    """
    crowded = pin(rows.groupBy("hash").count().where(F.col("count") > CROWD).select("hash"), "crowded")
    counted = rows.join(crowded, "hash", "left_semi").groupBy("hash", "row", "size").agg(F.count("*").alias("copies"))
    pieces = counted.withColumn("first", F.explode(F.expr(f"sequence(0L, copies - 1L, {PIECE}L)")))
    copies = pieces.repartition(tasks, "hash", "first") \
        .withColumn("number", F.explode(F.expr(f"sequence(first, least(copies, first + {PIECE}L) - 1L)")))
    return rows.join(crowded, "hash", "left_anti").unionByName(
        copies.select(F.xxhash64("hash", "number", "row").alias("hash"), "row", "size"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Write the shuffled documents, one folder per shard, rows in slot order."""
    out = external_shuffle(docs, shards, seed)
    out.repartition(shards, "__shard").sortWithinPartitions("__shard", "__slot") \
        .withColumnRenamed("__shard", "shard").withColumnRenamed("__slot", "slot").drop("__size") \
        .write.partitionBy("shard").parquet(path)
