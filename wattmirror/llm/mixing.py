"""Mixing sources to target weights by a curriculum over training positions.

Every source has a weight that changes linearly over training. Its integral from 0 to t, scaled to the source's
target, is the source's cumulative demand for words at training position t. Documents of a source are laid out in a
seeded order, again and again until the demand is met, and the inverse of the demand at the words before a document
is its position. Sorting all sources by position gives the mix. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattmirror.llm.common import WORD, packed, unpacked

WEIGHTS = (5, 2, 1)             # of the sources in code point order, null last, repeating
MOST = 3                        # a source's words are taken at most so often
PART_ROWS = 2_000               # documents are laid out in hash parts of about so many
# Slope of each weight over training, repeating like the weights: weight(t) = w * (1 + slope * (2 t - 1)).
SLOPES = (-0.5, 0.0, 0.5)
SEED = 17


def sized(docs: DataFrame) -> DataFrame:
    """The documents with __size, the words of the text (null: 0)."""
    return docs.withColumn("__size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """source, source_size, target, slope for a table of (source, source_size).

    Targets share the sum of all sizes by weight, but none exceeds `most` times its source; what the full ones leave
    is shared by weight among the others. Sources are sorted by size per weight: the full ones come first, and the
    level per weight unit follows from running sums. One row per source is sorted, never one per document.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    n = (F.row_number().over(by_name) - 1) % len(WEIGHTS)

    def pick(values) -> Column:
        return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.col("__n") + 1).cast("int"))

    w = sources.withColumn("__n", n).withColumn("__w", pick(WEIGHTS)).withColumn("slope", pick(SLOPES)) \
        .withColumn("__cap", F.col("source_size") * float(most)).withColumn("__ratio", F.col("__cap") / F.col("__w"))
    rising = Window.orderBy("__ratio", "__n", F.encode("source", "UTF-8"))
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    w = w.withColumn("__rest", F.sum("source_size").over(everything).cast("double")
                     - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))) \
        .withColumn("__weight", F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(before), F.lit(0.0))) \
        .withColumn("__level", F.col("__rest") / F.col("__weight")).withColumn("__row", F.row_number().over(rising))
    first = F.min(F.when(F.col("__level") <= F.col("__ratio"), F.struct("__row", "__level"))).over(everything)
    return w.withColumn("__at", first["__level"]).select(
        "source", "source_size", F.least(F.col("__cap"), F.coalesce(F.col("__at") * F.col("__w"), F.col("__cap")))
        .alias("target"), "slope")


def position(share: Column, slope: Column) -> Column:
    """The training position (0 to 1) at which a source has met that share of its demand.

    The demand is the integral of 1 + slope * (2 t - 1), that is (1 - slope) * t + slope * t^2; this is its inverse.
    """
    level = 1 - slope
    root = F.sqrt(level * level + 4 * slope * share)
    return F.when(slope == 0, share).otherwise(2 * share / (level + root))


def curriculum(docs: DataFrame, most: int = MOST) -> DataFrame:
    """The documents with __size, __source_size, __target and __visits: an array of (turn, position, words).

    A visit takes the document at a training position; the last one of a source may take only its first words, so
    that the words taken of a source are its target (rounded down). Documents of no visit have an empty array, and
    so have those without words. The order within a source is a seeded hash of doc_id and text; equal rows share
    theirs and are taken one after the other. Sources are laid out in hash parts, as many as the number of documents
    asks for, with running sums over the parts, so that no task gets a whole source. Nulls: a null source is a source of its own, a null text has size 0.
    """
    names = docs.columns
    parts_wanted = max(1, -(-docs.count() // PART_ROWS))
    key = F.xxhash64(F.lit(SEED), F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")))
    rows = sized(docs).withColumn("__key", key).withColumn("__part", F.pmod("__key", F.lit(parts_wanted)))
    parts = rows.groupBy("source", "__part").agg(F.sum("__size").alias("__words"))
    sums = parts.groupBy("source").agg(F.sum("__words").alias("source_size"))
    goal = targets(sums, most)
    ahead = Window.partitionBy("source").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.withColumn("__ahead", F.coalesce(F.sum("__words").over(ahead), F.lit(0)))
    lead = offsets.join(goal.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))) \
        .select(F.col("source").alias("__s"), F.col("__part").alias("__p"), "__ahead",
                F.col("source_size").alias("__source_size"), F.col("target").alias("__target"),
                F.col("slope").alias("__slope"))
    own = Window.partitionBy("source", "__part").orderBy("__key", "doc_id", "__size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    laid = rows.withColumn("__inside", F.coalesce(F.sum("__size").over(own), F.lit(0))) \
        .join(lead, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__part") == F.col("__p")))
    goal_words = F.floor("__target")

    def visit(turn):
        begin = turn * F.col("__source_size") + F.col("__ahead") + F.col("__inside")
        words = F.greatest(F.least(goal_words - begin, F.col("__size")), F.lit(0)).cast("long")
        share = begin / F.greatest(F.col("__target"), F.lit(1.0))
        return F.struct(turn.cast("int").alias("turn"), position(F.least(share, F.lit(1.0)), F.col("__slope"))
                        .alias("position"), words.alias("words"))

    visits = F.filter(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), visit), lambda v: v["words"] > 0)
    return laid.withColumn("__visits", visits).select(*names, "__size", "__source_size", "__target", "__visits")


def mix(docs: DataFrame, most: int = MOST) -> DataFrame:
    """The mix: one row per visit, range-sorted by training position, columns as in the documents.

    The one document of a source that is taken in part keeps its first words and the space between them; n_chars
    follows the text, if there is one. Documents without words, null texts among them, are in no visit and go. Equal
    rows are taken one after the other, ties in position go by doc_id and turn. An empty table gives no rows. Columns
    beside doc_id, text, source and n_chars pass, whatever their names.
    """
    own = ["doc_id", "text", "source", "n_chars"]
    rows = curriculum(packed(docs, own), most).withColumn("__visit", F.explode("__visits"))
    lead = F.slice(F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), 1,
                   F.col("__visit.words").cast("int"))
    partial = F.col("__visit.words") < F.col("__size")
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(partial, F.length(F.array_join(lead, "")))
                               .otherwise(F.col("n_chars")).cast(dict(docs.dtypes)["n_chars"]))
    rows = rows.withColumn("text", F.when(partial, F.array_join(lead, "")).otherwise(F.col("text")))
    tie = ["doc_id", F.col("__visit.turn")]
    ordered = rows.repartitionByRange(F.col("__visit.position"), *tie) \
        .sortWithinPartitions(F.col("__visit.position"), *tie)
    return unpacked(ordered, docs.columns, own)
