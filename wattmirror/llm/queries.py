"""The registered queries of this subpackage, over the whole tables, and what SQL can state of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmirror.llm import (ann, collocations, conversations, langid, mixing, packing, pii, quality, sharding, simhash,
                            suffixes, toxicity, urlfilter)
from wattmirror.llm.common import read, split_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return register


@query("op1_pii")
def op1(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    found = pii.detect(docs, pii.train(docs), ["doc_id"])
    own = F.when(F.col("base_spans") == "", F.array().cast("array<string>")).otherwise(F.split("base_spans", ","))

    def count(kind):
        return F.size(F.filter(own, lambda s: s.startswith(kind + ":"))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in pii.KINDS],
                        F.sha2(F.col("base_spans"), 256).alias("base_sha256"), "spans")


@query("op2_simhash_near_dedup")
def op2(spark, sf_dir):
    return simhash.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query("op3_mix_sources")
def op3(spark, sf_dir):
    taken = F.aggregate("__visits", F.lit(0).cast("long"), lambda a, v: a + v["words"])
    first = F.try_element_at("__visits", F.lit(1))["position"]
    rows = mixing.curriculum(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return rows.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
                       F.col("__target").alias("target"), taken.alias("taken"), first.alias("position")) \
        .repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


@query("op4_suffix_array_dedup")
def op4(spark, sf_dir):
    return suffixes.passages(read(spark, sf_dir, "documents"))


@query("op5_nearest_neighbours")
def op5(spark, sf_dir):
    points = ann.usable(read(spark, sf_dir, "embeddings"))
    return ann.search(points, points.where("vec_id % 50 = 0"), 5)


@query("op6_language_id")
def op6(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    held = split_of("doc_id", 4) == 2
    return langid.predict(docs.withColumn("held_out", held), langid.learn(docs.where(~held)), ["doc_id", "held_out"])


@query("op7_toxicity")
def op7(spark, sf_dir):
    docs, held = read(spark, sf_dir, "documents"), split_of("doc_id", 5) == 0
    model = toxicity.train(docs, read(spark, sf_dir, "labels").where(~held))
    return toxicity.score(docs.withColumn("held_out", held), model, ["doc_id", "held_out"])


@query("op8_pack_best_fit")
def op8(spark, sf_dir):
    return packing.pack(read(spark, sf_dir, "documents"), with_ids=False)


@query("op9_shard_shuffle")
def op9(spark, sf_dir):
    rows = sharding.external_shuffle(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.col("__size").alias("size"),
                       F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
                       F.lit("rows").alias("law"), F.col("__shard").alias("shard"), F.col("__slot").alias("slot"),
                       F.lit(None).cast("int").alias("grown_shard"))


@query("op10_quality_rules")
def op10(spark, sf_dir):
    return quality.judge(read(spark, sf_dir, "documents"), ["doc_id"])


@query("op11_url_filter", urlfilter.ORACLE)
def op11(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    return urlfilter.judge(pages, urlfilter.labelled(pages), ["page_id"])


@query("op12_collocations", collocations.ORACLE)
def op12(spark, sf_dir):
    return collocations.rank(read(spark, sf_dir, "documents"))


@query("op13_conversation_repair")
def op13(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations")
    return conversations.report(conversations.damage(turns), turns)


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
