"""From raw documents to packed training sequences, in stages that are each written before the next one reads."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from wattmirror.llm import mixing, packing, pii, simhash, toxicity
from wattmirror.llm.common import packed, pin, read, split_of, unpacked


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the CRF does not find toxic; it learns from the labelled rows outside the held-out fold.

    Null and empty texts score 0 and stay. Each row is judged for itself, so repeated rows, ties and rows with one id
    share their verdict; texts are read whole. An empty table gives no rows. Without labels nothing is dropped.
    """
    model = toxicity.train(docs, read(spark, sf_dir, "labels").where(split_of("doc_id", 5) != 0))
    held = packed(docs, ["text"])
    return unpacked(toxicity.score(held, model, held.columns).where("predicted = 0"), docs.columns, ["text"])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest doc_id, nulls last, then the smallest text hash.

    Of equal rows one stays. Null texts count as empty, and of all texts without words one stays. Texts are read whole;
    an empty table gives no rows.
    """
    return simhash.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """E-mail addresses, IP addresses, card and phone numbers become placeholders; n_chars follows the text.

    All rows stay. Null texts stay null, empty ones empty; equal texts get equal results, whatever their ids; texts are
    read whole. An empty table gives no rows.
    """
    return pii.redact(docs, pii.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources repeated or thinned to their target weights, in training order.

    A null source is a source of its own. Documents without words (null, empty) go, as no target counts them. Repeated
    rows are taken one after the other; ties in position go by doc_id. At most one text of a source is cut, to its
    first words. An empty table gives no rows.
    """
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 ids and their places in sequences.

    A null or empty text is its closing id alone. Rows with one doc_id, or a null one, are packed like any other; texts
    of any length are cut into pieces. An empty table gives no rows. Only doc_id and text are read.
    """
    return packing.pack(docs)


# Columns beside doc_id, text, lang, source and n_chars pass all stages but the last, whatever their names.
STAGES = [("toxicity", drop_toxic), ("near copies", drop_near_copies), ("personal data", mask_personal_data),
          ("mix", mix_sources), ("pack", pack_sequences)]

# Trained taggers, 64-bit hashes and a BPE vocabulary are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = pin(stage(spark, docs, sf_dir), f"stage{n}-{uuid.uuid4().hex[:8]}")
    return docs
