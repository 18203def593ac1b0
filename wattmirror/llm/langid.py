"""Language of a text by compression: the zstandard dictionary that makes it smallest names its language."""

from __future__ import annotations

import functools

import numpy as np
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattmirror.llm.common import map_texts

# Per language: characters of raw dictionary content, and the most characters that one document adds to it.
DICTIONARY_CHARS, PART_CHARS = 96_000, 400
DOCUMENTS = DICTIONARY_CHARS // PART_CHARS
UNKNOWN = "und"
# Below this share of the second best size the best language is not told apart and counts as rejected.
LEAST_MARGIN = 0.01


def learn(labelled: DataFrame) -> dict[str, bytes]:
    """Raw dictionary content per language, from rows with text and non-null lang.

    The sample is bounded: the first PART_CHARS of at most DOCUMENTS texts of a language, those of least text hash.
    Copies, and texts that begin alike so far, count once: what is taken is DOCUMENTS different parts, if there are
    as many. A language holding most rows is thinned by hash range first, so no task gets all its rows. The driver
    holds one dictionary per language.
    """
    rank = F.xxhash64("text")
    rows = labelled.where(F.col("lang").isNotNull() & (F.length("text") > 0)) \
        .select(F.col("lang").alias("lang"), rank.alias("rank"), F.substring("text", 1, PART_CHARS).alias("part")) \
        .groupBy("lang", "part").agg(F.min("rank").alias("rank"))
    first = Window.partitionBy("lang", F.pmod(F.col("rank"), F.lit(256))).orderBy("rank", "part")
    thin = rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= DOCUMENTS)
    last = Window.partitionBy("lang").orderBy("rank", "part")
    picked = thin.withColumn("n", F.row_number().over(last)).where(F.col("n") <= DOCUMENTS)
    found: dict[str, list[str]] = {}
    for r in picked.orderBy("lang", "n").select("lang", "part").collect():
        found.setdefault(r.lang, []).append(r.part)
    return {lang: " ".join(parts).lower().encode("utf-8", "replace") for lang, parts in found.items()}


def _has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text[:200]) or any(map(str.isalpha, text))


def predict(docs: DataFrame, content: dict[str, bytes], keep: list[str]) -> DataFrame:
    """The kept columns with lang_pred, score (0 to 1) and rejected.

    The whole text, in lower case, is encoded once with each language's dictionary. lang_pred is the language of the
    smallest result, ties to the language first by code point; `und` for a null text or one without a letter, and
    where nothing was learned. score is the best language's share when sizes are compared as code lengths.
    rejected tells that the margin to the second is narrow or nothing was told; lang_pred still names the best.
    Repeated rows get equal results; an empty table gives no rows.
    """
    names = sorted(content)

    def work(texts):
        coders = [_coder(content[n]) for n in names]
        langs, scores, rejected = [], [], []
        for text in texts:
            if not names or not _has_letter(text):
                langs.append(UNKNOWN)
                scores.append(0.0)
                rejected.append(True)
                continue
            data = text.lower().encode("utf-8", "replace")
            sizes = np.array([len(c.compress(data)) for c in coders], dtype=np.float64)
            order = np.argsort(sizes, kind="stable")
            best = int(order[0])
            weights = np.exp2(-np.minimum((sizes - sizes[best]) * 0.5, 60.0))
            margin = 1.0 if len(names) == 1 else 1 - sizes[best] / sizes[order[1]]
            langs.append(names[best])
            scores.append(float(1 / weights.sum()))
            rejected.append(bool(margin < LEAST_MARGIN))
        return [langs, scores, rejected]

    return map_texts(docs, keep, "lang_pred string, score double, rejected boolean", work)


@functools.lru_cache(maxsize=64)
def _coder(content: bytes) -> zstandard.ZstdCompressor:
    """Short matches count here: words of four letters are worth a reference to the dictionary."""
    how = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_GREEDY, min_match=4, search_log=4, window_log=20, chain_log=18, hash_log=17,
        write_content_size=False, write_checksum=False, write_dict_id=False)
    made = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    made.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=made, compression_params=how)
