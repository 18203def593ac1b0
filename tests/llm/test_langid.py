import random
import zlib

import pytest
from pyspark.sql import functions as F

from wattmirror.llm import langid
from wattmirror.llm.queries import QUERIES

SOUNDS = {"aa": ["bana", "kolo", "miru", "tase", "wopi"], "bb": ["schtr", "krugz", "vlomp", "zdrin", "phlox"]}


def text(lang, rng, n):
    return " ".join(rng.choice(SOUNDS[lang]) + rng.choice(SOUNDS[lang]) for _ in range(n))


@pytest.fixture(scope="module")
def content(spark):
    rng = random.Random(1)
    rows = [(text(lang, rng, 40), lang) for _ in range(80) for lang in SOUNDS] + [(None, "aa"), ("bana", None), ("", "bb")]
    return langid.learn(spark.createDataFrame(rows, "text string, lang string"))


def test_learned_content_is_bounded_and_repeatable(spark, content):
    assert set(content) == {"aa", "bb"}
    assert all(len(c) <= langid.DICTIONARY_CHARS + langid.DOCUMENTS for c in content.values())
    rng = random.Random(1)
    rows = [(text(lang, rng, 40), lang) for _ in range(80) for lang in SOUNDS]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    assert langid.learn(df) == content
    many = spark.createDataFrame([("x" * 900 + str(i), "cc") for i in range(3000)], "text string, lang string")
    assert len(langid.learn(many)["cc"]) <= langid.DICTIONARY_CHARS + langid.DOCUMENTS


@pytest.mark.parametrize("tail", ["", "id"])
def test_copies_count_once(spark, tail):
    """A third of the rows is one text, or begins as one, and comes first in hash order."""
    rng = random.Random(3)
    texts = [text("aa", rng, 80) for _ in range(800)]
    df = spark.createDataFrame([(t, "aa") for t in texts], "text string, lang string")
    common = df.orderBy(F.xxhash64("text")).first().text
    copies = spark.range(400).select(F.concat(F.lit(common), F.col(tail).cast("string") if tail else F.lit(""))
                                     .alias("text"), F.lit("aa").alias("lang"))
    learned, plain = langid.learn(df.union(copies))["aa"], langid.learn(df)["aa"]
    parts = {t[:langid.PART_CHARS].encode() for t in texts}
    width = langid.PART_CHARS + 1
    taken = [learned[i:i + width - 1] for i in range(0, len(learned), width)]
    assert len(taken) == len(set(taken)) == langid.DOCUMENTS and set(taken) <= parts
    assert tail or learned == plain


def test_held_out_texts(spark, content):
    rng = random.Random(2)
    rows = [(i, text(lang, rng, 8), lang) for i, lang in enumerate(["aa", "bb"] * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = langid.predict(df, content, ["doc_id", "lang"]).collect()
    assert all(r.lang_pred == r.lang and r.score > 0.5 for r in got) and not any(r.rejected for r in got)


def test_odd_rows(docs_of, odd_rows, clashes, content):
    docs = docs_of([*odd_rows, (20, "12 34 !!", "en", "a"), (21, "q", "en", "a")], clashes)
    rows = {str(r.doc_id): r for r in langid.predict(docs, content, ["doc_id"]).collect()}
    for empty in ("1", "2", "3", "20"):
        assert (rows[empty].lang_pred, rows[empty].score, rows[empty].rejected) == ("und", 0.0, True)
    assert rows["21"].lang_pred in SOUNDS and rows["21"].rejected
    assert all(0 <= r.score <= 1 for r in rows.values())
    assert {r.lang_pred for r in langid.predict(docs, {}, ["doc_id"]).collect()} == {"und"}
    assert langid.learn(docs.limit(0)) == {} and langid.predict(docs.limit(0), content, ["doc_id"]).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op6_language_id"](spark, sf).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert sum(held) / len(held) > 0.97


def test_query_equals_plain_sizes_text_by_text(spark):
    """Every text under every language's dictionary, each with a compressor of its own: the smallest wins."""
    import zstandard

    from wattmirror.llm import langid
    from wattmirror.llm.common import read, split_of
    from wattmirror.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    docs = read(spark, sf, "documents")
    content = langid.learn(docs.where(split_of("doc_id", 4) != 2))
    how = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_GREEDY, min_match=4, search_log=4, window_log=20, chain_log=18, hash_log=17,
        write_content_size=False, write_checksum=False, write_dict_id=False)

    def smallest(text):
        if text is None or not any(map(str.isalpha, text)):
            return "und"
        data = text.lower().encode("utf-8", "replace")
        sizes = {lang: len(zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(
            raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=how).compress(data)) for lang, raw in content.items()}
        return min(sorted(sizes), key=sizes.get)

    want = {r.doc_id: smallest(r.text) for r in docs.select("doc_id", "text").collect()}
    assert {r.doc_id: r.lang_pred for r in QUERIES["op6_language_id"](spark, sf).collect()} == want
