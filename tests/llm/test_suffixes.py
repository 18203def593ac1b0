import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from wattmirror.llm import suffixes
from wattmirror.llm.queries import QUERIES


def plain(texts, least=50):
    """For each text the words in a passage of `least` words that occurs at two places of the corpus."""
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i:i + least]) for w in words for i in range(len(w) - least + 1))
    out = []
    for w in words:
        inside = np.zeros(len(w), bool)
        for i in range(len(w) - least + 1):
            if seen[tuple(w[i:i + least])] > 1:
                inside[i:i + least] = True
        out.append(inside)
    return out


def found(row):
    inside = np.zeros(row.n_words, bool)
    for span in filter(None, row.spans.split(",")):
        a, b = map(int, span.split(":"))
        assert b - a >= 50
        inside[a:b] = True
    assert inside.sum() == row.repeated_words
    return inside


def test_every_passage_holds_a_minimiser_at_the_same_place():
    rng = np.random.default_rng(1)
    for _ in range(300):
        passage = rng.integers(0, 2 ** 63, 50).astype(np.uint64)
        places = []
        for _ in range(2):
            before, after = (rng.integers(0, 2 ** 63, rng.integers(0, 80)).astype(np.uint64) for _ in range(2))
            at = suffixes.minimisers(suffixes.grams(np.concatenate([before, passage, after]))) - before.size
            places.append(set(at[(at >= 0) & (at <= 50 - suffixes.GRAM)].tolist()))
        assert places[0] & places[1]


def test_minimisers_equal_least_of_each_window():
    rng = np.random.default_rng(2)
    for n in (1, 5, 38, 39, 40, 200):
        hashes = rng.integers(0, 20, n).astype(np.uint64)
        want = {s + int(hashes[s:s + suffixes.WINDOW].argmin()) for s in range(max(1, n - suffixes.WINDOW + 1))}
        assert suffixes.minimisers(hashes).tolist() == sorted(want)


def corpus(seed):
    rng = random.Random(seed)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    shared = [fresh(n) for n in (49, 50, 51, 60, 140, 400)]
    texts = []
    for i in range(120):
        parts = [fresh(rng.randint(0, 90))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice(shared), fresh(rng.randint(0, 70))]
        texts.append(" ".join(parts))
    texts += [shared[3]] * 3 + [texts[5]] * 2 + [fresh(200) + " " + shared[2] + " " + fresh(3) + " " + shared[2]]
    return texts


def test_spans_equal_brute_force(spark):
    texts = corpus(3)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = plain(texts)
    got = suffixes.passages(df).collect()
    assert len(got) == len(texts)
    for r in got:
        assert np.array_equal(found(r), want[r.doc_id]), r.doc_id
    assert {r.copies for r in got} >= {1, 3}


def test_a_passage_in_most_documents(spark):
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(70))
    texts = [" ".join(f"x{rng.randrange(10**7)}" for _ in range(20)) + " " + passage + f" y{i}" for i in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    for r in suffixes.passages(df).collect():
        assert r.spans == "20:90"


def test_texts_of_one_64_bit_key_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "text_keys", lambda text: (F.lit(7).cast("long"), F.xxhash64(F.lit(suffixes.SECOND_SEED), text)))
    texts = corpus(6)
    want = plain(texts)
    for r in suffixes.passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        assert np.array_equal(found(r), want[r.doc_id]) and r.copies == texts.count(texts[r.doc_id])


def test_a_large_group_of_copies(spark):
    rng = random.Random(8)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage = fresh(55)
    texts = [fresh(30) + " " + passage + " " + fresh(20)] * 2000 + [fresh(9) + " " + passage, fresh(80)]
    rows = {r.doc_id: r for r in suffixes.passages(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)).collect()}
    assert {(rows[i].copies, rows[i].spans) for i in range(2000)} == {(2000, "0:105")}
    assert rows[2000].spans == "9:64" and rows[2001].spans == "" and len(rows) == 2002


def test_odd_rows(docs_of, odd_rows, clashes):
    docs = docs_of(odd_rows, clashes)
    rows = suffixes.passages(docs).collect()
    assert len(rows) == len(odd_rows)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[7].spans == "0:30000" and by_id[8].repeated_words == by_id[8].n_words == 120
    assert by_id[1].n_words == 0 and by_id[5].copies == 3 and by_id[5].spans == ""
    assert suffixes.passages(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = dict(zip((d.doc_id for d in docs), plain([d.text for d in docs])))
    for r in QUERIES["op4_suffix_array_dedup"](spark, sf).collect():
        assert np.array_equal(found(r), want[r.doc_id])
