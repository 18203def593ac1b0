import random
import re
from collections import Counter

import numpy as np

from wattmirror.llm import quality
from wattmirror.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(inside))


def plain_longest(words):
    """For each position: the longest common prefix with any other suffix."""
    out = []
    for i in range(len(words)):
        best = 0
        for j in range(len(words)):
            if i != j:
                k = 0
                while max(i, j) + k < len(words) and words[i + k] == words[j + k]:
                    k += 1
                best = max(best, k)
        out.append(best)
    return out


def test_repeats_equal_all_suffix_pairs():
    rng = random.Random(1)
    for _ in range(60):
        texts = [[rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.randint(0, 40))] for _ in range(rng.randint(1, 4))]
        ids = np.array([w for t in texts for w in t], dtype=np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        assert quality.repeats(ids, owner).tolist() == [x for t in texts for x in plain_longest(t)]


def test_counts_equal_the_contract():
    rng = random.Random(2)
    texts = ["", "\n\n", "a#b $ % & | < > *", "é é é é é é é é é é é é", "x\ny\nx\n x\nx "]
    for _ in range(200):
        texts.append("".join(rng.choice(["a", "bc", "ü", "#", " ", " ", "\n", "\t"]) for _ in range(rng.randint(0, 120))))
    m = quality.measure(texts)
    for i, text in enumerate(texts):
        assert tuple(int(m[k][i]) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == \
            plain_counts(text), text


def test_verdict(docs_of):
    rng = random.Random(3)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    passage, long = fresh(30), fresh(130)
    docs = docs_of([(1, fresh(300)), (2, " ".join([passage, fresh(40), passage, fresh(200)])), (3, "too short"),
                    (4, " ".join([long, fresh(900), long, fresh(900)])), (5, " ".join([fresh(9), passage] * 5)),
                    (6, " ".join([passage, fresh(500), passage]))])
    got = {r.doc_id: r for r in quality.judge(docs, ["doc_id"]).collect()}
    assert [got[i].kept for i in range(1, 7)] == [True, False, False, False, False, True]
    assert [got[i].base_failed for i in range(1, 7)] == [False, False, True, False, True, False]
    assert got[2].covered_words == 60 and got[2].longest_repeat == 30 and got[4].longest_repeat == 130


def test_odd_rows(docs_of, odd_rows, clashes):
    docs = docs_of(odd_rows, clashes)
    rows = quality.judge(docs, ["doc_id"]).collect()
    assert len(rows) == len(odd_rows)
    got = {r.doc_id: r for r in rows}
    assert got[1].n_words == 0 and got[1].base_failed and not got[1].kept
    assert got[7].n_words == 30_000 and got[7].n_repeat_words == 30_000 and got[7].longest_repeat == 29_999
    assert got[5].kept and quality.judge(docs.limit(0), ["doc_id"]).count() == 0


def test_query_equals_the_contract(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op10_quality_rules"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, *_, repeated = want = plain_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (n < 10 or 100 * repeated > 20 * n) and (not r.kept or not r.base_failed)
