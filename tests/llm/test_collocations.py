import random
import re
from collections import Counter

import numpy as np
import pytest

from wattmirror.llm import collocations, fm_index

FIELDS = "lang, rank, phrase, a, l, r, n, score"


def plain_counts(docs, longest):
    counts = {}
    for text, lang in docs:
        own = counts.setdefault(lang or "und", Counter())
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            for d in range(1, longest + 1):
                own.update(tuple(words[i:i + d]) for i in range(len(words) - d + 1))
    return counts


def plain_rank(docs, least, top, longest=4):
    out = []
    for lang, f in plain_counts(docs, longest).items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        candidates = {g: c for g, c in f.items() if len(g) > 1 and c >= least}
        rows = []
        for g, a in candidates.items():
            if any(len(h) > len(g) and 100 * c >= 80 * a and any(h[i:i + len(g)] == g for i in range(len(h)))
                   for h, c in candidates.items()):
                continue
            score, k = min((2_000_000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
            rows.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*FIELDS.split(", ")).collect())


def sample(rng, n):
    words = ["the", "of", "New", "york", "City", "é", "日本", "a\u001cb", "x" * 40, "hall"]
    fixed = ["new york city hall", "of the city", "é 日本 the", "the the the the the"]
    docs = []
    for _ in range(n):
        parts = [rng.choice([rng.choice(fixed), " ".join(rng.choice(words) for _ in range(rng.randint(0, 6)))])
                 for _ in range(rng.randint(0, 8))]
        docs.append((rng.choice([". ", ",", "\t", " ", "\n", "!? "]).join(parts), rng.choice(["en", "en", "de", None])))
    return docs


def test_backward_search_and_extension_equal_counting():
    rng = random.Random(1)
    for _ in range(150):
        text = np.array([0] + [rng.randrange(rng.choice([2, 4, 9])) for _ in range(rng.randint(1, 60))] + [0])
        for depth in (1, 2, 3):
            every = [tuple(text[i:i + depth]) for i in range(text.size - depth + 1)]
            counts = Counter(g for g in every if 0 not in g)
            chosen = sorted(g for g in counts if rng.random() < .7)
            if not chosen:
                continue
            patterns = np.array(chosen)
            low, size = fm_index.Half(text, depth + 1).search(patterns)
            assert size.tolist() == [counts[g] for g in chosen]
            prefix, suffix, number, place = fm_index.Index(text, depth + 1).extend(patterns)
            got = {chosen[p] + chosen[s][-1:]: c for p, s, c in zip(prefix, suffix, number)}
            longer = Counter(tuple(text[i:i + depth + 1]) for i in range(text.size - depth))
            assert got == {g: c for g, c in longer.items() if g[:-1] in chosen and g[1:] in chosen}
            assert all(tuple(text[at:at + depth + 1]) == chosen[p] + chosen[s][-1:] for p, s, at in zip(prefix, suffix, place))
            a, b, c, at = collocations.longer(text, np.array([every.index(g) for g in chosen]), depth)
            assert {chosen[p] + chosen[s][-1:]: k for p, s, k in zip(a, b, c)} == got
            assert all(tuple(text[i:i + depth + 1]) == chosen[p] + chosen[s][-1:] for p, s, i in zip(a, b, at))


@pytest.mark.parametrize("shard_bytes,held_bytes", [(60, 200), (8 << 20, 32 << 20)])
def test_rank_equals_counting(spark, shard_bytes, held_bytes):
    docs = sample(random.Random(shard_bytes), 150)
    df = spark.createDataFrame(docs, "text string, lang string").repartition(3)
    got = rows_of(collocations.rank(df, least=4, top=15, shard_bytes=shard_bytes, held_bytes=held_bytes))
    assert got == plain_rank(docs, 4, 15) and len(got) > 20


def test_phrases_link_to_both_ends(spark):
    docs = sample(random.Random(9), 80)
    levels, totals = collocations.phrases(spark.createDataFrame(docs, "text string, lang string"), least=3, shard_bytes=100)
    counts = plain_counts(docs, 4)
    for d, level in enumerate(levels, 1):
        rows = level.collect()
        assert {(r["lang"], tuple(r["phrase"].split(" "))): r["f"] for r in rows} == \
            {(lang, g): c for lang, own in counts.items() for g, c in own.items() if len(g) == d and c >= 3}
        if d > 1:
            for r in rows:
                words = r["phrase"].split(" ")
                assert shorter[r["prefix"]] == " ".join(words[:-1]) and shorter[r["suffix"]] == " ".join(words[1:])
        shorter = {r["id"]: r["phrase"] for r in rows}


def test_odd_rows(spark, docs_of, odd_rows, clashes):
    df = docs_of(odd_rows, clashes)
    assert rows_of(collocations.rank(df, least=2)) == plain_rank([(r[1], r[2]) for r in odd_rows], 2, 2000)
    assert rows_of(collocations.rank(df.where("doc_id < 0"))) == []
    blank = docs_of([(1, " . \n,", "en"), (2, None, None)])
    assert rows_of(collocations.rank(blank, least=1)) == []


def test_large_numbers_pass_64_bits(spark):
    assert spark.sql("SELECT (CAST(9000000000000 AS DECIMAL(20, 0)) * 2000000) div "
                     "(CAST(9000000000000 AS DECIMAL(20, 0)) + CAST(9000000000000 AS DECIMAL(20, 0))) AS x").first()["x"] == 1_000_000


def test_a_long_piece_is_one_shard_and_long_texts_are_cut():
    assert list(collocations._cut(b"a b\xffc\xff" * 4, 5)) == [b"a b\xffc", b"a b\xffc", b"a b\xffc", b"a b\xffc", b""]
    assert list(collocations._cut(b"a " * 50, 5)) == [b"a " * 50]
