import random

import numpy as np
import pytest
import xxhash

from wattmirror.llm import components, simhash
from wattmirror.llm.queries import QUERIES


def plain_print(text, words=3):
    tokens = text.encode().lower().split()
    shingles = [b" ".join(tokens[i:i + words]) for i in range(len(tokens) - words + 1)] or \
        ([b" ".join(tokens)] if tokens else [])
    out = 0
    for bit in range(64):
        ones = sum(xxhash.xxh64_intdigest(s, 42) >> bit & 1 for s in shingles)
        out |= (2 * ones > len(shingles)) << bit
    return out


def plain_classes(prints, bits=3):
    """Smallest reachable index by comparing all pairs."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprint_equals_bit_counts():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 30):
        text = " ".join(rng.choice(["A", "b", "Ü", "dog", " x"]) for _ in range(n))
        assert simhash.fingerprint(text) == plain_print(text)
    assert simhash.fingerprint("A\tb\x0bC") == simhash.fingerprint(" a  B c\n")


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 4, 5])
def test_anchors_meet_every_pair_within_the_threshold(bits):
    rng = random.Random(bits)
    base = [rng.getrandbits(64) for _ in range(300)] + [0, 2 ** 64 - 1]
    near = []
    for b in base:
        for _ in range(rng.randint(0, bits)):
            b ^= 1 << rng.randrange(64)
        near.append(b)
    homes, arrivals = {}, {}
    for fps, into in ((base, homes), (near, arrivals)):
        for key, index, home in simhash._anchors(np.array(fps, dtype=np.uint64).view(np.int64), bits):
            for k, i, h in zip(key.tolist(), index.tolist(), home.tolist()):
                if h or into is arrivals:
                    into.setdefault(i, set()).add(k)
    assert all(homes[i] & arrivals[i] for i in range(len(base)))
    assert max(map(len, arrivals.values())) < 200


@pytest.mark.parametrize("bits", [1, 3, 5])
def test_classes_equal_all_pairs(spark, bits):
    rng = random.Random(7)
    prints = [0, 0]
    for _ in range(60):
        seed = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 40])):           # small groups and crowded ones, chained by few flips
            prints.append(seed)
            for _ in range(rng.randint(0, 4)):
                seed ^= 1 << rng.randrange(64)
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    got = df.join(simhash.classes(df, bits), "fp").collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(plain_classes(prints, bits)))


def test_crowded_anchor_is_split(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOMES_PER_TASK", 5)
    rng = random.Random(3)
    seed, prints = rng.getrandbits(64), []
    for _ in range(150):
        prints.append(seed ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    got = df.join(simhash.classes(df), "fp").collect()
    assert {r.doc_id: r.component_id for r in got} == dict(enumerate(plain_classes(prints)))


def test_links_of_a_crowd_span_it_without_all_pairs(spark):
    prints = [1 << i for i in range(60)]                      # all within two bits of each other
    signed = np.array(prints, dtype=np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(s,) for s in signed], "fp long")
    links = simhash.links(df).distinct().count()
    assert 59 <= links < 60 * 59 / 2


def test_components_equal_search(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(200, 260)] + [(rng.randrange(150), rng.randrange(150)) for _ in range(90)] \
        + [(5, 5), (-3, 7), (7, -3)] + [(1000, x) for x in range(1001, 1050)]
    got = {r.node: r.root for r in components.roots(spark.createDataFrame(edges, "u long, v long")).collect()}
    near = {}
    for u, v in edges:
        if u != v:
            near.setdefault(u, set()).add(v)
            near.setdefault(v, set()).add(u)
    want = {}
    for start in sorted(near):
        todo = [start] if start not in want else []
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = start
                todo += near[x]
    assert got == want
    assert components.roots(spark.createDataFrame([], "u long, v long")).count() == 0


def test_odd_rows(spark, docs_of, odd_rows, clashes):
    docs = docs_of(odd_rows, clashes)
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == len(odd_rows)
    prints = [plain_print(t or "") for _, t, *_ in odd_rows]
    group = {}
    for (doc_id, *_), c in zip(odd_rows, plain_classes(prints)):
        group.setdefault(c, []).append(doc_id)
    want = sorted((str(d), str(min((x for x in ids if x is not None), default=None))) for ids in group.values() for d in ids)
    assert sorted((str(r.doc_id), str(r.component_id)) for r in rows) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(min((x for x in ids if x is not None), default=None)) for ids in group.values())
    empty = docs.limit(0)
    assert simhash.near_duplicates(empty).count() == simhash.keep_one(empty).count() == 0


def test_keep_one_of_rows_without_ids(docs_of):
    docs = docs_of([(None, "a b c d"), (None, "a b c d"), (None, "totally other words here"), (4, "a b c d")])
    kept = sorted((str(r.doc_id), r.text) for r in simhash.keep_one(docs).collect())
    assert kept == [("4", "a b c d"), ("None", "totally other words here")]


def test_query_equals_all_pairs(spark):
    sf = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    prints = [plain_print(t) for _, t in docs]
    want = {docs[i][0]: (f"{prints[i]:016x}", docs[c][0]) for i, c in enumerate(plain_classes(prints))}
    got = QUERIES["op2_simhash_near_dedup"](spark, sf).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == want
