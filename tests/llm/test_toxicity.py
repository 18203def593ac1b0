import itertools
import random

import numpy as np
import pytest

from wattmirror.llm import crf, toxicity
from wattmirror.llm.queries import QUERIES

WORDS = [a + b for a in ("ba", "do", "ki", "lu", "me", "no") for b in ("ra", "sti", "fel", "gon", "win")]
BAD = ["scumbag", "trollface", "jerkwad"]


def corpus(n, seed):
    rng = random.Random(seed)
    for i in range(n):
        words = [rng.choice(WORDS) + rng.choice(["", ",", "."]) for _ in range(rng.randint(10, 60))]
        toxic = i % 5 == 0
        for _ in range(rng.randint(2, 4) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "s", "!"]))
        yield i, " ".join(words), int(toxic)


@pytest.fixture(scope="module")
def model(spark):
    rows = list(corpus(600, 1))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(5, None), (None, 1)], "doc_id long, toxic int")
    return toxicity.train(docs, labels)


def field(rng):
    f = crf.Field.fresh()
    f.move = rng.normal(0, 1, (2, 2))
    f.start = 0.3
    return f


def chain_score(f, gains, path):
    return sum(gains[t] for t, y in enumerate(path) if y) + (f.start if path[0] else 0) + sum(
        f.move[a, b] for a, b in zip(path, path[1:]))


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    f = field(rng)
    gains = rng.normal(0, 2, (6, 3))
    live = np.ones((6, 3), bool)
    live[4:, 1] = False
    got = f.marginals(gains, live)
    expected, pair = f._expected(gains, live)
    pairs = np.zeros((2, 2))
    for n, steps in enumerate((6, 4, 6)):
        paths = list(itertools.product((0, 1), repeat=steps))
        weight = np.exp([chain_score(f, gains[:, n], p) for p in paths])
        weight /= weight.sum()
        for t in range(steps):
            want = sum(w for w, p in zip(weight, paths) if p[t])
            assert got[t, n] == pytest.approx(want) and expected[t, n] == pytest.approx(want)
        for w, p in zip(weight, paths):
            for a, b in zip(p, p[1:]):
                pairs[a, b] += w
    assert np.allclose(pair, pairs)


def test_training_raises_the_likelihood():
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 50, (200, 8, crf.PER_WORD)) + 50 * np.arange(crf.PER_WORD)
    tags = (ids[:, :, 0] < 10).astype(int)
    f = crf.Field.fresh().fit(ids, tags, np.ones((200, 8), bool), 60, 0.3, 1)
    gains = f.here[ids.transpose(1, 0, 2)].sum(axis=2)
    assert ((f.marginals(gains, np.ones((8, 200), bool)).T > 0.5) == tags).mean() > 0.95


def test_chains_of_a_text_equal_one_chain(model):
    """Cut into overlapping chains, every word has nearly the chance it has in the whole text."""
    rng = random.Random(4)
    words = [rng.choice(WORDS + BAD) for _ in range(150)]
    got = toxicity.word_chances([words, [], words[:3]], model.words)
    gains = np.array([model.words.of_word(w) for w in words])
    whole = gains[:, 0].copy()
    whole[1:] += gains[:-1, 1]
    whole[:-1] += gains[1:, 2]
    want = model.words.marginals(whole[:, None], np.ones((150, 1), bool))[:, 0]
    assert np.abs(got[0] - want).max() < 0.02 and [len(g) for g in got] == [150, 0, 3]


def test_held_out_documents_and_offsets(model):
    rows = list(corpus(300, 2))
    scores, spans = toxicity.score_texts([t for _, t, _ in rows], model)
    right = sum((s >= 0.5) == bool(y) for s, (_, _, y) in zip(scores, rows))
    assert right >= 297
    for (_, text, toxic), own in zip(rows, spans):
        marked = " ".join(text[a:b] for a, b in own).split()
        assert sum(any(b in w for b in BAD) for w in marked) >= 0.9 * sum(any(b in w for b in BAD) for w in text.split())


def test_training_does_not_depend_on_partitions(spark, model):
    rows = list(corpus(600, 1))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(7)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int").repartition(3)
    again = toxicity.train(docs, labels)
    assert np.array_equal(again.words.here, model.words.here) and np.allclose(again.weights, model.weights)


def test_odd_rows(spark, docs_of, odd_rows, clashes, model):
    docs = docs_of(odd_rows, clashes)
    rows = toxicity.score(docs, model, ["doc_id"]).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 and r.predicted == 0 and r.spans == "" for r in rows if r.doc_id in (1, 2, 3))
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.train(docs, labels) is None
    one_sided = spark.createDataFrame([(5, 1)], "doc_id long, toxic int")
    assert toxicity.train(docs, one_sided) is None
    assert {r.score for r in toxicity.score(docs, None, ["doc_id"]).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model, docs.columns[:2]).count() == 0


def test_query(spark):
    import zlib
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op7_toxicity"](spark, sf).collect()
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(p == y for p, y in held) / len(held) > 0.9


def test_labels_other_than_0_and_1_are_left_out(docs_of, spark):
    docs = docs_of([(i, "you vile wretch" if i % 2 else "a fine day") for i in range(40)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(38)] + [(38, 7), (39, -1), (1, None)], "doc_id long, toxic int")
    assert toxicity.train(docs, labels) is not None
