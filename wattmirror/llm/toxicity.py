"""Toxic spans and documents by a linear-chain CRF over words.

Document labels become word labels first: in a bounded sample of labelled documents every hashed word feature gets
the number of toxic and clean documents it occurs in, and words of toxic documents whose features are far more usual
there are marked. The CRF learns from windows around marked words and of clean text. A document is scored from the
forward-backward marginals of all its words, calibrated on the part of the sample that the CRF did not learn from.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattmirror.llm.common import WORD, chunks, map_texts, pin
from wattmirror.llm.crf import LEXICAL, PER_WORD, SPACE, Field, features

WORDS = re.compile(WORD)
STEPS = 32                      # words of a training window, and of the chains that a text is cut into, less overlap
OVERLAP = 8
# Labelled documents to learn from, about: by a hash of id and text, so many of either label.
SAMPLE_TOXIC, SAMPLE_CLEAN = 4_000, 8_000
SAMPLE_WINDOWS = 6_000          # the most windows the CRF is trained on, half of them from toxic documents
SAMPLE_PARTS = 24
UPDATES, RATE, SEED = 150, 0.3, 11
# A feature marks a word if so many and such a share of the toxic documents have it, and it is so much more usual there.
LEAST_DOCUMENTS, LEAST_SHARE, LEAST_RATIO = 3, 0.015, 25.0


@dataclass
class Model:
    """The word CRF, and the weights that turn a document's marginals into its score."""
    words: Field
    weights: np.ndarray


def _feature_counts(train: DataFrame) -> DataFrame:
    """(feature, toxic, clean): in how many documents of each label a feature occurs."""
    def run(batches):
        for batch, texts in chunks(batches):
            label = np.array(batch.column(1).to_pylist())
            count = np.zeros((2, SPACE), dtype=np.int32)
            known: dict[str, tuple] = {}
            for text, toxic in zip(texts, label):
                ids = set()
                for w in set(WORDS.findall(text)):
                    got = known.get(w)
                    if got is None:
                        got = known[w] = features(w)[:LEXICAL]
                    ids.update(got)
                if ids:
                    count[int(toxic)][np.fromiter(ids, np.int64, len(ids))] += 1
            hit = np.flatnonzero(count.sum(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(count[1][hit], pa.int64()),
                                              pa.array(count[0][hit], pa.int64())], ["feature", "toxic", "clean"])

    return train.select("text", F.col("toxic").cast("int").alias("toxic")) \
        .mapInArrow(run, "feature int, toxic long, clean long") \
        .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _windows(train: DataFrame, marks: np.ndarray) -> DataFrame:
    """(toxic, rank, ids, tags): windows of STEPS words with their features and weak tags."""
    def run(batches):
        for batch, texts in chunks(batches):
            out, known = [], {}
            for text, toxic in zip(texts, batch.column(1).to_pylist()):
                words = WORDS.findall(text)
                for w in set(words) - known.keys():
                    known[w] = bool(marks[list(features(w)[:LEXICAL])].any())
                if toxic:
                    hits = [i for i, w in enumerate(words) if known[w]]
                    starts = {max(0, h // 8 * 8 - STEPS // 2) for h in hits[::max(1, len(hits) // 4)]}
                else:
                    starts = {0, len(words) // 3, 2 * len(words) // 3}
                for s in sorted(starts):
                    part = words[s:s + STEPS]
                    if part:
                        raw = np.array([features(w) for w in part], dtype=np.int32).tobytes()
                        tags = np.array([known[w] and bool(toxic) for w in part], dtype=np.int8)
                        out.append((int(toxic), xxhash.xxh64_intdigest(raw, SEED) >> 1, raw, tags.tobytes()))
            if out:
                t, r, i, y = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(t, pa.int32()), pa.array(r, pa.int64()),
                                                  pa.array(i, pa.binary()), pa.array(y, pa.binary())],
                                                 ["toxic", "rank", "ids", "tags"])

    return train.select("text", F.col("toxic").cast("int").alias("toxic")) \
        .mapInArrow(run, "toxic int, rank long, ids binary, tags binary")


def train(docs: DataFrame, labels: DataFrame, windows: int = SAMPLE_WINDOWS) -> Model | None:
    """The model, from documents (doc_id, text) and their labels (doc_id, toxic: 0 or 1).

    Null ids, null texts and labels other than 0 and 1 are left out; of several labels of an id the largest counts. None if a label is
    missing or no word can be marked. The sample is by a hash of the id, so it does not depend on partitions or row
    order, and is chosen before texts are read: its ids, about SAMPLE_TOXIC + SAMPLE_CLEAN whatever the input, are
    broadcast to the documents. A quarter is kept for the calibration. The driver holds at most SPACE counts, the
    windows of least content hash and four numbers per calibrating document.
    """
    own = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)) \
        .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    count = {r.toxic: r["count"] for r in own.groupBy("toxic").count().collect()}
    if not count.get(0) or not count.get(1):
        return None
    share = F.when(F.col("toxic") == 1, min(1.0, SAMPLE_TOXIC / count[1])).otherwise(min(1.0, SAMPLE_CLEAN / count[0]))
    ids = own.withColumn("hash", F.xxhash64("id")).where(F.pmod("hash", F.lit(1 << 30)) < share * (1 << 30))
    sample = pin(docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("id"), "text")
                 .join(F.broadcast(ids), "id").select("text", "toxic", "hash").repartition(SAMPLE_PARTS), "labelled")
    own = F.pmod(F.shiftright("hash", 32), F.lit(4)) != 0
    learn = sample.where(own)
    count = {r.toxic: r["count"] for r in learn.groupBy("toxic").count().collect()}
    toxic, clean = count.get(1, 0), count.get(0, 0)
    if not toxic or not clean:
        return None
    ratio = (F.col("toxic") + 0.01) / toxic / ((F.col("clean") + 0.5) / clean)
    least = max(LEAST_DOCUMENTS, LEAST_SHARE * toxic)
    marked = _feature_counts(learn).where((F.col("toxic") >= least) & (ratio >= LEAST_RATIO)).collect()
    marks = np.zeros(SPACE, dtype=bool)
    marks[[r.feature for r in marked]] = True
    found = pin(_windows(learn, marks), "windows")
    picked = []
    for label in (1, 0):
        picked += found.where(F.col("toxic") == label).orderBy("rank").limit(windows // 2).collect()
    if not marks.any() or not picked:
        return None
    ids = np.zeros((len(picked), STEPS, PER_WORD), dtype=np.int64)
    tags, live = np.zeros((len(picked), STEPS), dtype=np.int64), np.zeros((len(picked), STEPS), dtype=bool)
    for i, r in enumerate(picked):
        part = np.frombuffer(bytes(r.ids), dtype=np.int32).reshape(-1, PER_WORD)
        ids[i, :len(part)], live[i, :len(part)] = part, True
        tags[i, :len(part)] = np.frombuffer(bytes(r.tags), dtype=np.int8)
    words = Field.fresh().fit(ids, tags, live, UPDATES, RATE, SEED)
    return Model(words, _calibrate(sample.where(~own), words))


def _signs(chance: np.ndarray) -> list[float]:
    """What the score of a document is made from: 1, its surest words together as log odds, their number and share."""
    over = chance[chance >= 0.5]
    rest = np.prod(1 - over) if over.size else 1 - chance.max(initial=0.0)
    odds = float(np.clip(np.log((1 - rest + 1e-9) / (rest + 1e-9)), -8, 16))
    return [1.0, odds / 4, float(np.log1p(over.sum())), float(min(100 * over.sum() / max(chance.size, 1), 10) / 4)]


def _calibrate(held: DataFrame, words: Field) -> np.ndarray:
    """Logistic weights of the signs, from documents the CRF has not seen; the log odds alone if a label is missing."""
    def run(batches):
        for batch, texts in chunks(batches):
            signs = [_signs(c) for c in word_chances([WORDS.findall(t) for t in texts], words)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(signs, pa.list_(pa.float64()))],
                                             ["toxic", "signs"])

    rows = held.select("text", "toxic").mapInArrow(run, "toxic int, signs array<double>").collect()
    weights = np.array([0.0, 4.0, 0.0, 0.0])
    y = np.array([r.toxic for r in rows], dtype=float)
    if not rows or y.min() == y.max():
        return weights
    x = np.array(sorted([r.toxic, *r.signs] for r in rows))
    y, x = x[:, 0], x[:, 1:]
    for _ in range(3000):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        weights = weights + 0.5 * (x.T @ (y - p) / len(y) - 1e-4 * weights * [0, 1, 1, 1])
    return weights


def word_chances(words: list[list[str]], model: Field) -> list[np.ndarray]:
    """P(toxic) of every word. A text is cut into chains of STEPS words that overlap by OVERLAP on each side."""
    sizes = np.array([len(w) for w in words])
    flat = [w for own in words for w in own]
    if not flat:
        return [np.zeros(0) for _ in words]
    codes, unique = pd.factorize(np.array(flat, dtype=object))
    gains = np.array([model.of_word(w) for w in unique])
    here, first = gains[codes, 0].copy(), np.cumsum(sizes) - sizes
    begins = np.zeros(len(flat), dtype=bool)
    begins[first[sizes > 0]] = True
    ends = np.roll(begins, -1)
    ends[-1] = True
    here += np.where(begins, 0.0, np.roll(gains[codes, 1], 1))
    here += np.where(ends, 0.0, np.roll(gains[codes, 2], -1))
    last = np.repeat(first + sizes, sizes)
    begin = np.repeat(first, sizes)
    inner = STEPS - 2 * OVERLAP
    heads = np.flatnonzero((np.arange(len(flat)) - begin) % inner == 0)
    out = np.empty(len(flat))
    for at in range(0, len(heads), 8192):
        h = heads[at:at + 8192]
        start = np.maximum(h - OVERLAP, begin[h])
        place = start + np.arange(STEPS)[:, None]
        live = place < last[h]
        place = np.minimum(place, last[h] - 1)
        chance = model.marginals(np.where(live, here[place], 0.0), live)
        own = live & (place >= h) & (place < h + inner)
        out[place[own]] = chance[own]
    return np.split(out, np.cumsum(sizes)[:-1])


def score_texts(texts: list[str], model: Model | None) -> tuple[list[float], list[list[tuple[int, int]]]]:
    """Per text the score and the offending (start, end) offsets in code points: runs of words over one half.

    Texts without words, or without a model, have score 0.
    """
    scores, spans = [0.0] * len(texts), [[] for _ in texts]
    if model is None:
        return scores, spans
    words = [WORDS.findall(t) for t in texts]
    for i, chance in enumerate(word_chances(words, model.words)):
        if not chance.size:
            continue
        scores[i] = float(1 / (1 + np.exp(-np.clip(np.dot(_signs(chance), model.weights), -30, 30))))
        over = np.flatnonzero(chance >= 0.5)
        places = [m.span() for m in WORDS.finditer(texts[i])] if over.size else []
        for k in over:
            if spans[i] and k and spans[i][-1][1] == places[k - 1][1]:
                spans[i][-1] = (spans[i][-1][0], places[k][1])
            else:
                spans[i].append(places[k])
    return scores, spans


def score(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The kept columns with score (0 to 1), predicted (1 if score >= 0.5) and spans ("start:end", comma-joined).

    Null and empty texts score 0. Each row stands for itself, so repeated rows agree; an empty table gives no rows.
    """
    def work(texts):
        scores, spans = score_texts(texts, model)
        return [scores, [int(s >= 0.5) for s in scores], [",".join(f"{a}:{b}" for a, b in own) for own in spans]]

    return map_texts(docs, keep, "score double, predicted int, spans string", work)
