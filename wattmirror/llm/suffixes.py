"""Passages that occur more than once, by a sparse suffix array over all texts.

Suffixes are kept only at minimiser positions: a k-gram of words whose hash is the least of some window of k-grams.
Passages of LEAST words hold at least one minimiser, the same in every copy. The suffixes, each with the words around
it, are sorted over the whole corpus; neighbours that share the k-gram are compared, and the match is extended to the
right and to the left. Sorting by what follows puts the longest match to the right next to a suffix; sorting by what
precedes does so to the left. Matches of overlapping contexts join up to passages of any length.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmirror.llm.common import chunks, map_texts, pin

LEAST = 50                      # words of a passage
GRAM = 12                       # words of a k-gram
WINDOW = LEAST - GRAM + 1       # k-grams of which the least is kept: any passage of LEAST words holds a minimiser
KEY = ["key", "key2"]           # two 64-bit hashes of a text
SECOND_SEED = 17
SUFFIX = ["gram", *KEY, "pos", "after", "before"]
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)      # odd, for rolling hashes modulo 2^64


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every word of the texts in a row, and the number of words of each text."""
    words = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    flat = [w for own in words for w in own]
    if not flat:
        return np.zeros(0, dtype=np.uint64), sizes
    codes, unique = pd.factorize(np.array(flat, dtype=object))
    return np.array([xxhash.xxh64_intdigest(w) for w in unique], dtype=np.uint64)[codes], sizes


def mixed(h: np.ndarray) -> np.ndarray:
    """Hashes whose order is unlike that of their parts."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def grams(words: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Hash of the gram words from each position on; as many as there are full grams."""
    n = words.size - gram + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(gram):
        out = out * MULTIPLIER + words[i:i + n]
    return mixed(out)


def minimisers(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of the least hash of each window, ties to the left; of all, if there are fewer than one window."""
    n = hashes.size
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    if n <= window:
        return np.array([int(hashes.argmin())])
    kept, step = np.arange(n), 1
    while 2 * step <= window:                   # least of 2, 4, 8 ... hashes from each position on
        a, b = kept[:-step], kept[step:]
        kept = np.where(hashes[b] < hashes[a], b, a)
        step *= 2
    rest = window - step
    a, b = kept[:n - window + 1], kept[rest:rest + n - window + 1]
    return np.unique(np.where(hashes[b] < hashes[a], b, a))


def text_keys(text: Column) -> tuple[Column, Column]:
    """What tells texts apart: XXH64 under two seeds."""
    return F.xxhash64(text), F.xxhash64(F.lit(SECOND_SEED), text)


def _light(docs: DataFrame) -> DataFrame:
    """(gram, key, key2, pos) of the minimisers of every text of at least LEAST words."""
    def run(batches):
        for batch, texts in chunks(batches):
            flat, sizes = word_hashes(texts)
            keys, out = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)], ([], [], [], [])
            for key, key2, start, n in zip(*keys, np.cumsum(sizes) - sizes, sizes):
                if n >= LEAST:
                    hashes = grams(flat[start:start + n])
                    at = minimisers(hashes)
                    for c, v in zip(out, (hashes[at].view(np.int64), np.full(at.size, key), np.full(at.size, key2), at)):
                        c.append(v)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in out],
                                                 ["gram", *KEY, "pos"])

    return docs.select(*KEY, "text").mapInArrow(run, "gram long, key long, key2 long, pos long")


def _entries(wanted: DataFrame) -> DataFrame:
    """Suffixes at the wanted positions (key, key2, text, places): gram, key, key2, pos, after and before.

    after: 32 bits of the hash of each of the next LEAST words; before: the same of the words before, nearest first.
    """
    def run(batches):
        for batch, texts in chunks(batches):
            flat, sizes = word_hashes(texts)
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(batch.schema.get_field_index("places")).to_pylist(),
                       np.cumsum(sizes) - sizes, sizes)
            out = ([], [], [], [], [], [])
            for key, key2, places, start, n in rows:
                own = flat[start:start + n]
                at = np.sort(np.array(places, dtype=np.int64))
                short = (own >> np.uint64(32)).astype(">u4")
                back = short[::-1]
                out[0].append(grams(own)[at].view(np.int64))
                out[1].append(np.full(at.size, key))
                out[2].append(np.full(at.size, key2))
                out[3].append(at)
                out[4].extend(short[p:p + LEAST].tobytes() for p in at)
                out[5].extend(back[n - p:n - p + LEAST].tobytes() for p in at)
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c), pa.int64()) for c in out[:4]]
                    + [pa.array(c, pa.binary()) for c in out[4:]], SUFFIX)

    return wanted.select(*KEY, "text", "places").mapInArrow(
        run, "gram long, key long, key2 long, pos long, after binary, before binary")


def _neighbours(entries: DataFrame, first: str, second: str) -> DataFrame:
    """Sort the suffixes and compare neighbours: (key, key2, begin, end) of matches of at least LEAST words, both sides.

    The sort is a range partitioning over the corpus, so a k-gram of any number of copies is cut over tasks. Each
    task also gives its first and last suffix; those of neighbouring tasks are compared afterwards.
    """
    order = ["gram", first, second, *KEY, "pos"]

    def run(batches):
        last, head = None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            if last is not None:
                batch = pa.concat_batches([last, batch])
            if head:
                yield edge(batch.slice(0, 1))
                head = False
            yield matches(batch)
            last = batch.slice(batch.num_rows - 1)
        if last is not None:
            yield edge(last)

    names = ["kind", *KEY, "begin", "end", "gram", "pos", "after", "before"]

    def edge(row):
        get = {n: row.column(row.schema.get_field_index(n)) for n in row.schema.names}
        none = pa.nulls(1, pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([1], pa.int32()), get["key"], get["key2"], none, none, get["gram"],
                                           get["pos"], get["after"].cast(pa.binary()), get["before"].cast(pa.binary())], names)

    def matches(batch):
        found = compare(batch)
        n = found[0].size
        return pa.RecordBatch.from_arrays(
            [pa.array(np.zeros(n), pa.int32()), *map(pa.array, found),
             pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary())],
            names)

    ordered = entries.repartitionByRange(*order).sortWithinPartitions(*order)
    made = pin(ordered.select(*SUFFIX).mapInArrow(
        run, "kind int, key long, key2 long, begin long, end long, gram long, pos long, after binary, before binary"), "matches")
    edges = made.where("kind = 1").select(*SUFFIX).repartition(1) \
        .sortWithinPartitions(*order)
    across = edges.mapInArrow(lambda batches: (matches(b) for b in _joined(batches)), made.schema)
    return made.where("kind = 0").select(*KEY, "begin", "end").union(across.select(*KEY, "begin", "end"))


def _joined(batches):
    last = None
    for batch in batches:
        if batch.num_rows:
            if last is not None:
                batch = pa.concat_batches([last, batch])
            yield batch
            last = batch.slice(batch.num_rows - 1)


def _common(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Words that two columns of packed word hashes share from the front, row by row."""
    def table(column):
        column = column.cast(pa.binary())
        sizes = np.array(pa.compute.binary_length(column)) // 4
        out = np.zeros((len(column), LEAST), dtype=np.uint32)
        flat = np.frombuffer(b"".join(column.to_pylist()), dtype=">u4")
        out[np.arange(LEAST) < sizes[:, None]] = flat
        return out, sizes

    (x, nx), (y, ny) = table(a), table(b)
    same = (x == y) & (np.arange(LEAST) < np.minimum(nx, ny)[:, None])
    return np.where(same.all(axis=1), LEAST, same.argmin(axis=1))


def compare(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """(key, key2, begin, end) of both sides of every match between neighbours, extended right and left."""
    gram = batch.column(batch.schema.get_field_index("gram")).to_numpy()
    near = np.flatnonzero(gram[1:] == gram[:-1])
    if not near.size:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    get = {n: batch.column(batch.schema.get_field_index(n)) for n in (*KEY, "pos", "after", "before")}
    a, b = pa.array(near), pa.array(near + 1)
    right = _common(get["after"].take(a), get["after"].take(b))
    back = _common(get["before"].take(a), get["before"].take(b))
    long = np.flatnonzero(right + back >= LEAST)
    out = [], [], [], []
    for side in (near, near + 1):
        rows = side[long]
        pos = get["pos"].to_numpy()[rows]
        out[0].append(get["key"].to_numpy()[rows])
        out[1].append(get["key2"].to_numpy()[rows])
        out[2].append(pos - back[long])
        out[3].append(pos + right[long])
    return tuple(np.concatenate(c).astype(np.int64) for c in out)


def _united(key_spans: DataFrame) -> DataFrame:
    """(key, key2, spans, repeated): the matches of a text as ordered spans that neither touch nor overlap."""
    def run(batches):
        for batch in batches:
            texts, words = [], []
            for own in batch.column(2).to_pylist():
                out: list[list[int]] = []
                for s in sorted((x["begin"], x["end"]) for x in own):
                    if out and s[0] <= out[-1][1]:
                        out[-1][1] = max(out[-1][1], s[1])
                    else:
                        out.append(list(s))
                texts.append(",".join(f"{x}:{y}" for x, y in out))
                words.append(sum(y - x for x, y in out))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array(words, pa.int64())], [*KEY, "spans", "repeated"])

    return key_spans.groupBy(*KEY).agg(F.collect_set(F.struct("begin", "end")).alias("own")) \
        .mapInArrow(run, "key long, key2 long, spans string, repeated long")


def passages(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, copies, repeated_words, spans.

    copies: documents with exactly this text, itself included. spans: "begin:end" in words, comma-joined, of the
    text that lies in a passage of at least LEAST words occurring at another place of the corpus, the same text
    included; of a text with copies all of it. repeated_words: the words in them. Equal texts are told by 128 bits of
    hashes and searched once: a group of copies is reduced to one row in every task before it is shuffled. Null texts count as empty, and texts under
    LEAST words have no spans. doc_id may repeat or be null; other columns are ignored. No rows give no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key, key2 = text_keys(text)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("key"), key2.alias("key2"), text.alias("text"))
    sizes = pin(map_texts(rows, ["doc_id", *KEY], "n_words long", lambda texts: [[len(t.encode(
        "utf-8", "surrogatepass").split()) for t in texts]]), "sizes")
    light = pin(_light(rows), "grams")
    places = light.distinct()
    # Written, so that the join below reads both sides from shuffles and Spark can split a k-gram of many copies.
    often = pin(places.groupBy("gram").count().where("count > 1").select("gram"), "often")
    wanted = places.join(often, "gram", "left_semi").groupBy(*KEY).agg(F.collect_list("pos").alias("places"))
    texts = rows.select(*KEY, "text").dropDuplicates(KEY).join(wanted, KEY)
    entries = pin(_entries(texts), "suffixes")
    found = _neighbours(entries, "after", "before").union(_neighbours(entries, "before", "after"))
    spans = _united(found.distinct())
    copies = sizes.groupBy(*KEY).agg(F.count("*").alias("copies"))
    # Written as well: the rows of a large group of copies meet it in a join that Spark can split.
    told = pin(copies.join(spans, KEY, "left").where("copies > 1 OR spans IS NOT NULL"), "told")
    whole = (F.col("copies") > 1) & (F.col("n_words") >= LEAST)
    return sizes.join(told, KEY, "left").select(
        "doc_id", "n_words", F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("repeated", F.lit(0))).alias("repeated_words"),
        F.when(whole, F.concat(F.lit("0:"), "n_words")).otherwise(F.coalesce("spans", F.lit(""))).alias("spans"))
