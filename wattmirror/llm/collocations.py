"""Phrases whose words stand together more often than their parts suggest, counted by FM-indexes of shards.

Texts are cut into shards of one language and bounded size, without a shuffle, and stored as word codes. Counting goes
up word by word. For the phrases of d words that are frequent in the whole corpus, each shard that holds some of them
builds a bidirectional FM-index over the parts of its text that they cover, and extends their intervals to both sides;
a longer phrase counts if both of its ends are frequent. Numbers are summed across shards, and what is frequent goes
back to the shards that hold it. No phrase can be missed: its ends are as frequent as itself.
"""

from __future__ import annotations

import string

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattmirror.llm.common import pin, typed
from wattmirror.llm.fm_index import Index

# Fixed by the contract.
LEAST, LONGEST, TOP, SCALE = 30, 4, 2000, 2_000_000
SEPARATORS = b".,;:!?\n\x0b\x0c\r"

SHARD_BYTES = 8 << 20           # of text in a shard; a longer piece without separators is a shard of its own
HELD_BYTES = 32 << 20           # of text that a task holds for all languages, before the largest becomes a shard
PLACE_BITS, RUN_BITS = 31, 11   # of a phrase's number: a place in its shard, the shard's number in its task
BREAK = b"\xff"                 # stands between pieces; UTF-8 has no such byte
_TO_BREAK = bytes(BREAK[0] if b in SEPARATORS else b for b in range(256))
_SHARD = "shard long, lang string, n long, ids binary, words array<binary>, counts array<int>, places array<int>"
_FOUND = "shard long, place int, prefix long, suffix long, n long"


def shard_of(raw: bytes) -> tuple | None:
    """(words, codes, counts, first places) of lower-cased text with BREAKs; code 0 is the break. None without words."""
    codes, words = pd.factorize(np.array([BREAK, *raw.replace(BREAK, b" \xff ").split(), BREAK], dtype=object))
    codes = codes[np.concatenate([[True], (codes[1:] > 0) | (codes[:-1] > 0)])].astype(np.int32)
    if codes.size < 2:
        return None
    places = np.empty(len(words), dtype=np.int32)
    places[codes[::-1]] = np.arange(codes.size, dtype=np.int32)[::-1]
    return words, codes, np.bincount(codes), places


def _cut(raw: bytes, limit: int):
    start = 0
    while len(raw) - start > limit:
        end = raw.find(BREAK, start + limit)
        if end < 0:
            break
        yield raw[start:end]
        start = end + 1
    yield raw[start:]


def shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES, held_bytes: int = HELD_BYTES) -> DataFrame:
    """One row per shard: its language, number of words, compressed codes, and its words with counts and a place."""
    schema = pa.schema([("shard", pa.int64()), ("lang", pa.string()), ("n", pa.int64()), ("ids", pa.binary()),
                        ("words", pa.list_(pa.binary())), ("counts", pa.list_(pa.int32())),
                        ("places", pa.list_(pa.int32()))])

    def run(batches):
        part, made, held, sizes = TaskContext.get().partitionId(), 0, {}, {}

        def flush(lang):
            nonlocal made
            raw = BREAK.join(held.pop(lang))
            sizes.pop(lang)
            for piece in _cut(raw, shard_bytes):
                found = shard_of(piece)
                if found is None:
                    continue
                words, codes, counts, places = found
                if made >> RUN_BITS:
                    raise ValueError("too many shards in one task: use more partitions")
                row = {"shard": (part << RUN_BITS) + made, "lang": lang, "n": int(counts[1:].sum()),
                       "ids": zstandard.compress(codes.tobytes(), 1), "words": words[1:], "counts": counts[1:],
                       "places": places[1:]}
                made += 1
                yield pa.RecordBatch.from_arrays([pa.array([row[f.name]], type=f.type) for f in schema], schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                raw, lang = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                held.setdefault(lang, []).append(raw.lower().translate(_TO_BREAK))
                sizes[lang] = sizes.get(lang, 0) + len(raw)
                while sizes and (sizes.get(lang, 0) >= shard_bytes or sum(sizes.values()) >= held_bytes):
                    yield from flush(max(sizes, key=sizes.get))
        for lang in list(held):
            yield from flush(lang)

    texts = docs.select(F.coalesce("text", F.lit("")).cast("binary"), F.coalesce("lang", F.lit("und")))
    return texts.mapInArrow(run, _SHARD)


def reduced(text: np.ndarray, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts of a text that occurrences of the patterns cover, if they can hold a phrase of one more code.

    Breaks (code 0) stand around and between them. Returns the codes and, for each, its place in the text.
    """
    depth, span = patterns.shape[1], int(text.max()) + 1
    start = np.arange(text.size - depth + 1)
    own, name = np.zeros(len(patterns), dtype=np.int64), np.zeros(start.size, dtype=np.int64)
    for j in range(depth):
        keys, own = np.unique(own * span + patterns[:, j], return_inverse=True)
        seen = name * span + text[start + j]
        if j == 0:
            table = np.full(span, -1, dtype=np.int64)
            table[keys] = np.arange(keys.size)
            at, known = table[seen], table[seen] >= 0
        else:
            at = np.minimum(np.searchsorted(keys, seen), keys.size - 1)
            known = keys[at] == seen
        start, name = start[known], at[known]
    marks = np.zeros(text.size + 1, dtype=np.int64)
    marks[start] += 1
    marks[start + depth] -= 1
    covered = np.cumsum(marks)[:-1] > 0
    if depth == 1:
        linked = covered[:-1] & covered[1:]
    else:                                   # a place and the next are inside one occurrence
        marks = np.zeros(text.size + 1, dtype=np.int64)
        marks[start] += 1
        marks[start + depth - 1] -= 1
        linked = np.cumsum(marks)[:-2] > 0
    kept = np.flatnonzero(covered)
    if not kept.size:
        return np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    new = np.ones(kept.size, dtype=bool)
    new[1:] = (kept[1:] != kept[:-1] + 1) | ~linked[kept[:-1]]
    run = np.cumsum(new) - 1
    long = np.bincount(run)[run] > depth
    kept, new = kept[long], new[long]
    slot = np.arange(kept.size) + np.cumsum(new)
    codes = np.zeros((slot[-1] if slot.size else 0) + 2, dtype=np.int64)
    places = codes.copy()
    codes[slot], places[slot] = text[kept], kept
    return codes, places


def longer(text: np.ndarray, places: np.ndarray, depth: int) -> tuple[np.ndarray, ...]:
    """(prefix, suffix, number, place) of the phrases one word longer than those of `depth` words at the places."""
    patterns = text[places[:, None] + np.arange(depth)]
    codes, original = reduced(text, patterns)
    prefix, suffix, number, at = Index(codes, depth + 1).extend(patterns)
    return prefix, suffix, number, original[at]


def _extended(stored: DataFrame, known: DataFrame, depth: int) -> DataFrame:
    schema = typed(_FOUND)

    def run(key, index, grams):
        if not index.num_rows or not grams.num_rows:
            return schema.empty_table()
        text = np.frombuffer(zstandard.decompress(index.column("ids")[0].as_py()), dtype=np.int32).astype(np.int64)
        ids = grams.column("id").to_numpy()
        prefix, suffix, number, at = longer(text, grams.column("place").to_numpy().astype(np.int64), depth)
        return pa.table([np.full(at.size, key[0].as_py()), at.astype(np.int32), ids[prefix], ids[suffix], number],
                        schema=schema)

    return stored.select("shard", "ids").groupBy("shard").cogroup(
        known.select("shard", "place", "id").groupBy("shard")).applyInArrow(run, _FOUND)


def _frequent(found: DataFrame, by: list[str], least: int) -> DataFrame:
    """The rows of phrases with at least `least` occurrences in all shards, with f and the id that all rows share.

    A phrase has one row per shard that holds it. id: the least (shard, place), which no other phrase has.
    """
    w = Window.partitionBy(*by)
    own = F.shiftleft("shard", PLACE_BITS) + F.col("place")
    return found.withColumn("own", own).select("*", F.sum("n").over(w).alias("f"), F.min("own").over(w).alias("id")) \
        .where(F.col("f") >= least)


def phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST,
            shard_bytes: int = SHARD_BYTES, held_bytes: int = HELD_BYTES) -> tuple[list[DataFrame], DataFrame]:
    """The phrases of 1 to `longest` words with at least `least` occurrences, a table for each length, and the number
    of words per language.

    Columns: id, lang, phrase, last (its last word), f, heads and tails (f of its first and of its last 1, 2, … words),
    from two words on also prefix and suffix: the ids of the phrase without its last and without its first word, which
    are its links to what it extends to the right and to the left.
    """
    stored = pin(shards(docs, shard_bytes, held_bytes), "shards")
    words = stored.select("shard", "lang", F.explode(F.arrays_zip("words", "counts", "places")).alias("w")) \
        .select("shard", "lang", F.col("w.words").cast("string").alias("word"), F.col("w.counts").cast("long").alias("n"),
                F.col("w.places").alias("place"))
    known = pin(_frequent(words, ["lang", "word"], least).drop("n"), "words")
    first = known.where("own = id")
    levels = [first.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f",
                           F.array("f").alias("heads"), F.array("f").alias("tails"))]
    for depth in range(1, longest):
        known = pin(_frequent(_extended(stored, known, depth), ["prefix", "suffix"], least).drop("n"), "phrases")
        left = levels[-1].select(F.col("id").alias("prefix"), "lang", F.col("phrase").alias("head"), "heads")
        right = levels[-1].select(F.col("id").alias("suffix"), "last", "tails")
        levels.append(pin(known.where("own = id").select("id", "prefix", "suffix", "f").join(left, "prefix")
                          .join(right, "suffix").select(
                              "id", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "f",
                              F.concat("heads", F.array("f")).alias("heads"),
                              F.concat("tails", F.array("f")).alias("tails"), "prefix", "suffix"), "phrases"))
    return levels, stored.groupBy("lang").agg(F.sum("n").alias("n"))


def rank(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP,
         shard_bytes: int = SHARD_BYTES, held_bytes: int = HELD_BYTES) -> DataFrame:
    """The first `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    docs: text and lang; further columns are not read. Null texts are empty, a null lang is `und`. Every row counts,
    repeated ones too. A phrase scores floor(SCALE * a / (l + r)) at its worst cut (ties: the first). Phrases inside a
    longer one that is at least 0.8 times as frequent are left out; it is enough to look at those one word longer, as
    the longer ones are no more frequent. Ties in score go by a, then by the phrase's UTF-8 bytes. Products are
    decimals of 38 digits. Texts without words and an empty table give no rows.
    """
    levels, totals = phrases(docs, longest, least, shard_bytes, held_bytes)
    score = """array_min(transform(sequence(1, size(heads) - 1), k -> named_struct(
        'score', (CAST(f AS DECIMAL(20, 0)) * {0}) div (CAST(heads[k - 1] AS DECIMAL(20, 0))
                                                      + CAST(tails[size(tails) - k - 1] AS DECIMAL(20, 0))),
        'k', k, 'l', heads[k - 1], 'r', tails[size(tails) - k - 1])))""".format(SCALE)
    kept = []
    for depth in range(1, longest):
        grams = levels[depth].withColumn("cut", F.expr(score))
        if depth + 1 < longest:
            bigger = levels[depth + 1]
            most = bigger.select(F.col("prefix").alias("id"), "f").union(bigger.select(F.col("suffix").alias("id"), "f")) \
                .groupBy("id").agg(F.max("f").alias("most"))
            inside = "CAST(coalesce(most, 0) AS DECIMAL(20, 0)) * 100 >= CAST(f AS DECIMAL(20, 0)) * 80"
            grams = grams.join(most, "id", "left").where(f"NOT ({inside})")
        kept.append(grams.select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score"))
    found = kept[0]
    for other in kept[1:]:
        found = found.union(other)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                              "n", F.col("score").cast("long").alias("score"))


ORACLE = rf"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), '{string.ascii_uppercase}',
                                               '{string.ascii_lowercase}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents),
split AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
filled AS (SELECT * FROM split WHERE len(w) > 0),
grams AS ({' UNION ALL '.join(
    f"SELECT lang, {d} AS d, w[CAST(i AS BIGINT):CAST(i + {d - 1} AS BIGINT)] AS g "
    f"FROM (SELECT lang, w, unnest(range(1, len(w) - {d} + 2)) AS i FROM filled WHERE len(w) >= {d})"
    for d in range(1, LONGEST + 1))}),
counted AS (SELECT lang, d, g, count(*) AS f FROM grams GROUP BY lang, d, g),
totals AS (SELECT lang, sum(f) AS n FROM counted WHERE d = 1 GROUP BY lang),
frequent AS (SELECT * FROM counted WHERE f >= {LEAST}),
candidates AS (SELECT lang, d, g, f AS a FROM frequent WHERE d > 1),
cuts AS (SELECT lang, d, g, a, unnest(range(1, d)) AS k FROM candidates),
scored AS (
    SELECT c.lang, c.d, c.g, c.a, c.k, x.f AS l, y.f AS r,
        (CAST({SCALE} AS HUGEINT) * c.a) // (x.f + y.f) AS score
    FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.g = c.g[1:c.k]
    JOIN frequent y ON y.lang = c.lang AND y.g = c.g[c.k + 1:c.d]),
worst AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS place FROM scored),
inner_starts AS (SELECT lang, d, g, a, unnest(range(1, d)) AS i FROM candidates),
inner_ends AS (SELECT lang, d, g, a, i, unnest(range(i + 1, d + 1)) AS j FROM inner_starts),
inside AS (SELECT lang, g[i:j] AS g, max(a) AS most FROM inner_ends WHERE j - i + 1 < d GROUP BY lang, g[i:j]),
kept AS (
    SELECT w.lang, array_to_string(w.g, ' ') AS phrase, w.a, w.l, w.r, w.score
    FROM worst w LEFT JOIN inside i ON i.lang = w.lang AND i.g = w.g
    WHERE w.place = 1 AND NOT coalesce(CAST(100 AS HUGEINT) * i.most >= CAST(80 AS HUGEINT) * w.a, FALSE)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, CAST(t.n AS BIGINT) AS n, CAST(r.score AS BIGINT) AS score
FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= {TOP}
"""
