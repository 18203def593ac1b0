"""Packing token sequences: exact complements first, best fit for the rest.

Only the counts of the 1024 possible lengths decide, so the plan is made once from that bounded table: full pieces go
alone; for every length, from the longest, the gap it leaves is looked up in indexes of single lengths, of sums of two
and of sums of three, and as many sequences are filled exactly as the counts allow; what is left is packed by best fit
on runs of equal lengths. A plan row says: so many sequences hold these lengths. Pieces find their place by their number among
the pieces of their length.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattmirror.llm.common import chunks, pin

LIMIT = 1024
END = 2                         # the id that closes a document
PART_ROWS = 5_000               # the pieces of one length are numbered in hash parts of at most about so many
BLOCK = 32                      # lengths whose exact sums are judged together
RANKS, VOCABULARY = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json"
# Runs of white space that go to the tokenizer itself: the pattern's look-ahead makes the faster one recurse along them.
LONG_SPACE = re.compile(r"\s{50000}")
ADDED = {"<|endoftext|>": 50256}                # the added tokens of byte_bpe_50k.json, absent from the ranks


@functools.cache
def encoder(path: str) -> tiktoken.Encoding:
    """The vocabulary of byte_bpe_50k.json in its other form; the ids are the same and take a fifth of the time.

    Its added token is allowed in texts (`encode_text`), as it is to the tokenizer.
    """
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens=ADDED)


@functools.cache
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def encode_text(path: str, vocabulary: str | None = None) -> Callable[[str], list[int]]:
    """What byte_bpe_50k.json makes of a text with add_special_tokens=False: the literal added token is one id."""
    own, added = encoder(path), frozenset(ADDED)
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)

    def encode(text: str) -> list[int]:
        if LONG_SPACE.search(text):
            return tokenizer(vocabulary).encode(text, add_special_tokens=False).ids
        if any(a in text for a in added):
            return own.encode(text, allowed_special=added)
        return own.encode_ordinary(text)

    return encode


def cut(n: int, limit: int = LIMIT) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: all as long as the limit but for the first."""
    first = n % limit or min(n, limit)
    starts = [0, *range(first, n, limit)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n])]


def pieces(docs: DataFrame, keep: list[str], with_ids: bool = True, limit: int = LIMIT,
           ranks_path: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """One row per piece: the kept columns, piece, start, length, ids_crc32 and, if asked, the ids.

    Null texts count as empty; a document's ids are those of its text and END, so none is without a piece.
    """
    path = ranks_path or public_tokenizers.path(RANKS)
    source = docs.select(*dict.fromkeys([*keep, "text"]))
    names = list(keep)

    def run(batches):
        encode = encode_text(path, vocabulary)
        for batch, texts in chunks(batches):
            rows, cols = [], ([], [], [], [], [])
            for i, text in enumerate(texts):
                ids = np.array(encode(text) + [END], dtype="<u4")
                for k, (start, length) in enumerate(cut(ids.size, limit)):
                    part = ids[start:start + length]
                    rows.append(i)
                    for c, v in zip(cols, (k, start, length, zlib.crc32(part.tobytes()),
                                           part.astype(np.int32) if with_ids else None)):
                        c.append(v)
            own = batch.select(names).take(pa.array(rows, pa.int64()))
            arrays = [pa.array(cols[0], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[1:4])]
            extra = [pa.array(cols[4], pa.list_(pa.int32()))] if with_ids else []
            yield pa.RecordBatch.from_arrays([*own.columns, *arrays, *extra],
                                             [*names, "piece", "start", "length", "ids_crc32", *["ids"][:len(extra)]])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema.fields)
    return source.mapInArrow(run, f"{kept}, piece int, start long, length long, ids_crc32 long"
                             + (", ids array<int>" if with_ids else ""))


Recipe = tuple[int, tuple[int, ...]]          # how many sequences, and the lengths in each


class Sums:
    """Index of the lengths that occur, and of all sums of two of them; sums of three are one length and a pair."""

    def __init__(self, lengths: np.ndarray, limit: int):
        self.single = lengths[::-1]
        large, small = np.meshgrid(lengths, lengths, indexing="ij")
        fits = (small <= large) & (large + small < limit)
        large, small = large[fits], small[fits]
        order = np.lexsort((-large, large + small))
        total = (large + small)[order]
        cuts = np.searchsorted(total, np.arange(limit + 1))
        self.pairs = [np.stack([large[order][i:j], small[order][i:j]], axis=1) for i, j in zip(cuts[:-1], cuts[1:])]

    def filling(self, have: np.ndarray, gap: int, parts: int, most: int) -> Iterator[tuple[int, ...]]:
        """The ways to fill a gap with so many lengths up to `most`, of which some are left; largest parts first."""
        if parts == 1:
            if gap <= most and have[gap]:
                yield (gap,)
        elif parts == 2:
            known = self.pairs[gap]
            known = known[(known[:, 0] <= most) & (have[known[:, 0]] > 0) & (have[known[:, 1]] > 0)]
            yield from map(tuple, known.tolist())
        else:
            for x in self.single[(self.single <= min(most, gap - 2)) & (3 * self.single >= gap)].tolist():
                if have[x]:
                    for pair in self.filling(have, gap - x, 2, x):
                        yield (x, *pair)
                        if not have[x]:
                            break


def recipes(counts: dict[int, int], limit: int = LIMIT) -> list[Recipe]:
    """The plan for so many pieces of each length (1 to limit): exact sums of two, three and four lengths, then best fit."""
    return _plan(counts, limit, 3)


def _plan(counts: dict[int, int], limit: int, parts: int) -> list[Recipe]:
    """Gaps are filled by single lengths first, then by pairs, then by triples, from the longest length down.

    Exact sums use up the short lengths that others need later. So after every BLOCK of lengths what is left is packed by
    best fit for a trial, and if the whole has become longer, the sums of the block are given back. The plan is thus no
    longer than best fit alone.
    """
    have = np.zeros(limit + 1, dtype=np.int64)
    for length, n in counts.items():
        have[length] += n
    sums = Sums(np.flatnonzero(have[:limit]), limit)
    plan: list[Recipe] = [(int(have[limit]), (limit,))] if have[limit] else []
    have[limit] = 0

    def rest() -> list[Recipe]:
        return _best_fit({x: int(have[x]) for x in np.flatnonzero(have)}, limit)

    def sequences(recipes_: list[Recipe]) -> int:
        return sum(n for n, _ in recipes_)

    shortest = sequences(plan) + sequences(rest())
    for size in range(1, parts + 1):
        for top in range(limit - 1, 0, -BLOCK):
            before, known = have.copy(), len(plan)
            for longest in range(top, max(top - BLOCK, 0), -1):
                if have[longest]:
                    for filling in sums.filling(have, limit - longest, size, longest):
                        need = Counter((longest, *filling))
                        n = min(int(have[x]) // k for x, k in need.items())
                        if n:
                            plan.append((n, (longest, *filling)))
                            for x, k in need.items():
                                have[x] -= n * k
                        if not have[longest]:
                            break
            if len(plan) > known:
                now = sequences(plan) + sequences(rest())
                if now > shortest:
                    have, plan = before, plan[:known]
                else:
                    shortest = now
    return plan + rest()


def _best_fit(left: dict[int, int], limit: int) -> list[Recipe]:
    """Best fit decreasing; sequences with the same lengths are one row of the plan."""
    open_rows: dict[int, dict[tuple[int, ...], int]] = {}          # by room left
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            room = min((r for r in open_rows if r >= length), default=None)
            if room is None:
                per = limit // length
                full, rest = divmod(n, per)
                for count, times in ((full, per), (int(rest > 0), rest)):
                    if count:
                        own = open_rows.setdefault(limit - times * length, {})
                        lengths = (length,) * times
                        own[lengths] = own.get(lengths, 0) + count
                break
            lengths, count = next(iter(open_rows[room].items()))
            used = min(count, n)
            if used == count:
                del open_rows[room][lengths]
                if not open_rows[room]:
                    del open_rows[room]
            else:
                open_rows[room][lengths] = count - used
            own = open_rows.setdefault(room - length, {})
            own[(*lengths, length)] = own.get((*lengths, length), 0) + used
            n -= used
    return [(n, lengths) for own in open_rows.values() for lengths, n in own.items()]


class Places:
    """For each length: consecutive numbers of its pieces and the sequence and offset they stand for."""

    def __init__(self, plan: list[Recipe]):
        begin: dict[int, list[int]] = {}
        rows: dict[int, list[tuple[int, int, int]]] = {}
        used: Counter = Counter()
        sequence = 0
        for n, lengths in plan:
            offset = 0
            for length in lengths:
                begin.setdefault(length, []).append(used[length])
                rows.setdefault(length, []).append((sequence, offset, used[length]))
                used[length] += n
                offset += length
            sequence += n
        self.begin = {k: np.array(v) for k, v in begin.items()}
        self.rows = {k: np.array(v) for k, v in rows.items()}

    def find(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty_like(number), np.empty_like(number)
        order = np.argsort(length, kind="stable")
        for at in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
            if at.size:
                x = int(length[at[0]])
                row = self.rows[x][np.searchsorted(self.begin[x], number[at], side="right") - 1]
                sequence[at] = row[:, 0] + number[at] - row[:, 2]
                offset[at] = row[:, 1]
        return sequence, offset


def place(cut_pieces: DataFrame, order: list[str], limit: int = LIMIT) -> DataFrame:
    """Add sequence_id and offset to a written table of pieces with `length` (1 to limit).

    The driver sees one count per length, at most `limit` rows, and makes the plan. Pieces of one length are numbered
    in hash parts, by `order` columns in each, and running sums over the parts; there are as many parts as the number
    of pieces asks for, so a length that most pieces have is no single task. Equal rows are interchangeable. An empty
    table stays empty.
    """
    wanted = max(1, -(-cut_pieces.count() // PART_ROWS))
    salted = cut_pieces.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(wanted)))
    counted = salted.groupBy("length", "__part").count()
    counts = {r["length"]: r["n"] for r in cut_pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = Places(recipes(counts, limit))
    ahead = Window.partitionBy("length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    first = counted.select(F.col("length").alias("__l"), F.col("__part").alias("__p"),
                           F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("__first"))
    inside = Window.partitionBy("length", "__part").orderBy(*order)
    numbered = salted.withColumn("__n", F.row_number().over(inside) - 1) \
        .join(first, (F.col("length") == F.col("__l")) & (F.col("__part") == F.col("__p"))) \
        .withColumn("__n", F.col("__n") + F.col("__first"))
    names = cut_pieces.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut_pieces.schema.fields)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                length, n = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
                             .astype(np.int64) for c in ("length", "__n"))
                sequence, offset = places.find(length, n)
                yield pa.RecordBatch.from_arrays([*batch.select(names).columns, pa.array(sequence), pa.array(offset)],
                                                 [*names, "sequence_id", "offset"])

    return numbered.select(*names, "__n").mapInArrow(run, schema + ", sequence_id long, offset long")


def pack(docs: DataFrame, with_ids: bool = True, limit: int = LIMIT) -> DataFrame:
    """Pack all documents: doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset.

    Sequences have no gap and at most `limit` ids. Rows with equal or null doc_id are packed like any other. Other
    columns are ignored, whatever their names. The pieces are written to the shared folder before they are counted.
    """
    made = pin(pieces(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"], with_ids, limit),
               "pieces")
    return place(made, ["doc_id", "piece", "start", "ids_crc32"], limit)
