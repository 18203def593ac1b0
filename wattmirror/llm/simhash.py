"""Near-duplicate documents by 64-bit SimHash fingerprints, met at the words of a covering code.

The 64 bits are cut into blocks so that fingerprints within the threshold differ by at most one bit in some block.
The anchors of a block are the words of a Hamming code on its first 2^r - 1 bits, with the other bits free. That
code is perfect: every block value lies within its covering radius, 1, of exactly one anchor, its home. A value is
copied to every anchor within covering radius + 1, so of two linked values at least the second reaches the home of
the first, and comparing home values with all arrivals of an anchor finds every link. Only spanning links of an
anchor are emitted, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattmirror.llm.common import map_texts, packed, pin, unpacked
from wattmirror.llm.components import roots

WORDS, BITS, SEED = 3, 3, 42
# Home values of one anchor that a task compares with the anchor's arrivals; more are dealt over several tasks.
HOMES_PER_TASK = 20_000
HASHES = 65_536


def fingerprint(text: str, words: int = WORDS) -> int:
    """SimHash of one text: unsigned 64 bits over shingles of `words` words, repeats included."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        shingles = [b" ".join(tokens)]
    else:
        shingles = [b" ".join(z) for z in zip(*(tokens[i:] for i in range(words)))]
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(shingles), HASHES):
        hashed = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles[i:i + HASHES]], dtype=">u8")
        ones += np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(shingles)).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: list[str], words: int = WORDS) -> DataFrame:
    """The kept columns and `fp`, the fingerprint as a signed long. Null and wordless texts have 0."""
    def work(texts):
        return [pa.array(np.array([fingerprint(t, words) for t in texts], dtype=np.uint64).view(np.int64))]

    return map_texts(docs, keep, "fp long", work)


def _blocks(bits: int) -> list[tuple[int, int]]:
    """(first bit, length) of blocks such that `bits` flips leave some block with at most one."""
    count = max(1, (bits + 2) // 2)
    cuts = [64 * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _anchors(fps: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(key, index into fps, is home) of every anchor within covering radius + 1 of each block."""
    fps = fps.view(np.uint64)
    index = np.arange(fps.size)
    one = np.uint64(1)
    for number, (first, length) in enumerate(_blocks(bits)):
        mask = np.uint64((1 << length) - 1)
        value = (fps >> np.uint64(first)) & mask
        r = (length + 1).bit_length() - 1
        coded = (1 << r) - 1
        syndrome = np.zeros(fps.size, dtype=np.uint64)
        for position in range(1, coded + 1):
            syndrome ^= ((value >> np.uint64(position - 1)) & one) * np.uint64(position)

        def flipped(word, position):
            return np.where(position > 0, word ^ (one << (np.maximum(position, one) - one)), word)

        tag = np.uint64(number << 32) if len(_blocks(bits)) > 1 else np.uint64(0)
        home = flipped(value, syndrome)
        yield (home | tag).view(np.int64), index, np.ones(fps.size, dtype=bool)
        for free in range(coded, length):                          # one more flip outside the code
            yield ((home ^ (one << np.uint64(free))) | tag).view(np.int64), index, np.zeros(fps.size, dtype=bool)
        off = np.flatnonzero(syndrome)
        for a in range(1, coded + 1):                              # two flips that together have the syndrome
            other = syndrome[off] ^ np.uint64(a)
            pick = off[(other > a) & (other <= coded)]
            word = flipped(flipped(value[pick], np.full(pick.size, a, dtype=np.uint64)), syndrome[pick] ^ np.uint64(a))
            yield (word | tag).view(np.int64), pick, np.zeros(pick.size, dtype=bool)


def _arrivals(distinct: DataFrame, bits: int, homes_only: bool = False) -> DataFrame:
    def run(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for start in range(0, fps.size, 50_000):
                part = fps[start:start + 50_000]
                for key, index, home in _anchors(part, bits):
                    if home.all() or not homes_only:
                        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[index]), pa.array(home)],
                                                         ["anchor", "fp", "home"])

    return distinct.select("fp").mapInArrow(run, "anchor long, fp long, home boolean")


def _spanning(fps: np.ndarray, homes: int, bits: int) -> list[np.ndarray]:
    """Links that join what the first `homes` fingerprints link among all of one anchor."""
    group = np.arange(fps.size)
    found = []
    for i in range(homes):
        near = np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= bits)
        others, first = np.unique(group[near], return_index=True)
        mine = group[i]
        strange = others != mine
        if strange.any():
            found.append(np.stack([np.full(strange.sum(), fps[i]), fps[near[first[strange]]]]))
            group[np.isin(group, others)] = mine
    return found


def _links(rows: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (anchor, part, home first); a group may go on in the next batch."""
    held: list[np.ndarray] = []

    def out(found):
        u, v = np.concatenate(found, axis=1).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    def compare(block):
        key, fps, home = block
        edges = np.flatnonzero(np.diff(key[0]) | np.diff(key[1])) + 1
        starts = np.concatenate([[0], edges])
        sizes = np.diff(np.concatenate([starts, [fps.size]]))
        homes = np.add.reduceat(home.astype(np.int64), starts)
        found = []
        for width in np.unique(sizes[(sizes > 1) & (sizes <= 16) & (homes > 0)]):   # small groups side by side
            at = starts[(sizes == width) & (homes > 0)]
            count = homes[(sizes == width) & (homes > 0)]
            member = fps[at[:, None] + np.arange(width)]
            for i in range(int(count.max())):
                live = count > i
                near = np.bitwise_count(member[live] ^ member[live][:, i:i + 1]) <= bits
                row, col = np.nonzero(near)
                pair = col != i
                if pair.any():
                    found.append(np.stack([member[live][row[pair], i], member[live][row[pair], col[pair]]]))
        for g in np.flatnonzero((sizes > 16) & (homes > 0)):
            found += _spanning(fps[starts[g]:starts[g] + sizes[g]], int(homes[g]), bits)
        return found

    def columns(batch):
        anchor, fp, home, part = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        return np.stack([anchor, part.astype(np.int64)]), fp.astype(np.int64).view(np.uint64), home

    for batch in rows:
        if not batch.num_rows:
            continue
        key, fps, home = columns(batch)
        held.append((key, fps, home))
        same = (key[0] == key[0, -1]) & (key[1] == key[1, -1])
        if same.all():
            continue                                                # the open group fills this whole batch
        block = [np.concatenate(x, axis=-1) for x in zip(*held)]
        cut = block[1].size - int(same.sum())
        found = compare([x[..., :cut] for x in block])
        held = [tuple(x[..., cut:] for x in block)]
        if found:
            yield out(found)
    if held:
        found = compare([np.concatenate(x, axis=-1) for x in zip(*held)])
        if found:
            yield out(found)


def links(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """Spanning links (u, v) between distinct fingerprints `fp` that differ in at most `bits` bits (0 to 5).

    An anchor with more than HOMES_PER_TASK home values is dealt over several tasks by home; every task of the
    anchor gets all its arrivals. The list of such anchors has at most blocks * fingerprints / HOMES_PER_TASK rows.
    """
    if not 0 <= bits <= 5:
        raise ValueError("bits must be 0 to 5")
    rows = _arrivals(distinct, bits)
    crowded = pin(_arrivals(distinct, bits, homes_only=True).groupBy("anchor").count()
                  .where(F.col("count") > HOMES_PER_TASK)
                  .select("anchor", F.ceil(F.col("count") / HOMES_PER_TASK).cast("int").alias("parts")), "crowded")
    if crowded.isEmpty():
        dealt = rows.withColumn("part", F.lit(0))
    else:
        own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
        dealt = rows.join(crowded, "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1))) \
            .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
            .select("anchor", "fp", (F.col("home") & (own == F.col("part"))).alias("home"), "part")
    parted = dealt.repartition("anchor", "part").sortWithinPartitions("anchor", "part", F.desc("home"))
    return parted.select("anchor", "fp", "home", "part").mapInArrow(lambda rows: _links(rows, bits), "u long, v long")


def classes(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """(fp, component_id) for a table with doc_id and fp; component_id is the smallest doc_id that links reach."""
    distinct = pin(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "fps")
    member = roots(links(distinct, bits))
    rooted = distinct.join(member, distinct.fp == member.node, "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "component_id", "root")


def near_duplicates(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """One row per document: doc_id, fp (signed long), fingerprint (16 hex digits), component_id, root.

    Fingerprints within `bits` bits are linked, and classes are what links connect. A null text counts as empty and
    empty texts are linked like any other (fingerprint 0). Rows with the same doc_id, or a null one, each get their
    row; component_id is null only if all doc_ids of the class are. root, the smallest fingerprint of the class,
    names the class in any case. Other columns are ignored, whatever their names. An empty table gives no rows.
    """
    prints = pin(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"], words),
                 "prints")
    return prints.join(classes(prints, bits), "fp") \
        .select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "root")


def keep_one(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """The documents, one of each class: the smallest doc_id (nulls last), then the smallest text hash.

    Rows equal in both count as copies of one row. Columns and their names stay as they are, whatever they are called.
    A null text counts as empty, and of all texts without words one stays. An empty table gives no rows.
    """
    own = ["doc_id", "text"]
    hashed = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    prints = pin(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                                          hashed.alias("text_hash")), ["doc_id", "text_hash"], words), "prints")
    rows = prints.join(classes(prints, bits), "fp").select("root", "doc_id", "text_hash")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = rows.groupBy("root").agg(F.min(order).alias("best")) \
        .select(F.col("best.doc_id").alias("__id"), F.col("best.text_hash").alias("__hash")).distinct()
    held = packed(docs, own)
    kept = held.withColumn("__h", hashed).join(
        best, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__hash")), "left_semi")
    repeated = pin(rows.groupBy("doc_id", "text_hash").count().where("count > 1").drop("count"), "repeats")
    if repeated.isEmpty():
        return unpacked(kept, docs.columns, own)
    twice = F.col("doc_id").cast("long").eqNullSafe(F.col("__r")) & (F.col("__h") == F.col("__rh"))
    again = repeated.select(F.col("doc_id").alias("__r"), F.col("text_hash").alias("__rh"))
    once = kept.join(again, twice, "left_anti")
    first = kept.join(again, twice, "left_semi").groupBy("doc_id", "__h") \
        .agg(F.min(F.struct(*held.columns)).alias("__row")).select("__row.*")
    return unpacked(once.select(*held.columns).unionByName(first.select(*held.columns)), docs.columns, own)
