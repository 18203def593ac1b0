"""Small helpers the operators share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmirror.plans.pinned import pin
from wattmirror.session import prepare

WORD = r"[^\x20\x09-\x0D]+"
# Texts handed to one round of numpy work, in UTF-8 bytes; a single longer text is a round of its own.
CHUNK_BYTES = 1_000_000


# Rows of an Arrow batch: texts and id lists are wide, and a Python worker holds a batch at a time.
BATCH_ROWS = 1_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def split_of(column: str, parts: int):
    """The fold of a row: crc32 of its id as text, modulo the number of folds (null id: crc32 of '')."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts


def typed(schema: str) -> pa.Schema:
    """The Arrow schema of a short DDL text of longs, ints, doubles, booleans and strings."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
             "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()),
             "array<long>": pa.list_(pa.int64()), "array<float>": pa.list_(pa.float32()),
             "array<double>": pa.list_(pa.float64())}
    fields = [part.split() for part in re.split(r",\s*(?![^<]*>)", schema)]
    return pa.schema([(name, kinds[kind]) for name, kind in fields])


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches so that each piece holds about `limit` bytes of text; null texts read as empty.

    Texts become Python strings piece by piece, so a worker never holds those of a whole batch.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64
        total = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            done = total[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(total, done + limit, side="right")))
            yield batch.slice(start, end - start), [t or "" for t in column.slice(start, end - start).to_pylist()]
            start = end


def map_texts(docs: DataFrame, keep: list[str], adds: str, work: Callable[[list[str]], list[pa.Array]],
              text: str = "text", limit: int = CHUNK_BYTES) -> DataFrame:
    """Run `work` over chunks of texts and put the arrays it returns beside the kept columns."""
    frame = docs.select(*dict.fromkeys([*keep, text]))
    added = typed(adds)
    dropped = text not in keep
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in frame.select(*keep).schema.fields]
                       + [f"`{f.name}` {kind}" for f, kind in
                          zip(added, [p.split()[1] for p in re.split(r",\s*(?![^<]*>)", adds)])])

    def run(batches):
        for batch, texts in chunks(batches, text, limit):
            kept = [(n, batch.column(i)) for i, n in enumerate(batch.schema.names) if not (dropped and n == text)]
            arrays = [pa.array(a, type=f.type) if not isinstance(a, (pa.Array, pa.ChunkedArray)) else a
                      for a, f in zip(work(texts), added)]
            yield pa.RecordBatch.from_arrays([c for _, c in kept] + arrays, [n for n, _ in kept] + added.names)

    return frame.mapInArrow(run, schema)


def packed(docs: DataFrame, own: list[str]) -> DataFrame:
    """The columns of `own` that are there, and all others in one struct `rest`, so that no name of theirs can clash."""
    others = [c for c in docs.columns if c not in own]
    fields = [F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(others)] or [F.lit(0).alias("f0")]
    return docs.select(*[c for c in own if c in docs.columns], F.struct(*fields).alias("rest"))


def unpacked(df: DataFrame, names: list[str], own: list[str]) -> DataFrame:
    """The columns `names` in their order, from what `packed` made of them; all else goes."""
    place = {c: i for i, c in enumerate(c for c in names if c not in own)}
    return df.select(*[F.col(c) if c in own else F.col("rest")[f"f{place[c]}"].alias(c) for c in names])


def without(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*[n for n in names if n in df.columns])


__all__ = ["CHUNK_BYTES", "WORD", "chunks", "map_texts", "packed", "pin", "read", "split_of", "typed", "unpacked",
           "without"]
