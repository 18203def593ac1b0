"""Tables stored by month in folders that are never changed, and a manifest that says which folders count.

A month has one folder with its rows as they were last written whole, and after it the changes since, each in a small
folder of its own. A reader takes the newest manifest: it sees all of a commit or nothing of it, and what it has begun
to read stays. A writer writes its folders first and then one small file, moved in under the next version's name. If
it dies before that, its folders are not named anywhere (``vacuum`` removes them); there is nothing to be finished.

One writer at a time: a second one finds its version taken, changes nothing and raises ``Conflict``.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFESTS, TABLES = "_manifests", "_tables"      # Spark skips folders that begin with _


class Conflict(Exception):
    """Another writer has committed since the manifest was read."""


@dataclass
class Manifest:
    """months: the folders of each, the whole one first, then its changes in order; tables: the folder of each."""

    version: int = 0
    months: dict[str, list[str]] = field(default_factory=dict)
    tables: dict[str, str] = field(default_factory=dict)


def current(spark: SparkSession, path: str) -> Manifest:
    """The newest manifest; an empty one where nothing has been written."""
    versions = _versions(spark, path)
    return _load(spark, path, versions[-1]) if versions else Manifest()


def next_folder(manifest: Manifest) -> str:
    """A folder name for the commit after this manifest; names sort as the commits do."""
    return f"{manifest.version + 1:012d}-{uuid.uuid4().hex[:12]}"


def write_rows(rows: DataFrame, path: str, folder: str, order: list[str]) -> None:
    """Write rows, which have a column month, into a new folder of each of their months, sorted by ``order``.

    Rows are range-partitioned, so a key with most of the rows is spread over many tasks, and each file covers a
    narrow range for min/max skipping. Few rows make one file a month.
    """
    (rows.withColumn("rev", F.lit(folder)).repartitionByRange("month", *order).sortWithinPartitions("month", *order)
         .write.mode("append").partitionBy("month", "rev").parquet(path))


def months_of(spark: SparkSession, path: str, folder: str, among: list[str] | None = None) -> list[str]:
    """The months that rows were written for into ``folder``."""
    among = [n[6:] for n in _names(spark, path) if n.startswith("month=")] if among is None else among
    found = []
    for month in among:
        at, fs = _at(spark, f"{path}/month={month}/rev={folder}")
        if fs.exists(at):
            found.append(month)
    return found


def write_table(rows: DataFrame, path: str, name: str, folder: str) -> None:
    rows.write.mode("errorifexists").parquet(f"{path}/{TABLES}/{name}/{folder}")


def commit(spark: SparkSession, path: str, before: Manifest, months: dict[str, list[str]],
           tables: dict[str, str] | None = None) -> Manifest:
    """Make ``months`` and ``tables`` count, beside what ``before`` has; all at once."""
    after = Manifest(before.version + 1, before.months | months, before.tables | (tables or {}))
    target, fs = _at(spark, _file(path, after.version))
    draft, _ = _at(spark, f"{path}/{MANIFESTS}/.{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps({"months": after.months, "tables": after.tables}).encode()))
    out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise Conflict(f"version {after.version} of {path} is taken")
    return after


def read(spark: SparkSession, path: str, manifest: Manifest, schema: str, keys: list[str],
         months: list[str] | None = None) -> DataFrame:
    """The rows of the manifest, with a column month; ``keys`` and month tell which rows a change replaces.

    Months without changes are read as they are. Elsewhere the last change of a key wins, and the rows written whole
    lose the keys that changed. Folders of other months are not listed.
    """
    chosen = {m: folders for m, folders in manifest.months.items() if months is None or m in months}
    at = lambda month, folder: f"{path}/month={month}/rev={folder}"
    load = lambda folders: (spark.read.schema(f"{schema}, month string, rev string").option("basePath", path).parquet(*folders)
                            if folders else spark.createDataFrame([], f"{schema}, month string, rev string"))
    plain = load([at(m, f[0]) for m, f in chosen.items() if len(f) == 1])
    layered = {m: f for m, f in chosen.items() if len(f) > 1}
    if not layered:
        return plain.drop("rev")
    changes = load([at(m, folder) for m, f in layered.items() for folder in f[1:]])
    payload = [c for c in plain.columns if c not in {*keys, "month", "rev"}]
    newest = changes.groupBy("month", *keys).agg(F.max_by(F.struct(*payload), "rev").alias("r")) \
        .select(*keys, *[F.col("r")[c].alias(c) for c in payload], "month")
    whole = load([at(m, f[0]) for m, f in layered.items()]).join(changes.select("month", *keys), ["month", *keys], "left_anti")
    columns = [c for c in plain.columns if c != "rev"]
    return plain.select(columns).unionByName(whole.select(columns)).unionByName(newest.select(columns))


def read_table(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """A table committed together with the months, or an empty one."""
    folder = current(spark, path).tables.get(name)
    return spark.read.schema(schema).parquet(f"{path}/{TABLES}/{name}/{folder}") if folder else spark.createDataFrame([], schema)


def compact(spark: SparkSession, path: str, schema: str, keys: list[str], most_changes: int = 0) -> list[str]:
    """Write months with more than ``most_changes`` changes whole again; returns them. Readers see no difference."""
    held = current(spark, path)
    months = sorted(m for m, folders in held.months.items() if len(folders) - 1 > most_changes)
    if months:
        folder = next_folder(held)
        write_rows(read(spark, path, held, schema, keys, months), path, folder, keys)
        commit(spark, path, held, {m: [folder] for m in months})
    return months


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete folders that none of the ``keep`` newest manifests names, and the older manifests; returns how many folders.

    Only while nobody writes, and not while someone still reads an older version.
    """
    versions = _versions(spark, path)
    held = [_load(spark, path, v) for v in versions[-keep:]]
    named = {f"month={m}/rev={f}" for h in held for m, folders in h.months.items() for f in folders}
    named |= {f"{TABLES}/{name}/{f}" for h in held for name, f in h.tables.items()}
    gone = 0
    for parent, children in ([(f"{path}/{n}", n) for n in _names(spark, path) if n.startswith("month=")]
                             + [(f"{path}/{TABLES}/{n}", f"{TABLES}/{n}") for n in _names(spark, f"{path}/{TABLES}")]):
        for name in _names(spark, parent):
            if f"{children}/{name}" not in named:
                at, fs = _at(spark, f"{parent}/{name}")
                gone += bool(fs.delete(at, True))
    for version in versions[:-keep]:
        at, fs = _at(spark, _file(path, version))
        fs.delete(at, False)
    return gone


def _file(path: str, version: int) -> str:
    return f"{path}/{MANIFESTS}/{version:012d}.json"


def _versions(spark: SparkSession, path: str) -> list[int]:
    names = _names(spark, f"{path}/{MANIFESTS}")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _load(spark: SparkSession, path: str, version: int) -> Manifest:
    at, fs = _at(spark, _file(path, version))
    stream = fs.open(at)
    held = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    return Manifest(version, held["months"], held["tables"])


def _names(spark: SparkSession, folder: str) -> list[str]:
    at, fs = _at(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def _at(spark: SparkSession, path: str):
    """A path and the file system it is on, whichever store that is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())
