"""Detections over several micro-batches against their batch forms."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattmirror.operators import events as ev
from wattmirror.operators import merge
from wattmirror.streaming import detections, mirror
from wattmirror.streaming import rules as ru

SECOND = 1_000_000
T0 = datetime(2024, 1, 1)
SCHEMA = "entity_id bigint, event_id bigint, ts timestamp, state string, value double, attrs string"


@pytest.fixture(scope="module")
def rows():
    """Events in rough order: each file reaches back into the one before, but not beyond the delay."""
    rng = random.Random(19)
    times = rng.sample(range(40_000), 1200)
    files = [[] for _ in range(5)]
    for i, s in enumerate(times):
        late = min(4, max(0, (s + rng.randrange(-500, 500)) // 8000))
        who = 0 if i % 3 == 0 else rng.randrange(1, 12)
        files[late].append((who, i, T0 + timedelta(seconds=s), rng.choice("abc"), float(s % 97), None))
    return files


@pytest.fixture(scope="module")
def landed(spark, rows, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("events"))
    for part in rows:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return folder


def stream(spark, landed):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(landed)


def fired(spark, landed, rule, tmp_path):
    out = str(tmp_path / "out")
    query = (detections.detect(stream(spark, landed), rule, "20 minutes").writeStream.format("parquet")
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(out))
    query.awaitTermination()
    return sorted((r.entity_id, r.event_id, r.fires_at) for r in
                  spark.read.schema(detections.FIRED_SCHEMA).parquet(out).collect())


@pytest.fixture(scope="module")
def closed(spark, rows):
    """The events the last watermark has reached, and that watermark."""
    everything = [r for part in rows for r in part]
    end = max(r[2] for r in everything) - timedelta(minutes=20)
    return spark.createDataFrame([r for r in everything if r[2] <= end], SCHEMA), F.lit(end)


def test_transitions(spark, landed, closed, tmp_path):
    batch = ev.transitions(closed[0], "a", ["b", "c"])
    want = sorted((r.entity_id, r.event_id, r.ts) for r in batch.collect())
    assert fired(spark, landed, ru.Transition(("a",), ("b", "c")), tmp_path) == want


def test_held_for(spark, landed, closed, tmp_path):
    batch = ev.held_for(closed[0], ["a"], timedelta(seconds=200), horizon=closed[1])
    want = sorted((r.entity_id, r.event_id, r.fires_at) for r in batch.collect())
    assert want and fired(spark, landed, ru.HeldFor(("a",), 200 * SECOND), tmp_path) == want


def test_a_clock_row_ends_the_stream(spark, rows, tmp_path):
    """Long after its last event an entity still holds a state; the clock lets the last firings out."""
    everything = [r for part in rows for r in part]
    end = max(r[2] for r in everything) + timedelta(hours=2)
    folder = str(tmp_path / "landed")
    for part in [*rows, [(None, None, end, None, None, None)]]:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    batch = ev.held_for(spark.createDataFrame(everything, SCHEMA), ["a"], timedelta(seconds=900),
                        horizon=F.lit(end - timedelta(minutes=20)))
    want = sorted((r.entity_id, r.event_id, r.fires_at) for r in batch.collect())
    assert want and fired(spark, folder, ru.HeldFor(("a",), 900 * SECOND), tmp_path) == want


def test_cool_down(spark, landed, closed, tmp_path):
    batch = ev.suppress_active(closed[0], timedelta(seconds=300))
    want = sorted((r.entity_id, r.event_id, r.ts) for r in batch.collect())
    assert fired(spark, landed, ru.CoolDown(300 * SECOND), tmp_path) == want


def test_hourly_stats_converge_to_the_batch(spark, landed, rows, tmp_path):
    out = str(tmp_path / "facts")
    hours = mirror.hourly_stats(stream(spark, landed), "3 hours")
    mirror.late_upsert(hours, out, str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    got = {(r.statistic_id, r.start_at): (round(r["mean"], 6), r["min"], r["max"], r.state, r["sum"])
           for r in merge.read_facts(spark, out).collect()}
    batch = ev.hourly_stats(spark.createDataFrame([r for part in rows for r in part], SCHEMA))
    want = {(str(r.entity_id), r.start_at): (round(r["mean"], 6), r["min"], r["max"], r.state, r["sum"])
            for r in batch.collect()}
    assert got == want


@pytest.mark.parametrize("groups", [1, 3])
def test_entities_of_one_group_do_not_mix(spark, landed, closed, tmp_path, groups):
    """Entities share their state by groups: the store holds rows for groups, not for entities; without a key is one, too."""
    nobody = lambda df: df.withColumn("entity_id", F.when(F.col("entity_id") != 3, F.col("entity_id")))
    out = str(tmp_path / "out")
    rule = ru.HeldFor(("a",), 200 * SECOND)
    query = (detections.detect(nobody(stream(spark, landed)), rule, "20 minutes", groups).writeStream.format("parquet")
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(out))
    query.awaitTermination()
    batch = ev.held_for(closed[0], ["a"], timedelta(seconds=200), horizon=closed[1])
    want = sorted((-1 if r.entity_id == 3 else r.entity_id, r.event_id, r.fires_at) for r in batch.collect())
    got = spark.read.schema(detections.FIRED_SCHEMA).parquet(out).collect()
    assert want and sorted((-1 if r.entity_id is None else r.entity_id, r.event_id, r.fires_at) for r in got) == want
    timers = spark.read.format("statestore").option("path", str(tmp_path / "cp")).option("stateVarName", "memory").load()
    assert timers.select("key").distinct().count() <= groups
