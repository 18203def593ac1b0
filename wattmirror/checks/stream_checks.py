"""Streaming forms. Each runs the event file as a stream to its end and reads what it wrote.

A clock row with the newest event time ends the stream, so the oracles are those of the batch forms.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wattmirror.checks import event_checks as b
from wattmirror.checks import mirror_checks as mc
from wattmirror.checks import model as m
from wattmirror.checks.registry import check, with_ctes
from wattmirror.operators import merge
from wattmirror.session import ROCKSDB, work_dir
from wattmirror.streaming import detections, mirror
from wattmirror.streaming import rules as ru

HOUR = 3_600_000_000

def event_stream(spark, sf_dir):
    schema = m.table(spark, sf_dir, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return raw.select("event_id", F.col("user_id").alias("entity_id"), F.col("ts").cast("timestamp").alias("ts"),
                      F.col("event_type").alias("state"), "value")


def clock(spark, sf_dir):
    """A stream of one clock row: the newest event time, up to the next full millisecond, as watermarks have it."""
    folder = f"{work_dir(spark)}/clock-{uuid.uuid4().hex}"
    newest = m.events(spark, sf_dir).agg(F.max(F.unix_micros("ts")).alias("us"))
    row = newest.select(F.timestamp_micros((F.ceil(F.col("us") / 1000) * 1000).cast("bigint")).alias("ts"))
    row.write.parquet(folder)
    return spark.readStream.schema(row.schema).parquet(folder)


def fired(spark, sf_dir, rule, only=None):
    """Run a detection to the end of the file and return what it wrote."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    out = f"{work_dir(spark)}/fired-{uuid.uuid4().hex}"
    stream = event_stream(spark, sf_dir)
    if only:
        stream = stream.where(F.col("state").isin(*only))
    stream = stream.unionByName(clock(spark, sf_dir), allowMissingColumns=True)
    query = (detections.detect(stream, rule, "0 seconds").writeStream.format("parquet").outputMode("append")
             .option("checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True).start(out))
    query.awaitTermination()
    return spark.read.schema(detections.FIRED_SCHEMA).parquet(out)


@check("st_01_stream_transitions", with_ctes(b.EV_SQL, b.CH_SQL, select="""
SELECT entity_id, event_id, ts, from_state, state FROM ch
WHERE from_state IN ('click', 'view') AND state IN ('purchase', 'error')"""))
def transitions(spark, sf_dir):
    rule = ru.Transition(("click", "view"), ("purchase", "error"))
    return fired(spark, sf_dir, rule).drop("fires_at")


@check("st_04_stream_held_for", with_ctes(b.EV_SQL, b.CH_SQL, select=f"""
SELECT entity_id, event_id, ts, state, ts + INTERVAL 6 HOUR AS fires_at FROM runs
WHERE state IN ('click', 'error') AND coalesce(changed_at, {b.HORIZON}) >= ts + INTERVAL 6 HOUR"""))
def held(spark, sf_dir):
    return fired(spark, sf_dir, ru.HeldFor(("click", "error"), 6 * HOUR)).drop("from_state")


@check("st_05_stream_debounce", f"""
SELECT entity_id, event_id, ts FROM (SELECT user_id AS entity_id, event_id, ts, lead(ts) OVER w AS nxt FROM events
  WHERE event_type = 'click' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
WHERE nxt > ts + INTERVAL 2 DAY OR (nxt IS NULL AND {b.HORIZON} >= ts + INTERVAL 2 DAY)""")
def debounced(spark, sf_dir):
    return fired(spark, sf_dir, ru.Debounce(48 * HOUR), only=["click"]).select("entity_id", "event_id", "ts")


@check("st_06_stream_suppress_active", """
WITH RECURSIVE acc AS (
  SELECT user_id, min(ts) AS ts FROM events GROUP BY 1
  UNION ALL
  SELECT a.user_id, min(e.ts) FROM acc a JOIN events e ON e.user_id = a.user_id AND e.ts >= a.ts + INTERVAL 12 HOUR
  GROUP BY a.user_id, a.ts)
SELECT a.user_id AS entity_id, min(e.event_id) AS event_id, a.ts FROM acc a JOIN events e ON e.user_id = a.user_id AND e.ts = a.ts
GROUP BY 1, 3""")
def cooled(spark, sf_dir):
    return fired(spark, sf_dir, ru.CoolDown(12 * HOUR)).select("entity_id", "event_id", "ts")


@check("st_19_stream_latch", with_ctes(b.EV_SQL, select="""
SELECT entity_id, event_id, ts, flag FROM (SELECT *, CASE WHEN state = 'purchase' THEN 'true' ELSE 'false' END AS flag,
    coalesce(lag(state = 'purchase') OVER (PARTITION BY entity_id ORDER BY ts, event_id), false) AS was
  FROM ev WHERE state IN ('purchase', 'error')) WHERE (flag = 'true') <> was"""))
def latched(spark, sf_dir):
    out = fired(spark, sf_dir, ru.Latch(("purchase",), ("error",)))
    return out.select("entity_id", "event_id", "ts", F.col("state").alias("flag"))


@check("st_23_stream_hourly_stats", with_ctes(f"h AS ({b.HOURLY_SQL})", select="""
SELECT CAST(entity_id AS VARCHAR) AS statistic_id, start_at, mean, min, max, state, sum FROM h"""))
def hourly(spark, sf_dir):
    """Update mode into the mirror: open hours are there too, and get corrected."""
    out = f"{work_dir(spark)}/hours-{uuid.uuid4().hex}"
    rows = mirror.hourly_stats(event_stream(spark, sf_dir), "1 hour")
    mirror.late_upsert(rows, out, f"{out}-checkpoint").trigger(availableNow=True).start().awaitTermination()
    return b.rounded(merge.read_months(spark, out).select("statistic_id", "start_at", "mean", "min", "max", "state", "sum"))


@check("st_22_late_upsert", with_ctes(*mc.BOTH, mc.INC_SQL, mc.MERGE_SQL, select="""
SELECT statistic_id, start_at, CASE WHEN merge_label IN ('inserted', 'updated') THEN new_state ELSE old_state END AS state,
  CASE WHEN merge_label IN ('inserted', 'updated') THEN new_sum ELSE old_sum END AS sum FROM lab"""))
def late(spark, sf_dir):
    """An old copy arrives first, corrections of weeks-old hours afterwards."""
    base = f"{work_dir(spark)}/late-{uuid.uuid4().hex}"
    rows = lambda df, no: df.withColumn("version", F.lit(no))
    first = rows(mc.mirror_table(spark, sf_dir).drop("synced_at"), 1)
    first.coalesce(1).write.mode("append").parquet(f"{base}/in")
    rows(mc.incoming_rows(spark, sf_dir), 2).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(first.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    writer = mirror.late_upsert(stream, f"{base}/out", f"{base}/checkpoint", order=["version"], mode="append")
    writer.trigger(availableNow=True).start().awaitTermination()
    return merge.read_months(spark, f"{base}/out").select("statistic_id", "start_at", "state", "sum")
