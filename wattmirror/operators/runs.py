"""Run log, pipeline health, and fetch windows of the device endpoints."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmirror.functions.timecols import seconds_between

# Overlap re-read by an incremental run, age after which a running run is dead,
# health threshold, first window of a new endpoint, start of a full backfill.
OVERLAP_HOURS = 72
STALE_RUN_HOURS = 6
HEALTH_HOURS = 3
INITIAL_DAYS = 90
BACKFILL_START = date(2015, 1, 1)
REAPED = "process died; reaped at startup"
VERSION = "0.1.0"
SCHEMA_VERSION = 1


def incremental_window(now: datetime, hours: int = OVERLAP_HOURS) -> tuple[datetime, None]:
    """Re-read the last hours, open-ended: recent rows get revised at the source."""
    return now - timedelta(hours=hours), None


def repair_window(lo: datetime, hi: datetime | None = None) -> tuple[datetime, datetime | None]:
    """A half-open slice to import again; empty or inverted is an error, not a no-op."""
    if hi is not None and hi <= lo:
        raise ValueError(f"empty repair range: [{lo}, {hi})")
    return lo, hi


def in_window(rows: DataFrame, lo: datetime | None, hi: datetime | None) -> DataFrame:
    """Literal bounds on the raw column, so they reach the scan."""
    if lo is not None:
        rows = rows.where(F.col("start_at") >= F.lit(lo))
    if hi is not None:
        rows = rows.where(F.col("start_at") < F.lit(hi))
    return rows


def run_record(counts: DataFrame, run_id: Column, mode: str, started: Column, finished: Column,
               window_start: Column, window_end: Column, source_version: Column,
               error: Column | None = None) -> DataFrame:
    """The finished run as one row, from the total line of the merge counters."""
    error = F.lit(None).cast("string") if error is None else error
    total = counts.where(F.col("statistic_id").isNull())
    return total.select(
        run_id.alias("id"), started.alias("started_at"), finished.alias("finished_at"), F.lit(mode).alias("mode"),
        window_start.alias("window_start"), window_end.alias("window_end"), "source_max_ts", "rows_read",
        "rows_inserted", "rows_updated", "rows_unchanged", F.lit(VERSION).alias("exporter_version"),
        F.lit(SCHEMA_VERSION).alias("schema_version"), source_version.alias("source_version"),
        F.when(error.isNull(), "success").otherwise("failed").alias("status"), error.alias("error"))


def latest_runs(log: DataFrame, version: str = "logged_at") -> DataFrame:
    """The newest record of every run in an append-only log."""
    payload = [c for c in log.columns if c != "id"]
    return (log.groupBy("id").agg(F.max_by(F.struct(*payload), version).alias("r"))
               .select("id", "r.*").select(*log.columns))


def reap_stale(runs: DataFrame, now: Column, hours: int = STALE_RUN_HOURS) -> DataFrame:
    """Runs still marked running after their process must have died become abandoned."""
    dead = (F.col("status") == "running") & (F.col("started_at") < now - F.make_dt_interval(hours=F.lit(hours)))
    return runs.withColumns({
        "error": F.when(dead, F.coalesce("error", F.lit(REAPED))).otherwise(F.col("error")),
        "status": F.when(dead, "abandoned").otherwise(F.col("status"))})


def health(runs: DataFrame, catalog: DataFrame, now: Column, max_age_hours: float = HEALTH_HOURS) -> DataFrame:
    """One row: newest successes, halted metrics, and what is wrong, if anything.

    Only incremental runs count for the age: a manual backfill must not hide a stalled pipeline.
    """
    ok = F.col("status") == "success"
    halted = catalog.groupBy().agg(F.count(F.when(F.col("grain_review_required"), 1)).alias("n")).scalar()
    state = runs.groupBy().agg(
        F.max(F.when(ok & (F.col("mode") == "incremental"), F.col("finished_at"))).alias("last_incremental"),
        F.max(F.when(ok, F.col("finished_at"))).alias("last_success")).withColumn("halted", halted)
    age = seconds_between(F.col("last_incremental"), now)
    problems = F.array_compact(F.array(
        F.when(F.col("last_incremental").isNull(), "no incremental run has ever succeeded"),
        F.when(age > max_age_hours * 3600, F.format_string(
            "last incremental success is %d s old, limit %d s", age.cast("bigint"),
            F.lit(int(max_age_hours * 3600)))),
        F.when(F.col("halted") > 0, F.format_string("%d metric(s) wait for a grain review", F.col("halted")))))
    return state.withColumn("problems", problems).withColumn("healthy", F.size("problems") == 0)


def next_window(log: DataFrame, endpoints: DataFrame, today: date, full_backfill: bool = False) -> DataFrame:
    """Where each endpoint's next fetch starts; endpoints that are up to date drop out."""
    done = (log.where("status = 'success'").groupBy("endpoint")
               .agg(F.max("window_end").alias("__done")))
    start = (F.lit(BACKFILL_START) if full_backfill
             else F.coalesce("__done", F.lit(today - timedelta(days=INITIAL_DAYS))))
    return (endpoints.select("endpoint").join(done, "endpoint", "left")
                     .select("endpoint", start.alias("window_start"), F.lit(today).alias("window_end"))
                     .where(F.col("window_start") < F.col("window_end")))


def endpoint_records(ingested: DataFrame, failures: DataFrame) -> DataFrame:
    """Records per endpoint for the run log; a failed endpoint has none and an error."""
    counted = ingested.groupBy("endpoint").agg(F.count(F.lit(1)).alias("__n"))
    joined = counted.join(failures.select("endpoint", "error"), "endpoint", "full_outer")
    failed = F.col("error").isNotNull()
    return joined.select(
        "endpoint", F.when(failed, 0).otherwise(F.coalesce("__n", F.lit(0))).cast("bigint").alias("records_synced"),
        F.when(failed, "failed").otherwise("success").alias("status"), "error")


def sync_status(log: DataFrame) -> DataFrame:
    """The newest run of every endpoint; equal start times go to the higher id."""
    shown = ["window_start", "window_end", "completed_at", "status", "records_synced"]
    return (log.groupBy("endpoint").agg(F.max_by(F.struct(*shown), F.struct("started_at", "id")).alias("r"))
               .select("endpoint", "r.*"))
