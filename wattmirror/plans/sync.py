"""The sync jobs: incremental, repair and backfill over all metrics at once.

Each comes in two forms: over frames (``incremental`` …), which stores nothing, and over a stored fact table
(``store_incremental`` …), which reads only the months that its rows fall into and writes only what changed.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmirror.operators import gating, merge, reconcile, runs
from wattmirror.operators.catalog import selected_metrics
from wattmirror.plans import monthly
from wattmirror.plans.pinned import pin
from wattmirror.sources import statistics as src


TAIL_REACH = timedelta(days=62)      # before the window: where the gate looks for a metric's newest stamps first


@dataclass
class SyncResult:
    """What a sync produced; every part is a DataFrame."""

    mirror: DataFrame
    labelled: DataFrame
    counts: DataFrame
    decisions: DataFrame | None
    watermarks: DataFrame
    catalog: DataFrame
    problems: DataFrame | None = None


def _wanted(stats: DataFrame, meta: DataFrame, catalog: DataFrame,
            lo: datetime | None, hi: datetime | None) -> DataFrame:
    todo, _ = src.available_metrics(selected_metrics(catalog), meta)
    epoch = lambda t: None if t is None else t.timestamp()
    rows = src.timed(src.scan_statistics(stats, meta, epoch(lo), epoch(hi)))
    return rows.join(todo, "statistic_id", "left_semi")


def sync_window(stats: DataFrame, meta: DataFrame, mirror: DataFrame, catalog: DataFrame, periods: DataFrame,
                watermarks: DataFrame, lo: datetime | None, hi: datetime | None, now: Column) -> SyncResult:
    """Read a window, gate it on cadence, merge it, advance the marks from what was merged.

    The window is read once and pinned, and so is the verdict (one row per metric): the merge,
    the counters and the marks all work from the same rows.
    """
    staged, decisions = _gated(_read(stats, meta, catalog, periods, lo, hi), mirror, periods)
    labelled = merge.label_merge(mirror, staged, src.FACT_KEY, merge.COMPARED, now)
    return _result(labelled.drop("merge_label"), labelled, staged, catalog, watermarks, now, decisions)


def _read(stats, meta, catalog, periods, lo=None, hi=None) -> DataFrame:
    """The source rows of a window with their grains, read once."""
    gating.assert_disjoint(periods)
    return src.pin_source(gating.resolve_grain(_wanted(stats, meta, catalog, lo, hi), catalog, periods))


def _gated(rows: DataFrame, stored: DataFrame, periods: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that may be imported, and the verdicts, one row per metric."""
    decisions = src.pin_source(gating.cadence_decision(stored, rows, periods))
    return _staged(gating.apply_decision(rows, decisions)), decisions


def _staged(rows: DataFrame) -> DataFrame:
    staged = src.stage(rows, view=None)
    gating.assert_resolved(src.assert_unique(staged))
    return staged


def _result(mirror, labelled, staged, catalog, watermarks, now, decisions=None, problems=None) -> SyncResult:
    return SyncResult(
        mirror=mirror, labelled=labelled, counts=merge.merge_counts(labelled), decisions=decisions,
        watermarks=merge.advance_watermark(watermarks, staged, now), problems=problems,
        catalog=catalog if decisions is None else gating.flag_halted(catalog, decisions))


def incremental(stats, meta, mirror, catalog, periods, watermarks, now: datetime,
                hours: int = runs.OVERLAP_HOURS) -> SyncResult:
    lo, hi = runs.incremental_window(now, hours)
    return sync_window(stats, meta, mirror, catalog, periods, watermarks, lo, hi, F.lit(now))


def repair(stats, meta, mirror, catalog, periods, watermarks, now: datetime, lo: datetime,
           hi: datetime | None = None) -> SyncResult:
    lo, hi = runs.repair_window(lo, hi)
    return sync_window(stats, meta, mirror, catalog, periods, watermarks, lo, hi, F.lit(now))


def backfill(stats: DataFrame, meta: DataFrame, mirror: DataFrame, catalog: DataFrame, periods: DataFrame,
             watermarks: DataFrame, now: datetime) -> SyncResult:
    """All history of all selected metrics, merged and written once.

    Nothing is stored that could be read back, so the problems are the rows of the read metrics that the source no
    longer has; ``store_backfill`` compares what is stored with the source.
    """
    staged = _staged(_read(stats, meta, catalog, periods))
    labelled = pin(merge.label_merge(mirror, staged, src.FACT_KEY, merge.COMPARED, F.lit(now)), "merged")
    kept = _of_read(labelled.where("merge_label = 'kept'"), staged)
    return _result(labelled.drop("merge_label"), labelled, staged, catalog, watermarks, F.lit(now),
                   problems=reconcile.absent(kept))


def _of_read(rows: DataFrame, staged: DataFrame) -> DataFrame:
    """The rows of metrics that were read."""
    return rows.join(staged.select("statistic_id").distinct(), "statistic_id", "left_semi")


def _compared(staged: DataFrame, mirror: DataFrame) -> DataFrame:
    """Differences over the metrics that were read."""
    return reconcile.reconcile(staged, _of_read(mirror, staged))


# --- on a stored table -----------------------------------------------------------------------

def store_window(path: str, stats: DataFrame, meta: DataFrame, catalog: DataFrame, periods: DataFrame,
                 watermarks: DataFrame, lo: datetime, hi: datetime | None, now: datetime) -> SyncResult:
    """``sync_window`` into a stored table: only the months with incoming rows are read for the merge.

    The facts, the advanced ``watermarks``, the flagged ``catalog`` and the ``counts`` of the run are stored in one
    commit (``read_beside``): after a crash there are all of them or none. ``labelled`` holds the rows that came.
    The gate works from the newest stamps that the last merge committed and reads no stored fact.
    """
    spark = stats.sparkSession
    rows = _read(stats, meta, catalog, periods, lo, hi)
    stamps = merge.stored_stamps(spark, path)
    if stamps is None:                     # before the first merge: months may have been written whole
        stamps = newest_stored(spark, path, periods, lo - TAIL_REACH)
    staged, decisions = _gated(rows, stamps, periods)
    labelled = merge.merge_into_path(path, staged, F.lit(now), beside=_beside(staged, watermarks, now, catalog, decisions))
    return _result(merge.read_facts(spark, path), labelled, staged, catalog, watermarks, F.lit(now), decisions)


def _beside(staged: DataFrame, watermarks: DataFrame, now: datetime, catalog: DataFrame, decisions: DataFrame | None = None):
    """The small tables that a sync commits together with its facts."""
    def tables(labelled: DataFrame) -> dict[str, DataFrame]:
        return {"watermarks": merge.advance_watermark(watermarks, staged, F.lit(now)),
                "counts": merge.merge_counts(labelled).withColumn("finished_at", F.lit(now)),
                "catalog": catalog if decisions is None else gating.flag_halted(catalog, decisions)}
    return tables


def read_beside(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """``watermarks``, ``catalog`` or ``counts`` as the last sync committed them; empty before the first."""
    return monthly.read_table(spark, path, name, schema)


def newest_stored(spark: SparkSession, path: str, periods: DataFrame, since: datetime) -> DataFrame:
    """Stored stamps with, for every judged metric, at least its newest ones the gate asks for.

    Months before ``since`` are read only if a metric has too few stamps after it, and then for such metrics only.
    """
    judged = gating.judged_metrics(periods).select("statistic_id", "last_from")
    stamps = lambda rows: rows.select("statistic_id", "start_at")
    recent = stamps(merge.read_facts(spark, path, since))
    enough = (recent.join(judged, "statistic_id").where(F.col("start_at") >= F.col("last_from"))
                    .groupBy("statistic_id").count().where(F.col("count") >= gating.STORED_TAIL))
    short = judged.join(enough, "statistic_id", "left_anti").where(F.col("last_from") < F.lit(since))
    if short.isEmpty():
        return recent
    return recent.unionByName(stamps(merge.read_facts(spark, path, hi=since)).join(short, "statistic_id", "left_semi"))


def store_incremental(path, stats, meta, catalog, periods, watermarks, now: datetime,
                      hours: int = runs.OVERLAP_HOURS) -> SyncResult:
    lo, hi = runs.incremental_window(now, hours)
    return store_window(path, stats, meta, catalog, periods, watermarks, lo, hi, now)


def store_repair(path, stats, meta, catalog, periods, watermarks, now: datetime, lo: datetime,
                 hi: datetime | None = None) -> SyncResult:
    lo, hi = runs.repair_window(lo, hi)
    return store_window(path, stats, meta, catalog, periods, watermarks, lo, hi, now)


def store_backfill(path: str, stats: DataFrame, meta: DataFrame, catalog: DataFrame, periods: DataFrame,
                   watermarks: DataFrame, now: datetime) -> SyncResult:
    """All history into a stored table; what the table then holds is read back and compared with the source."""
    spark = stats.sparkSession
    staged = _staged(_read(stats, meta, catalog, periods))
    labelled = merge.merge_into_path(path, staged, F.lit(now), beside=_beside(staged, watermarks, now, catalog))
    stored = merge.read_facts(spark, path)
    return _result(stored, labelled, staged, catalog, watermarks, F.lit(now), problems=_compared(staged, stored))


def verify_stored(path: str, stats: DataFrame, meta: DataFrame, catalog: DataFrame, periods: DataFrame) -> DataFrame:
    """Every difference between the source as it is now and what is stored."""
    staged = _staged(_read(stats, meta, catalog, periods))
    return _compared(staged, merge.read_facts(stats.sparkSession, path))


def run_failed(result: SyncResult) -> Column:
    """Scalar: whether the run must be logged as failed (halted metrics or reconcile problems)."""
    if result.problems is not None:
        return result.problems.groupBy().agg((F.count(F.lit(1)) > 0).alias("failed")).scalar()
    return result.decisions.groupBy().agg(
        (F.count(F.when(F.col("action") == "halt", 1)) > 0).alias("failed")).scalar()
