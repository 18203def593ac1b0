"""Keyed merges into the mirror, their counters, and the per-metric watermarks."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattmirror.functions.values import distinct_from
from wattmirror.plans import monthly
from wattmirror.plans.pinned import pin
from wattmirror.sources.statistics import FACT_KEY, assert_unique

# The stored columns, and those that decide whether a row has changed.
FACT_SCHEMA = ("statistic_id string, start_at timestamp, grain string, mean double, mean_weight double, min double, "
               "max double, state double, sum double, last_reset_at timestamp, synced_at timestamp")
STAMPS, STAMPS_SCHEMA = "stamps", "statistic_id string, start_at timestamp"
TAIL = 4                       # newest stamps kept per metric
MOST_CHANGES = 24              # of a month, above which a merge writes it whole again
COMPARED = ["grain", "mean", "mean_weight", "min", "max", "state", "sum", "last_reset_at"]


def label_merge(target: DataFrame, incoming: DataFrame, keys: list[str], compared: list[str],
                now: Column, how: str = "full_outer") -> DataFrame:
    """Merge with a ``merge_label`` per row: inserted, updated, unchanged, kept.

    Only inserted and updated rows take the incoming values and a new ``synced_at``. With ``how`` "right_outer"
    rows that did not come are left out.
    """
    old = target.select(*keys, F.struct(*compared, "synced_at").alias("__old"))
    new = incoming.select(*keys, F.struct(*compared).alias("__new"))
    joined = old.join(new, keys, how)
    was, comes = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    old_values = F.struct(*[F.col(f"__old.{c}") for c in compared])
    label = (F.when(~was, "inserted").when(~comes, "kept")
              .when(distinct_from(old_values, F.col("__new")), "updated").otherwise("unchanged"))
    taken = F.col("merge_label").isin("inserted", "updated")
    return joined.withColumn("merge_label", label).select(
        *keys, *[F.when(taken, F.col(f"__new.{c}")).otherwise(F.col(f"__old.{c}")).alias(c) for c in compared],
        F.when(taken, now).otherwise(F.col("__old.synced_at")).alias("synced_at"), "merge_label")


def upsert_changed(target: DataFrame, incoming: DataFrame, now: Column, keys: list[str] | None = None,
                   compared: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The merged table and its counters per metric."""
    labelled = label_merge(target, incoming, keys or FACT_KEY, compared or COMPARED, now)
    return labelled.drop("merge_label"), merge_counts(labelled)


def merge_counts(labelled: DataFrame) -> DataFrame:
    """read / inserted / updated / unchanged per metric, and in total where the id is NULL."""
    came = F.col("merge_label") != "kept"
    count = lambda test: F.count(F.when(test, F.lit(1)))
    of = lambda name: count(F.col("merge_label") == name)
    return (labelled.where(came).rollup("statistic_id")
                    .agg(count(came).alias("rows_read"), of("inserted").alias("rows_inserted"),
                         of("updated").alias("rows_updated"), of("unchanged").alias("rows_unchanged"),
                         F.max("start_at").alias("source_max_ts")))


def upsert_latest(target: DataFrame, incoming: DataFrame, keys: list[str], arrival: list[str],
                  now: Column) -> DataFrame:
    """Last record per key wins, unconditionally; every incoming key gets a new synced_at.

    Repeats of a key inside the batch are reduced with max_by, which combines before the
    shuffle, so one key repeated very often costs one row per task.
    """
    payload = [c for c in target.columns if c not in {*keys, "synced_at"}]
    newest = (incoming.groupBy(*keys)
                      .agg(F.max_by(F.struct(*payload), F.struct(*arrival)).alias("r"))
                      .select(*keys, "r.*", now.alias("synced_at")))
    return target.join(newest, keys, "left_anti").unionByName(newest.select(*target.columns))


def write_months(facts: DataFrame, path: str) -> None:
    """Store facts by month of start_at, replacing the months that occur, all at once."""
    spark = facts.sparkSession
    held = monthly.current(spark, path)
    held.tables.pop(STAMPS, None)          # the next merge makes them anew
    folder = monthly.next_folder(held)
    monthly.write_rows(with_month(facts), path, folder, FACT_KEY)
    monthly.commit(spark, path, held, {m: [folder] for m in monthly.months_of(spark, path, folder)})


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("month", F.date_format("start_at", "yyyy-MM"))


def read_months(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """A stored fact table as of now, or an empty one where nothing has been written yet."""
    return monthly.read(spark, path, monthly.current(spark, path), FACT_SCHEMA, FACT_KEY, months)


def read_facts(spark: SparkSession, path: str, lo: datetime | None = None, hi: datetime | None = None) -> DataFrame:
    """Stored rows with start_at in [lo, hi); whole months outside are not even listed."""
    held = monthly.current(spark, path)
    inside = [m for m in held.months if (lo is None or m >= f"{lo:%Y-%m}") and (hi is None or m <= f"{hi:%Y-%m}")]
    rows = monthly.read(spark, path, held, FACT_SCHEMA, FACT_KEY, inside)
    if lo is not None:
        rows = rows.where((F.col("month") >= f"{lo:%Y-%m}") & (F.col("start_at") >= F.lit(lo)))
    if hi is not None:
        rows = rows.where((F.col("month") <= f"{hi:%Y-%m}") & (F.col("start_at") < F.lit(hi)))
    return rows.drop("month")


def merge_into_path(path: str, incoming: DataFrame, now: Column, most_changes: int = MOST_CHANGES,
                    beside: Callable[[DataFrame], dict[str, DataFrame]] | None = None) -> DataFrame:
    """Merge a staged batch into a stored fact table; returns the incoming rows with their labels.

    Only the months the batch touches are read, and only inserted and updated rows are written, as a change of their
    months. ``beside`` makes further small tables from the labelled rows (watermarks, a run record): they are committed
    together with the facts, and so are the newest stamps of every metric (``stored_stamps``). A job that dies leaves the table as it was, and a rerun arrives at the same. Months with
    more than ``most_changes`` changes are then written whole again. Raises on repeated keys.
    """
    spark = incoming.sparkSession
    held = monthly.current(spark, path)
    batch = pin(with_month(assert_unique(incoming)), "batch")
    months = [r.month for r in batch.select("month").distinct().collect()]      # one row per month
    stored = monthly.read(spark, path, held, FACT_SCHEMA, FACT_KEY, months)
    written = pin(label_merge(stored, batch, FACT_KEY, COMPARED, now, how="right_outer"), "merged")
    folder = monthly.next_folder(held)
    monthly.write_rows(with_month(written.where("merge_label IN ('inserted', 'updated')").drop("merge_label")), path, folder, FACT_KEY)
    changed = monthly.months_of(spark, path, folder, months)
    tables = beside(written) if beside else {}
    if changed:
        tables |= _advanced_stamps(spark, path, held, written.where("merge_label = 'inserted'"))
    for name, rows in tables.items():
        monthly.write_table(rows, path, name, folder)
    if changed or tables:
        monthly.commit(spark, path, held, {m: [*held.months.get(m, []), folder] for m in changed}, dict.fromkeys(tables, folder))
        monthly.compact(spark, path, FACT_SCHEMA, FACT_KEY, most_changes)
    return written


def newest_stamps(stamps: DataFrame, n: int = TAIL) -> DataFrame:
    """The n newest of each metric's stamps; cut to n in every task before they are shuffled."""
    place = F.row_number().over(Window.partitionBy("statistic_id").orderBy(F.col("start_at").desc()))
    return stamps.select(*FACT_KEY).withColumn("__place", place).where(F.col("__place") <= n).drop("__place")


def _advanced_stamps(spark: SparkSession, path: str, held: monthly.Manifest, inserted: DataFrame) -> dict[str, DataFrame]:
    """The newest stamps with the inserted rows, if these change them: corrections and late rows write none."""
    known = stored_stamps(spark, path, held)
    if known is None:                      # once: all stored keys are read
        known = newest_stamps(monthly.read(spark, path, held, FACT_SCHEMA, FACT_KEY))
        return {STAMPS: newest_stamps(known.unionByName(newest_stamps(inserted)))}
    newest = newest_stamps(known.unionByName(newest_stamps(inserted)))
    return {} if newest.join(known, FACT_KEY, "left_anti").isEmpty() else {STAMPS: newest}


def stored_stamps(spark: SparkSession, path: str, held: monthly.Manifest | None = None) -> DataFrame | None:
    """The newest stamps of every stored metric as the last merge committed them; None where no merge has."""
    folder = (held or monthly.current(spark, path)).tables.get(STAMPS)
    return spark.read.schema(STAMPS_SCHEMA).parquet(f"{path}/{monthly.TABLES}/{STAMPS}/{folder}") if folder else None


# --- watermarks ----------------------------------------------------------------------------

def advance_watermark(watermarks: DataFrame, committed: DataFrame, now: Column) -> DataFrame:
    """Per metric the greater of the old mark and the newest committed row."""
    newest = committed.groupBy("statistic_id").agg(F.max("start_at").alias("__new"))
    joined = watermarks.join(newest, "statistic_id", "full_outer")
    return joined.select(
        "statistic_id", F.greatest("source_max_ts", "__new").alias("source_max_ts"),
        F.when(F.col("__new").isNotNull(), now).otherwise(F.col("observed_at")).alias("observed_at"))


def seed_watermark(watermarks: DataFrame, stat: DataFrame, now: Column) -> DataFrame:
    """Marks for metrics that have none yet, from what the mirror holds."""
    found = stat.groupBy("statistic_id").agg(F.max("start_at").alias("source_max_ts"))
    fresh = found.join(watermarks.select("statistic_id"), "statistic_id", "left_anti")
    return watermarks.unionByName(fresh.withColumn("observed_at", now))


def bound_by_watermark(df: DataFrame, watermarks: DataFrame) -> DataFrame:
    """Rows up to and including their metric's mark; a metric without one is unbounded."""
    marks = watermarks.select("statistic_id", F.col("source_max_ts").alias("__mark"))
    within = F.col("__mark").isNull() | (F.col("start_at") <= F.col("__mark"))
    return df.join(marks, "statistic_id", "left").where(within).drop("__mark")
