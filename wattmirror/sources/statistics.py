"""Reading the recorder's statistics and preparing them for the merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattmirror.functions.timecols import epoch_to_utc
from wattmirror.plans.pinned import pin

# Columns the load depends on, the measures, and the columns of a staged row.
REQUIRED_STATISTICS = {"metadata_id", "start_ts", "mean", "mean_weight", "min", "max", "state", "sum",
                       "last_reset_ts"}
REQUIRED_META = {"id", "statistic_id"}
MEASURES = ["mean", "mean_weight", "min", "max", "state", "sum"]
FACT_KEY = ["statistic_id", "start_at"]


def assert_columns(df: DataFrame, required: set[str], what: str) -> None:
    """Fail when a column is gone: a renamed one would otherwise be read as NULL."""
    absent = sorted(required - set(df.columns))
    if absent:
        raise ValueError(f"{what} lacks required columns: {', '.join(absent)}")


def scan_statistics(stats: DataFrame, meta: DataFrame, since: float | None = None,
                    until: float | None = None) -> DataFrame:
    """All metrics' source rows in [since, until) epoch seconds, in one pass.

    The bounds are literals on the raw column, so they are pushed into the scan.
    """
    assert_columns(stats, REQUIRED_STATISTICS, "statistics")
    assert_columns(meta, REQUIRED_META, "statistics_meta")
    rows = stats
    if since is not None:
        rows = rows.where(F.col("start_ts") >= F.lit(float(since)))
    if until is not None:
        rows = rows.where(F.col("start_ts") < F.lit(float(until)))
    names = meta.select(F.col("id").alias("metadata_id"), "statistic_id")
    return rows.join(names, "metadata_id").select("statistic_id", "start_ts", *MEASURES, "last_reset_ts")


def read_jdbc(spark: SparkSession, url: str, table: str, lower: float, upper: float,
              partitions: int, **options: str) -> DataFrame:
    """The statistics table over JDBC, split by start time into parallel range reads."""
    return spark.read.jdbc(url, table, column="start_ts", lowerBound=str(int(lower)),
                           upperBound=str(int(upper)), numPartitions=partitions, properties=options)


def pin_source(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write the source once and read it back, so that the load and the reconciliation after
    it see the same rows."""
    return pin(df, path=path)


def available_metrics(wanted: DataFrame, meta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Wanted metrics the source has, and wanted metrics it lacks."""
    known = meta.select("statistic_id")
    return (wanted.join(known, "statistic_id", "left_semi"),
            wanted.join(known, "statistic_id", "left_anti"))


def timed(rows: DataFrame) -> DataFrame:
    """Source rows with instants in place of epoch seconds."""
    return rows.select("statistic_id", epoch_to_utc("start_ts").alias("start_at"), *MEASURES,
                       epoch_to_utc("last_reset_ts").alias("last_reset_at"))


def stage(rows: DataFrame, grain: Column | str = "grain", view: str | None = "_incoming") -> DataFrame:
    """The typed staging set, in fact-column order, under a view name for SQL users."""
    grain = F.col(grain) if isinstance(grain, str) else grain
    staged = rows.select(
        F.col("statistic_id").cast("string"), F.col("start_at").cast("timestamp"),
        grain.cast("string").alias("grain"), *[F.col(c).cast("double") for c in MEASURES],
        F.col("last_reset_at").cast("timestamp"))
    if view:
        staged.createOrReplaceTempView(view)
    return staged


def duplicate_keys(staged: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Keys that occur more than once; a staging set must have none."""
    keys = keys or FACT_KEY
    return staged.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def assert_unique(staged: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Raise on a key that comes more than once, naming the first; a merge would double its rows."""
    keys = keys or FACT_KEY
    bad = duplicate_keys(staged, keys).orderBy(*keys).limit(1).collect()
    if bad:
        raise ValueError(f"{', '.join(str(bad[0][k]) for k in keys)} comes {bad[0].rows} times in the staging set")
    return staged
