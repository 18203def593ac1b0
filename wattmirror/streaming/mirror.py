"""Streams that feed the mirror: hourly statistics and late corrections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from wattmirror.operators.merge import FACT_KEY, merge_into_path
from wattmirror.sources.statistics import MEASURES


def hourly_stats(stream: DataFrame, delay: str, statistic_id: str = "entity_id") -> DataFrame:
    """Mean, min, max, last value and sum per entity and hour, as mirror rows."""
    value = F.col("value")
    hours = (stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
             .groupBy(F.window("ts", "1 hour").alias("w"), F.col(statistic_id).cast("string").alias("statistic_id"))
             .agg(F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"),
                  F.max_by(value, F.struct("ts", "event_id")).alias("state"), F.sum(value).alias("sum")))
    return hours.select(
        "statistic_id", F.col("w.start").alias("start_at"), F.lit("hour").alias("grain"), "mean",
        F.lit(None).cast("double").alias("mean_weight"), "min", "max", "state", "sum",
        F.lit(None).cast("timestamp").alias("last_reset_at"))


def late_upsert(rows: DataFrame, path: str, checkpoint: str, order: list[str] | None = None,
                mode: str = "update") -> DataStreamWriter:
    """Merge a stream of mirror rows into a stored table, however late they come.

    Nothing is dropped for being late: a correction of an old hour is a change like any other. A micro-batch writes
    only its inserted and updated rows, as a change of their months; a month with many changes is written whole by the
    batch that brings one too many, and ``plans.monthly.compact`` does so between runs. The merge is idempotent, so a micro-batch that runs again after a failure changes nothing.
    ``order`` names the columns telling which of two versions of a row in one batch is newer.
    """
    def merge_batch(batch: DataFrame, _: int) -> None:
        newest = batch
        if order:
            payload = ["grain", *MEASURES, "last_reset_at"]
            newest = (batch.groupBy(*FACT_KEY).agg(F.max_by(F.struct(*payload), F.struct(*order)).alias("r"))
                           .select(*FACT_KEY, "r.*"))
        merge_into_path(path, newest, F.current_timestamp())

    return rows.writeStream.outputMode(mode).foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
