"""Measurement views and the freshness view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattmirror.functions.timecols import seconds_between

# Categories per measurement view.
TEMPERATURE_CATEGORIES = ["environmental_temperature", "machine_temperature"]
POWER_CATEGORY = "device_power"
FAHRENHEIT = "°F"


def v_temperature(stat: DataFrame, catalog: DataFrame) -> DataFrame:
    """Temperatures in degrees Celsius, whatever unit the source records."""
    sensors = (catalog.where(F.col("category").isin(TEMPERATURE_CATEGORIES))
                      .select("statistic_id", "display_name", "category",
                              F.col("unit_of_measurement").alias("source_unit"), "is_active"))
    celsius = lambda name: (F.when(F.col("source_unit") == FAHRENHEIT, (F.col(name) - 32) * 5.0 / 9.0)
                             .otherwise(F.col(name)).alias(f"{name}_c"))
    return stat.join(sensors, "statistic_id").select(
        "statistic_id", "display_name", "category", "start_at", "grain",
        celsius("mean"), celsius("min"), celsius("max"), "source_unit", "is_active")


def v_power(stat: DataFrame, catalog: DataFrame) -> DataFrame:
    """Instantaneous power; read as it is, never summed."""
    sensors = (catalog.where(F.col("category") == POWER_CATEGORY)
                      .select("statistic_id", "display_name", "is_active"))
    return stat.join(sensors, "statistic_id").select(
        "statistic_id", "display_name", "start_at", "grain",
        F.col("mean").alias("mean_w"), F.col("min").alias("min_w"), F.col("max").alias("max_w"),
        "is_active")


def v_source_status(catalog: DataFrame, stat: DataFrame, runs: DataFrame, now) -> DataFrame:
    """Per metric: first and last value, rows, age, and the state of the sync runs.

    ``stale_for`` is seconds. ``last_error`` is the error of the newest failed run, NULL
    included, so the whole (started_at, error) pair is compared and only then unpacked.
    """
    observed = stat.groupBy("statistic_id").agg(
        F.min("start_at").alias("first_value_at"),
        F.max("start_at").alias("last_value_at"),
        F.count(F.lit(1)).alias("rows_imported"))
    failed = F.when(F.col("status") == "failed", F.struct("started_at", "id"))
    recent = runs.groupBy().agg(
        F.max(F.when(F.col("status") == "success", F.col("finished_at"))).alias("last_success_at"),
        F.max("started_at").alias("last_run_at"),
        F.max_by(F.struct("error"), failed).alias("newest_failure"))
    newest = recent.select(F.struct("*")).scalar()
    return (catalog.join(observed, "statistic_id", "left")
                   .withColumn("runs", newest)
                   .select("statistic_id", "display_name", "category", "is_active",
                           "grain_review_required", F.col("default_grain").alias("expected_cadence"),
                           "first_value_at", "last_value_at", "rows_imported",
                           seconds_between(F.col("last_value_at"), now).alias("stale_for"),
                           "runs.last_success_at", "runs.last_run_at",
                           F.col("runs.newest_failure.error").alias("last_error")))
