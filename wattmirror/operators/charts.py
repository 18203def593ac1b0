"""Chart queries: local-time buckets, gap filling, interval selection and result shapes.

Range filters stay on the raw instant column, so they reach the scan; only the bucket
expression pays for the time zone. All ranges are half-open [start, end).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattmirror.functions.timecols import (BUCKET_SECONDS, LOCAL_TZ, bin_number, bucket_label,
                                           day_start, iso_utc, local_bin, local_day)
from wattmirror.operators.measures import TEMPERATURE_CATEGORIES

# Fixed value: a metric without a newer value than this is stale.
STALE_AFTER_SECONDS = 7200


def _last_instant(end: Column) -> Column:
    """The last microsecond inside a half-open range."""
    return F.timestamp_micros(F.unix_micros(end) - 1)


def _step(bucket: str) -> int | None:
    if bucket not in BUCKET_SECONDS:
        raise ValueError(f"bucket {bucket!r} is not one of {sorted(BUCKET_SECONDS)}")
    return BUCKET_SECONDS[bucket]


def bucket_count(requests: DataFrame, bucket: str, tz: str = LOCAL_TZ) -> DataFrame:
    """Points per series for each (start, end) request; equals the generated series length."""
    step = _step(bucket)
    start, end = F.col("start"), F.col("end")
    if step is None:
        count = F.datediff(local_day(end, tz), local_day(start, tz))
    else:
        count = bin_number(_last_instant(end), step, tz) - bin_number(start, step, tz) + 1
    return requests.withColumn("points", F.greatest(count, F.lit(0)).cast("bigint"))


def resolve_ids(status: DataFrame, categories: list[str], ids: list[str] | None = None,
                include_inactive: bool = False) -> DataFrame:
    """The metrics a request means; only ids the catalog knows can come back."""
    found = status.where(F.col("category").isin(categories))
    if not include_inactive:
        found = found.where("is_active")
    if ids:
        found = found.where(F.col("statistic_id").isin(ids))
    return found.select("statistic_id", "display_name").orderBy("display_name")


def day_bounds(start: Column, end: Column, tz: str = LOCAL_TZ) -> tuple[Column, Column, Column, Column]:
    """First day, day after the last, and both as instants."""
    d0, d1 = local_day(start, tz), local_day(end, tz)
    return d0, d1, day_start(d0, tz), day_start(d1, tz)


def bucket_series(ids: DataFrame, start: Column, end: Column, bucket: str, tz: str = LOCAL_TZ) -> DataFrame:
    """Every bucket of the range for every id. Each id row explodes into its own series."""
    step = _step(bucket)
    if step is None:
        d0, d1, _, _ = day_bounds(start, end, tz)
        # A range inside one local day has no complete day, hence an empty series.
        points = F.when(d1 > d0, F.sequence(d0, F.date_sub(F.greatest(d1, F.date_add(d0, 1)), 1)))
    else:
        lo = local_bin(start, step, tz)
        hi = local_bin(_last_instant(end), step, tz)
        points = F.when(hi >= lo, F.sequence(lo, F.greatest(lo, hi), F.expr(f"INTERVAL {step} SECOND")))
    return ids.select("statistic_id", F.explode(points).alias("bucket"))


def agg_measure(view: DataFrame, start: Column, end: Column, bucket: str, tz: str = LOCAL_TZ,
                unit: str = "c") -> DataFrame:
    """Mean of means, min of mins and max of maxes per metric and bucket."""
    step = _step(bucket)
    if step is None:
        _, _, lo, hi = day_bounds(start, end, tz)
        place = local_day("start_at", tz)
    else:
        lo, hi, place = start, end, local_bin("start_at", step, tz)
    return (view.where((F.col("start_at") >= lo) & (F.col("start_at") < hi))
                .groupBy("statistic_id", place.alias("bucket"))
                .agg(F.avg(f"mean_{unit}").alias("mean"), F.min(f"min_{unit}").alias("min"),
                     F.max(f"max_{unit}").alias("max")))


def gap_fill(series: DataFrame, values: DataFrame) -> DataFrame:
    """Series rows with their values; a bucket without any stays, with NULLs."""
    return series.join(values, ["statistic_id", "bucket"], "left")


def chart_measure(view: DataFrame, status: DataFrame, categories: list[str], start: Column, end: Column,
                  bucket: str, ids: list[str] | None = None, include_inactive: bool = False,
                  tz: str = LOCAL_TZ) -> DataFrame:
    """The temperature and power chart: resolved ids, filled buckets, labels."""
    temperature = "mean_c" in view.columns
    allowed = TEMPERATURE_CATEGORIES if temperature else ["device_power"]
    unknown = sorted(set(categories) - set(allowed))
    if unknown:
        raise ValueError(f"unknown category: {unknown}")
    chosen = resolve_ids(status, categories, ids, include_inactive)
    wanted = view.join(chosen.select("statistic_id"), "statistic_id", "left_semi")
    values = agg_measure(wanted, start, end, bucket, tz, "c" if temperature else "w")
    filled = gap_fill(bucket_series(chosen, start, end, bucket, tz), values)
    label = F.col("bucket").cast("string") if bucket == "day" else bucket_label("bucket", tz)
    return filled.withColumn("label", label)


def to_chart(filled: DataFrame) -> DataFrame:
    """One row per metric: its points in order as JSON, empty buckets with explicit nulls.

    A metric's list has one entry per bucket of the requested range (see bucket_count), not
    per stored row.
    """
    point = F.struct("bucket", F.col("label"), "mean", "min", "max")
    return (filled.groupBy("statistic_id").agg(F.sort_array(F.collect_list(point)).alias("points"))
                  .select("statistic_id", F.to_json(
                      F.transform("points", lambda p: F.struct(
                          p["label"].alias("bucket"), p["mean"].alias("mean"),
                          p["min"].alias("min"), p["max"].alias("max"))),
                      {"ignoreNullFields": "false"}).alias("points")))


def chart_energy_daily(daily: DataFrame, status: DataFrame, start: Column, end: Column,
                       categories: list[str], ids: list[str] | None = None,
                       include_inactive: bool = False, tz: str = LOCAL_TZ) -> DataFrame:
    """Daily energy for every local day of the range, clipped to it, coverage included."""
    d0, d1, _, _ = day_bounds(start, end, tz)
    chosen = resolve_ids(status, categories, ids, include_inactive)
    values = (daily.where((F.col("local_day") >= d0) & (F.col("local_day") < d1))
                   .select("statistic_id", F.col("local_day").alias("bucket"), "allocated_kwh",
                           "unallocated_kwh", "unresolved_kwh", "temporal_coverage",
                           "allocation_coverage"))
    return gap_fill(bucket_series(chosen, start, end, "day", tz), values)


def overlaps(start: Column, end: Column) -> Column:
    """Intervals sharing an instant with [start, end); rows without a start are points."""
    lo, hi = F.col("covered_from"), F.col("covered_until")
    point = lo.isNull() & (hi >= start) & (hi < end)
    interval = lo.isNotNull() & (hi > start) & (lo < end)
    return point | interval


def chart_billing(billing: DataFrame, chosen: DataFrame, start: Column, end: Column) -> DataFrame:
    """Billing and day rows overlapping the request."""
    return (billing.where(overlaps(start, end))
                   .join(chosen.select("statistic_id"), "statistic_id", "left_semi"))


def limit_truncated(rows: DataFrame, n: int) -> DataFrame:
    """The first n rows over all metrics, and whether there were more.

    n + 1 rows are taken; they are a bounded page, so numbering them in one task is fine.
    """
    order = ["statistic_id", "covered_until"]
    page = rows.orderBy(*order).limit(n + 1)
    counted = page.select(F.struct("*").alias("r")).groupBy().agg(F.sort_array(F.collect_list(
        F.struct(F.col("r.statistic_id"), F.col("r.covered_until"), F.col("r")))).alias("page"))
    return (counted.select(F.explode(F.slice("page", 1, n)).alias("p"),
                           (F.size("page") > n).alias("truncated"))
                   .select("p.r.*", "truncated"))


def to_periods(rows: DataFrame) -> DataFrame:
    """Billing rows as they go out: ISO text, flag list, NULLs kept."""
    return rows.select("statistic_id", F.to_json(F.struct(
        "grain", iso_utc("covered_from").alias("covered_from"), iso_utc("covered_until").alias("covered_until"),
        "covered_hours", "delta_kwh", "delta_source", "review_decision", "quality_flags", "billable_kwh"),
        {"ignoreNullFields": "false"}).alias("period"), "covered_until")


def metric_listing(status: DataFrame) -> DataFrame:
    """The catalog with a stale mark; a metric that never had a value is stale."""
    return status.select(
        "statistic_id", "display_name", "category", "is_active", "last_value_at",
        F.coalesce(F.col("stale_for") > STALE_AFTER_SECONDS, F.lit(True)).alias("stale")
    ).orderBy("category", "display_name")


def status_listing(status: DataFrame) -> DataFrame:
    """Freshness rows with the age in seconds."""
    return status.select(
        "statistic_id", "display_name", "category", "is_active", "grain_review_required",
        "last_value_at", F.col("stale_for").cast("double").alias("stale_seconds"), "rows_imported",
        "last_success_at", "last_error").orderBy("category", "display_name")
