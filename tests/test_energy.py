"""Golden rows for the energy rules that are easy to get wrong."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattmirror.operators import energy as e
from wattmirror.operators import measures

CATALOG = ("statistic_id string, category string, display_name string, source string, unit_of_measurement string, "
           "energy_role string, max_plausible_kw double, is_active boolean, default_grain string, "
           "grain_review_required boolean")
STAT = "statistic_id string, start_at timestamp, grain string, mean double, min double, max double, state double, sum double"
REVIEW = "statistic_id string, start_at timestamp, decision string"
T0 = datetime(2024, 1, 10, 8)


def hours(n):
    return T0 + timedelta(hours=n)


@pytest.fixture(scope="module")
def catalog(spark):
    return spark.createDataFrame([
        ("meter", "device_energy", "Meter", "recorder", "kWh", "lifetime", 2.0, True, "hour", False),
        ("bill", "home_energy", "Bill", "opower", "kWh", "lifetime", 25.0, True, "hour", False),
        ("far", "environmental_temperature", "Far", "recorder", "°F", None, None, True, "hour", False),
        ("none", "device_power", "None", "recorder", "W", None, None, True, "hour", False)], CATALOG)


def energy(spark, catalog, rows, review=()):
    stat = spark.createDataFrame([(sid, at, grain, None, None, None, state, total) for sid, at, grain, state, total in rows], STAT)
    out = e.v_energy(stat, catalog, spark.createDataFrame(list(review), REVIEW))
    return {(r.statistic_id, r.start_at): r for r in out.collect()}, out


def flags(found, sid, at):
    return list(found[(sid, at)].quality_flags)


def test_first_row_of_a_device_is_unknown_but_counted(spark, catalog):
    found, out = energy(spark, catalog, [("meter", hours(0), "hour", 1.0, 10.0), ("meter", hours(1), "hour", 2.0, 11.0)])
    assert flags(found, "meter", hours(0)) == ["missing_predecessor"]
    day = e.v_energy_daily(out).collect()[0]
    assert (day.bucket_count, day.allocated_buckets, day.unclassified_buckets) == (2, 1, 1)
    assert day.allocated_kwh == 1.0 and day.unallocated_kwh is None


def test_imported_series_is_seeded_from_state_after_any_null_sum(spark, catalog):
    found, _ = energy(spark, catalog, [("bill", hours(0), "hour", 5.0, 5.0), ("bill", hours(1), "hour", 2.0, None),
                                       ("bill", hours(2), "hour", 3.0, 10.0)])
    assert flags(found, "bill", hours(0)) == ["seeded_from_state"]
    assert found[("bill", hours(2))].delta_kwh == 3.0 and flags(found, "bill", hours(2)) == ["seeded_from_state"]


def test_null_sum_is_ok_and_its_successor_may_have_a_gap(spark, catalog):
    found, out = energy(spark, catalog, [("meter", hours(0), "hour", 1.0, 10.0), ("meter", hours(1), "hour", 1.0, None),
                                         ("meter", hours(3), "hour", 1.0, 12.0)])
    row = found[("meter", hours(1))]
    assert (row.delta_kwh, row.delta_source, list(row.quality_flags)) == (None, "sum_delta", ["ok"])
    assert flags(found, "meter", hours(3)) == ["missing_predecessor", "gap"]
    classes = out.select("start_at", e.bucket_class(F.col("quality_flags")).alias("c"))
    assert {r.start_at: r.c for r in classes.collect()} == {hours(0): "unknown", hours(1): "allocated", hours(3): "unallocated"}


def test_exclude_keeps_the_disagreement(spark, catalog):
    rows = [("bill", hours(0), "hour", 5.0, 5.0)] + [("bill", hours(n), "hour", 2.0, 5.0 + n) for n in (1, 2, 3)]
    found, _ = energy(spark, catalog, rows, [("bill", hours(1), "exclude"), ("bill", hours(2), "accept_sum"),
                                             ("bill", hours(3), "accept_state")])
    assert flags(found, "bill", hours(1)) == ["source_disagreement", "reviewed_excluded"]
    assert flags(found, "bill", hours(2)) == ["ok"] and found[("bill", hours(2))].delta_kwh == 1.0
    assert flags(found, "bill", hours(3)) == ["reviewed_state"] and found[("bill", hours(3))].delta_kwh == 2.0


def test_accepting_a_missing_state_is_invalid(spark, catalog):
    found, _ = energy(spark, catalog, [("bill", hours(0), "hour", 5.0, 5.0), ("bill", hours(1), "hour", None, 6.0)],
                      [("bill", hours(1), "accept_state")])
    row = found[("bill", hours(1))]
    assert (row.delta_kwh, row.delta_source, list(row.quality_flags)) == (1.0, "sum_delta", ["review_invalid"])


def test_grain_change_is_no_gap_and_lag_crosses_grains(spark, catalog):
    found, _ = energy(spark, catalog, [("bill", hours(0), "day", 5.0, 5.0), ("bill", hours(24), "hour", 1.0, 6.0)])
    assert flags(found, "bill", hours(24)) == ["grain_transition"]
    assert found[("bill", hours(24))].covered_hours == 24.0


def test_25_hour_daily_step_is_a_gap(spark, catalog):
    at = datetime(2024, 11, 3, 7)
    found, _ = energy(spark, catalog, [("bill", at, "day", 5.0, 5.0), ("bill", at + timedelta(hours=25), "day", 1.0, 6.0)])
    assert flags(found, "bill", at + timedelta(hours=25)) == ["gap"]


def test_unresolved_beats_unallocated(spark, catalog):
    found, out = energy(spark, catalog, [("meter", hours(0), "hour", 1.0, 10.0), ("meter", hours(3), "hour", 1.0, 100.0)])
    assert flags(found, "meter", hours(3)) == ["gap", "implausible_positive"]
    day = e.v_energy_daily(out).collect()[0]
    assert (day.unresolved_kwh, day.unallocated_kwh, day.allocation_coverage) == (90.0, None, None)


def test_fahrenheit_and_missing_rows_in_status(spark, catalog):
    stat = spark.createDataFrame([("far", hours(0), "hour", 50.0, 32.0, 212.0, None, None)], STAT)
    row = measures.v_temperature(stat, catalog).collect()[0]
    assert (row.mean_c, row.min_c, row.max_c) == (10.0, 0.0, 100.0)
    runs = spark.createDataFrame([(1, hours(0), hours(1), "failed", "old"), (2, hours(2), hours(3), "failed", None)],
                                 "id bigint, started_at timestamp, finished_at timestamp, status string, error string")
    status = {r.statistic_id: r for r in measures.v_source_status(catalog, stat, runs, F.lit(hours(5))).collect()}
    assert len(status) == 4 and status["none"].rows_imported is None
    assert status["far"].stale_for == 5 * 3600 and status["far"].last_error is None
