import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattmirror.functions import timecols as tc
from wattmirror.operators import charts as ch


def series(spark, start, end, bucket):
    ids = spark.createDataFrame([("m",)], "statistic_id string")
    return [r.bucket for r in ch.bucket_series(ids, F.lit(start), F.lit(end), bucket).orderBy("bucket").collect()]


def test_unaligned_range_keeps_its_last_bucket(spark):
    got = series(spark, datetime(2024, 1, 1, 8, 30), datetime(2024, 1, 1, 10, 30), "hour")
    assert got == [datetime(2024, 1, 1, h) for h in (0, 1, 2)]


def test_day_series_leaves_out_the_last_day(spark):
    assert series(spark, datetime(2024, 1, 1, 9), datetime(2024, 1, 3, 9), "day") == [date(2024, 1, 1), date(2024, 1, 2)]
    assert series(spark, datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 10), "day") == []


def test_spring_gap_bucket_is_emitted(spark):
    got = series(spark, datetime(2024, 3, 10, 8), datetime(2024, 3, 10, 12), "hour")
    assert got == [datetime(2024, 3, 10, h) for h in (0, 1, 2, 3, 4)]


def test_bucket_count_equals_series_length(spark):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        base = rng.choice([datetime(2024, 3, 9), datetime(2024, 11, 2), datetime(2024, 6, 1)])
        start = base + timedelta(minutes=rng.randrange(3000))
        rows.append((i, start, start + timedelta(minutes=rng.randrange(1, 6000))))
    requests = spark.createDataFrame(rows, "i int, start timestamp, end timestamp")
    for bucket in tc.BUCKET_SECONDS:
        counted = {r.i: r.points for r in ch.bucket_count(requests, bucket).collect()}
        made = requests.withColumn("statistic_id", F.col("i").cast("string"))
        made = ch.bucket_series(made, F.col("start"), F.col("end"), bucket).groupBy("statistic_id").count().collect()
        assert {int(r.statistic_id): r["count"] for r in made} == {i: n for i, n in counted.items() if n}


@pytest.mark.parametrize("wall, want", [
    ("2024-01-01 06:00:00", "2024-01-01T06:00:00-08:00"), ("2024-07-01 06:00:00", "2024-07-01T06:00:00-07:00"),
    ("2024-11-03 01:00:00", "2024-11-03T01:00:00-07:00")])
def test_label_uses_the_first_of_two_hours(spark, wall, want):
    assert spark.range(1).select(tc.bucket_label(F.lit(wall).cast("timestamp_ntz")).alias("x")).first().x == want


def test_fold_hours_share_a_bucket(spark):
    df = spark.createDataFrame([(datetime(2024, 11, 3, 8, 10),), (datetime(2024, 11, 3, 9, 10),)], "ts timestamp")
    assert df.select(tc.local_bin("ts", 3600)).distinct().count() == 1


@pytest.mark.parametrize("day, want", [("2024-03-10", 23.0), ("2024-11-03", 25.0), ("2024-05-05", 24.0)])
def test_expected_hours(spark, day, want):
    assert spark.range(1).select(tc.expected_hours(F.lit(day).cast("date")).alias("h")).first().h == want


def test_billing_overlap_edges(spark):
    at = lambda d: datetime(2024, 1, d)
    rows = spark.createDataFrame([("seed", None, at(5)), ("ends", at(1), at(5)), ("over", at(4), at(6)), ("next", at(9), at(12))],
                                 "n string, covered_from timestamp, covered_until timestamp")
    got = {r.n for r in rows.where(ch.overlaps(F.lit(at(5)), F.lit(at(9)))).collect()}
    assert got == {"seed", "over"}


def test_truncation_flag(spark):
    rows = spark.createDataFrame([("m", datetime(2024, 1, d)) for d in range(1, 6)], "statistic_id string, covered_until timestamp")
    cut = ch.limit_truncated(rows, 3).collect()
    assert len(cut) == 3 and all(r.truncated for r in cut)
    assert not any(r.truncated for r in ch.limit_truncated(rows, 5).collect())


def test_empty_buckets_are_explicit_nulls(spark):
    rows = spark.createDataFrame([("m", "a", "A", None, None, None), ("m", "b", "B", 1.5, 1.0, 2.0)],
                                 "statistic_id string, bucket string, label string, mean double, min double, max double")
    got = ch.to_chart(rows).first().points
    assert got == '[{"bucket":"A","mean":null,"min":null,"max":null},{"bucket":"B","mean":1.5,"min":1.0,"max":2.0}]'


def test_unknown_bucket_and_category(spark):
    df = spark.createDataFrame([], "statistic_id string, mean_c double")
    with pytest.raises(ValueError):
        ch.agg_measure(df, F.lit(0), F.lit(1), "week")
    with pytest.raises(ValueError, match="home_energy"):
        ch.chart_measure(df, df, ["home_energy"], F.lit(0), F.lit(1), "hour")
