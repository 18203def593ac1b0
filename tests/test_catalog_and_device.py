from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wattmirror.functions import labels
from wattmirror.operators import catalog as c
from wattmirror.operators import device_views as dv
from wattmirror.operators import merge
from wattmirror.sources import device_pages as dp


@pytest.mark.parametrize("sid, name, want", [
    ("sensor.tp357s_3d05_temperature", None, "Tp357S 3D05"),
    ("sensor.plant_light_today_s_consumption", "x", "Reviewed"),
    ("sensor.desk_power_temperature", None, "Desk"),          # _temperature goes first, then _power
    ("sensor.desk_temperature_power", None, "Desk Temperature"),
    ("no_domain_power", "", "No Domain"), ("sensor.a.b_power", "Own name", "Own name")])
def test_label(spark, sid, name, want):
    ids = spark.createDataFrame([(sid, name)], "statistic_id string, name string")
    over = spark.createDataFrame([("plant_light", "Reviewed")], "slug string, display_name string")
    assert c.label(ids, over).first().display_name == want


@pytest.mark.parametrize("sid, unit_class, want", [
    ("sensor.p1_today_s_consumption", "energy", "superseded by sensor.p1_total_consumption (lifetime meter)"),
    ("sensor.tv_today_s_consumption", "energy", "unreviewed daily cycle sensor"),
    ("sensor.tv_this_month_s_consumption", "energy", labels.MONTHLY_DUPLICATE.reason),
    ("sensor.pi5_x", "temperature", labels.OTHER_EXCLUSIONS[3].reason), ("sensor.pi5_x", "power", None),
    ("sensor.pi5_x", None, None), ("sensor.elec_account_1_energy_cost", "x", labels.OTHER_EXCLUSIONS[0].reason)])
def test_exclusion_reason(spark, sid, unit_class, want):
    got = spark.range(1).select(labels.exclusion_reason(F.lit(sid), F.lit(unit_class).cast("string")).alias("r"))
    assert got.first().r == want


def test_unreviewed_metric_shows_up(spark):
    meta = spark.createDataFrame([("sensor.new", "energy"), ("sensor.known", "energy"), ("sensor.other", "volume"),
                                  ("opower:x_energy_cost", None)], "statistic_id string, unit_class string")
    known = spark.createDataFrame([("sensor.known",)], "statistic_id string")
    got = {r.statistic_id: r.reviewed for r in c.discovery_audit(meta, known).collect()}
    assert got == {"sensor.new": False, "opower:x_energy_cost": True}


def test_valid_periods_have_no_violations(spark):
    past, a, b = datetime(1, 1, 1), datetime(2024, 1, 1), datetime(2024, 2, 1)
    good = spark.createDataFrame([("m", past, a, "day"), ("m", a, b, "day"), ("m", b, None, "hour")],
                                 "statistic_id string, valid_from timestamp, valid_until timestamp, grain string")
    assert c.validate_periods(good).isEmpty() and c.overlapping_periods(good).isEmpty()
    lone = good.where(F.col("valid_from") == F.lit(a))
    assert sorted(r.kind for r in c.validate_periods(lone).collect()) == ["closed_end", "late_start"]


def test_null_passes_a_check(spark):
    df = spark.createDataFrame([("m", None), ("n", "week")], "statistic_id string, grain string") \
              .withColumn("start_at", F.lit(datetime(2024, 1, 1)))
    got = c.constraint_violations(df, c.statistic_rules()).collect()
    assert [(r.rule, r.row_key[:1]) for r in got] == [("grain", "n")]


def test_bad_number_is_an_error_unless_lenient(spark):
    table = spark.createDataFrame([('{"stress_high": 12.5, "day_summary": "x"}',)], "data string") \
                 .withColumn("day", F.lit("2024-01-01").cast("date"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        dv.device_view(table, "daily_stress").collect()
    row = dv.device_view(table, "daily_stress", lenient=True).first()
    assert row.stress_high_seconds is None and row.day_summary == "x"


def test_null_parent_is_tolerated(spark):
    rec = spark.createDataFrame([('{"id": "a", "day": "2024-01-01", "spo2_percentage": null}',)], "data string")
    assert dp.lift_fields(rec, "daily_spo2").first().spo2_percentage is None


def test_pages_unnest(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"data": [{"id": "a", "day": "2024-01-01", "x": {"y": [1, 2]}}, {"id": "b"}], "next_token": "t"}\n'
                                     '{"data": [], "next_token": null}\n{"next_token": null}\n')
    rows = dp.unnest_pages(dp.read_pages(spark, str(tmp_path)))
    assert sorted(r.id for r in dp.lift_fields(rows, "daily_sleep").collect()) == ["a", "b"]


def test_last_arrival_of_a_batch_wins(spark):
    target = spark.createDataFrame([("a", 1, datetime(2020, 1, 1)), ("z", 9, datetime(2020, 1, 1))], "id string, v int, synced_at timestamp")
    batch = spark.createDataFrame([("a", 2, 1), ("a", 3, 2), ("b", 4, 1)], "id string, v int, n int")
    out = merge.upsert_latest(target, batch, ["id"], ["n"], F.lit(datetime(2024, 1, 1)))
    assert {r.id: (r.v, r.synced_at.year) for r in out.collect()} == {"a": (3, 2024), "b": (4, 2024), "z": (9, 2020)}


def test_adhoc_guard_and_limit(spark):
    spark.range(9000).createOrReplaceTempView("numbers")
    assert dv.adhoc(spark, "SELECT * FROM numbers").count() == 500
    assert dv.adhoc(spark, " with n as (select * from numbers) select * from n", 99999).count() == 5000
    assert dv.adhoc(spark, "(SELECT 1)", 0).count() == 1
    for bad in ("DROP TABLE numbers", "INSERT INTO numbers VALUES (1)", ""):
        with pytest.raises(ValueError):
            dv.adhoc(spark, bad)


def test_adhoc_says_when_it_cut_rows(spark):
    spark.range(1000).createOrReplaceTempView("thousand")
    for limit, rows, cut in ((10, 10, True), (999, 999, True), (1000, 1000, False), (5000, 1000, False)):
        got = dv.adhoc(spark, "SELECT * FROM thousand", limit, mark="cut").collect()
        assert len(got) == rows and {r.cut for r in got} == {cut}


def test_periods_are_grouped_by_hash(spark, tmp_path):
    """Grouping that has to sort text holds a task's rows several times over."""
    from wattmirror.checks.catalog_checks import dirty_periods
    rows = [(1, 7, "O", datetime(2024, 1, 5), "2-HIGH"), (401, 7, "F", datetime(2024, 1, 5), "3-MEDIUM"), (3, 7, "P", datetime(2024, 2, 1), "1-URGENT"),
            (4, None, None, None, None)]
    spark.createDataFrame(rows, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp, o_orderpriority string") \
         .write.parquet(str(tmp_path / "orders.parquet"))
    out = dirty_periods(spark, str(tmp_path))
    assert "SortAggregate" not in out._jdf.queryExecution().executedPlan().toString()
    got = {tuple(r) for r in out.select(*[F.col(c).cast("string") for c in out.columns]).collect()}
    assert got == {("meter_7", "2024-01-05 00:00:00", "2024-01-06 00:00:00", "day"), ("meter_7", "0001-01-01 00:00:00", None, "minute"),
                   (None, None, None, "minute")}
