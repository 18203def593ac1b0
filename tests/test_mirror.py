import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from wattmirror.functions.values import values_equal
from wattmirror.operators import gating, merge, reconcile, runs
from wattmirror.plans import sync
from wattmirror.sources import statistics as src

T0 = datetime(2024, 3, 1)
FACTS = "statistic_id string, start_at timestamp, grain string, mean double, mean_weight double, min double, max double, " \
        "state double, sum double, last_reset_at timestamp"
PERIODS = "statistic_id string, valid_from timestamp, valid_until timestamp, grain string"
OPEN_PAST = datetime(1, 1, 1)


def stamps(spark, sid, hours):
    rows = [(sid, T0 + timedelta(hours=h)) for h in hours]
    return spark.createDataFrame(rows, "statistic_id string, start_at timestamp")


def decide(spark, stored, incoming, grain="hour", until=None, periods=True):
    table = spark.createDataFrame([("m", OPEN_PAST, until, grain)] if periods else [], PERIODS)
    got = gating.cadence_decision(stamps(spark, "m", stored), stamps(spark, "m", incoming), table).collect()
    assert len(got) == 1
    hold = None if got[0].hold_from is None else (got[0].hold_from - T0).total_seconds() / 3600
    return got[0].action, hold


@pytest.mark.parametrize("case, want", [
    (dict(stored=[0], incoming=[100, 200], periods=False), ("import_all", None)),
    (dict(stored=[0], incoming=[24, 48, 72], until=datetime(2030, 1, 1)), ("import_all", None)),
    (dict(stored=[0], incoming=[24, 48, 72], grain="billing_period"), ("import_all", None)),
    (dict(stored=[], incoming=[5]), ("import_all", None)),
    (dict(stored=[0, 24], incoming=[48, 72]), ("halt", None)),
    (dict(stored=[0, 1], incoming=[2, 3]), ("import_all", None)),
    (dict(stored=[0, 1, 2], incoming=[26]), ("import_all", None)),               # one daily gap proves nothing
    (dict(stored=[0, 1], incoming=[200, 201, 202]), ("import_all", None)),
    (dict(stored=[0, 1], incoming=[200, 224, 248]), ("halt", None)),
    (dict(stored=[0, 1], incoming=[200]), ("hold_tail", 200.0)),
    (dict(stored=[0, 1], incoming=[200, 224]), ("hold_tail", 200.0)),            # resuming one row per run
    (dict(stored=[0, 1], incoming=[200, 201, 225]), ("hold_tail", 200.0)),
    (dict(stored=[0, 1], incoming=[100, 300, 301]), ("hold_tail", 300.0)),       # the last outage counts
    (dict(stored=[0, 23], incoming=[46, 71], grain="day"), ("import_all", None)),  # 23 and 25 hours are days
])
def test_cadence_decision_table(spark, case, want):
    assert decide(spark, **case) == want


def test_only_four_stored_rows_are_looked_at(spark):
    assert decide(spark, stored=[0, 300, 301, 302, 303], incoming=[304]) == ("import_all", None)


@pytest.mark.parametrize("gap, want", [(1799, None), (1800, "hour"), (7200, "hour"), (7201, None), (43199, None),
                                       (43200, "day"), (172800, "day"), (172801, None)])
def test_cadence_bands(spark, gap, want):
    assert spark.range(1).select(gating.nearest_cadence(F.lit(float(gap))).alias("c")).first().c == want


def fact(sid, h, total, grain="hour"):
    return (sid, T0 + timedelta(hours=h), grain, None, None, None, None, 1.0, total, None)


def test_second_upsert_changes_nothing(spark):
    incoming = spark.createDataFrame([fact("m", h, float(h)) for h in range(20)] + [fact("m", 20, float("nan"))], FACTS)
    empty = spark.createDataFrame([], merge.FACT_SCHEMA)
    first, counts = merge.upsert_changed(empty, incoming, F.lit(T0))
    total = counts.where("statistic_id IS NULL").first()
    assert (total.rows_read, total.rows_inserted, total.rows_updated) == (21, 21, 0)
    second, counts = merge.upsert_changed(first, incoming, F.lit(T0 + timedelta(days=1)))
    total = counts.where("statistic_id IS NULL").first()
    assert (total.rows_inserted, total.rows_updated, total.rows_unchanged) == (0, 0, 21)
    assert second.where(F.col("synced_at") > F.lit(T0)).isEmpty()


def test_merge_into_path_is_idempotent_and_leaves_other_months(spark, tmp_path):
    path = str(tmp_path / "facts")
    old = spark.createDataFrame([fact("m", -24 * 40, 1.0), fact("m", 0, 2.0)], FACTS)
    merge.merge_into_path(path, old, F.lit(T0))
    new = spark.createDataFrame([fact("m", 0, 3.0), fact("m", 1, 4.0)], FACTS)
    for _ in range(2):
        merge.merge_into_path(path, new, F.lit(T0 + timedelta(days=1)))
    assert [r["sum"] for r in merge.read_months(spark, path).orderBy("start_at").collect()] == [1.0, 3.0, 4.0]
    labels = merge.merge_into_path(path, new, F.lit(T0)).groupBy("merge_label").count().collect()
    assert {r.merge_label: r["count"] for r in labels} == {"unchanged": 2}


def test_read_facts_prunes_months_and_rows(spark, tmp_path):
    path = str(tmp_path / "facts")
    merge.merge_into_path(path, spark.createDataFrame([fact("m", 24 * d, 1.0) for d in range(-60, 60)], FACTS), F.lit(T0))
    rows = merge.read_facts(spark, path, T0, T0 + timedelta(days=10))
    assert rows.count() == 10
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "(month" in plan.split("PartitionFilters")[1] and "GreaterThanOrEqual(start_at" in plan


# --- whole syncs ---------------------------------------------------------------------------------

NOW = T0 + timedelta(hours=100)


def source(spark, rows):
    meta = spark.createDataFrame([(1, "m"), (2, "n")], "id bigint, statistic_id string")
    epoch = lambda h: (T0 + timedelta(hours=h) - datetime(1970, 1, 1)).total_seconds()
    stats = spark.createDataFrame(
        [(k, epoch(h), None, None, None, None, 1.0, total, None) for k, h, total in rows],
        "metadata_id bigint, start_ts double, mean double, mean_weight double, min double, max double, state double, "
        "sum double, last_reset_ts double")
    return stats, meta


def contract(spark):
    catalog = spark.createDataFrame([("m", "hour", False), ("n", "hour", False), ("gone", "hour", False)],
                                    "statistic_id string, default_grain string, grain_review_required boolean")
    periods = spark.createDataFrame([("n", OPEN_PAST, None, "hour")], PERIODS)
    marks = spark.createDataFrame([], "statistic_id string, source_max_ts timestamp, observed_at timestamp")
    return catalog, periods, marks


def test_backfill_then_incremental(spark):
    rows = [(1, h, float(h)) for h in range(0, 99)] + [(2, h, 2.0 * h) for h in range(0, 99)]
    catalog, periods, marks = contract(spark)
    empty = spark.createDataFrame([], merge.FACT_SCHEMA)
    done = sync.backfill(*source(spark, rows), empty, catalog, periods, marks, NOW)
    assert done.problems.isEmpty()
    assert not spark.range(1).select(sync.run_failed(done).alias("f")).first().f
    assert {r.statistic_id: r.source_max_ts for r in done.watermarks.collect()} == {
        "m": T0 + timedelta(hours=98), "n": T0 + timedelta(hours=98)}

    mirror = src.pin_source(done.mirror)
    revised = [(k, h, total + (1.0 if (k, h) == (1, 90) else 0.0)) for k, h, total in rows] + [(1, 99, 99.0)]
    step = sync.incremental(*source(spark, revised), mirror, catalog, periods, done.watermarks, NOW)
    total = step.counts.where("statistic_id IS NULL").first()
    assert (total.rows_inserted, total.rows_updated) == (1, 1)
    assert total.rows_read == 72 + 71
    again = sync.incremental(*source(spark, revised), src.pin_source(step.mirror), catalog, periods, step.watermarks, NOW)
    total = again.counts.where("statistic_id IS NULL").first()
    assert (total.rows_inserted, total.rows_updated) == (0, 0)


def test_stored_sync_touches_its_months_and_checks_what_it_wrote(spark, tmp_path):
    path = str(tmp_path / "facts")
    rows = [(k, h, float(h)) for k in (1, 2) for h in range(-1500, 99)]
    catalog, periods, marks = contract(spark)
    done = sync.store_backfill(path, *source(spark, rows), catalog, periods, marks, NOW)
    assert done.problems.isEmpty() and merge.read_facts(spark, path).count() == len(rows)
    files = lambda month: sorted(f.name for f in (tmp_path / "facts" / f"month={month}").iterdir())
    before = files("2024-01"), files("2024-03")

    revised = [(k, h, total + (1.0 if (k, h) == (1, 90) else 0.0)) for k, h, total in rows] + [(1, 99, 99.0)]
    step = sync.store_incremental(path, *source(spark, revised), catalog, periods, done.watermarks, NOW)
    total = step.counts.where("statistic_id IS NULL").first()
    assert (total.rows_inserted, total.rows_updated) == (1, 1)
    assert files("2024-01") == before[0] and files("2024-03") != before[1]
    assert sync.verify_stored(path, *source(spark, revised), catalog, periods).isEmpty()
    marks = sync.read_beside(spark, path, "watermarks", done.watermarks.schema.simpleString()[7:-1].replace(":", " "))
    assert sorted(marks.collect()) == sorted(step.watermarks.collect())
    run = sync.read_beside(spark, path, "counts", "statistic_id string, rows_inserted bigint, rows_updated bigint, finished_at timestamp")
    assert [tuple(r)[1:] for r in run.where("statistic_id IS NULL").collect()] == [(1, 1, NOW)]

    bad = src.pin_source(merge.read_facts(spark, path).withColumn(
        "sum", F.when((F.col("statistic_id") == "n") & (F.col("sum") == 7), 7.5).otherwise(F.col("sum"))))
    merge.write_months(bad, path)
    found = sync.verify_stored(path, *source(spark, revised), catalog, periods).collect()
    assert [(r.statistic_id, r.at, r.kind) for r in found] == [("n", T0 + timedelta(hours=7), "sum")]


def test_the_gate_finds_old_stamps_of_a_sparse_metric(spark, tmp_path):
    path = str(tmp_path / "facts")
    old = [fact("n", h, 1.0) for h in (-4000, -3999, -3998, -3997, -3996)] + [fact("m", h, 1.0) for h in range(-4000, 0, 100)]
    merge.write_months(spark.createDataFrame(old, FACTS).withColumn("synced_at", F.lit(NOW)), path)
    stamps_of = lambda rows, sid: {r.start_at for r in rows.where(F.col("statistic_id") == sid).collect()}
    periods = spark.createDataFrame([(k, OPEN_PAST, None, "hour") for k in "mn"], PERIODS)
    got = sync.newest_stored(spark, path, periods, T0 - timedelta(days=62))
    assert len(stamps_of(got, "n")) == 5 and min(stamps_of(got, "m")) >= T0 - timedelta(days=62)


def test_merges_carry_the_newest_stamps_and_the_gate_reads_nothing_else(spark, tmp_path, monkeypatch):
    path, rng = str(tmp_path / "facts"), random.Random(2)
    held = set()
    for step in range(4):
        came = {(rng.choice("mno"), rng.randrange(-900, 90)) for _ in range(12)}
        merge.merge_into_path(path, spark.createDataFrame([fact(k, h, float(step)) for k, h in came], FACTS), F.lit(T0))
        held |= came
        want = sorted((k, T0 + timedelta(hours=h)) for k in "mno" for h in sorted(x for j, x in held if j == k)[-4:])
        assert sorted(tuple(r) for r in merge.stored_stamps(spark, path).collect()) == want
        if step == 1:                       # months replaced behind it: made anew by the next merge
            merge.write_months(src.pin_source(merge.read_facts(spark, path)), path)
            assert merge.stored_stamps(spark, path) is None

    folder = lambda: merge.monthly.current(spark, path).tables[merge.STAMPS]
    before = folder()                       # a late row that is older than the newest four changes no stamps
    merge.merge_into_path(path, spark.createDataFrame([fact("m", -2000, 1.0)], FACTS), F.lit(T0))
    assert folder() == before

    path = str(tmp_path / "synced")
    rows = [(k, h, float(h)) for k in (1, 2) for h in range(0, 90)]
    catalog, periods, marks = contract(spark)
    done = sync.store_backfill(path, *source(spark, rows), catalog, periods, marks, NOW)
    monkeypatch.setattr(sync, "newest_stored", lambda *a: pytest.fail("facts were read"))
    later = [*rows, (2, 90 + 24, 1.0), (2, 90 + 48, 1.0), (2, 90 + 72, 1.0)]
    step = sync.store_repair(path, *source(spark, later), catalog, periods, done.watermarks, NOW, T0 + timedelta(hours=95))
    plain = sync.repair(*source(spark, later), src.pin_source(done.mirror), catalog, periods, done.watermarks, NOW, T0 + timedelta(hours=95))
    assert sorted(map(str, step.decisions.collect())) == sorted(map(str, plain.decisions.collect()))
    assert {r.action for r in step.decisions.collect()} == {"halt"}


def test_halted_metric_imports_nothing_and_fails_the_run(spark):
    rows = [(1, 95, 1.0), (2, 48, 1.0), (2, 72, 2.0), (2, 96, 3.0)]
    catalog, periods, marks = contract(spark)
    step = sync.incremental(*source(spark, rows), spark.createDataFrame([], merge.FACT_SCHEMA), catalog, periods, marks, NOW)
    assert [r.statistic_id for r in step.mirror.collect()] == ["m"]
    assert step.catalog.where("grain_review_required").first().statistic_id == "n"
    assert spark.range(1).select(sync.run_failed(step).alias("f")).first().f
    assert gating.halt_summary(step.decisions).first().summary.startswith("n: grain hour is configured")


def test_row_in_no_period_is_an_error(spark):
    catalog, _, marks = contract(spark)
    late = spark.createDataFrame([("n", T0 + timedelta(days=300), None, "hour")], PERIODS)
    with pytest.raises(ValueError, match="no reviewed grain period"):
        sync.backfill(*source(spark, [(2, 1, 1.0)]), spark.createDataFrame([], merge.FACT_SCHEMA), catalog, late, marks, NOW)


def test_one_corrupt_cell_is_one_problem(spark):
    clean = spark.createDataFrame([fact("m", h, float(h)) for h in range(50)], FACTS)
    bad = clean.withColumn("sum", F.when(F.col("sum") == 7, 7.5).otherwise(F.col("sum")))
    assert reconcile.reconcile(clean, clean).isEmpty()
    got = reconcile.reconcile(clean, bad).collect()
    assert [(r.kind, r.source_value, r.mirror_value) for r in got] == [("sum", "7.0", "7.5")]


def test_a_damaged_cell_makes_one_part_differ(spark, tmp_path):
    hours = range(0, 24 * 730, 24)                                  # 24 months, two metrics
    clean = spark.createDataFrame([fact(k, h, float(h)) for k in "mn" for h in hours], FACTS)
    hit = (F.col("statistic_id") == "n") & (F.col("sum") == 24.0 * 400)
    bad = clean.withColumn("sum", F.when(hit, -1.0).otherwise(F.col("sum")))
    merge.write_months(clean.withColumn("synced_at", F.lit(NOW)), str(tmp_path / "facts"))
    stored = merge.read_facts(spark, str(tmp_path / "facts"))
    assert reconcile.differing_parts(clean.repartition(7), stored).isEmpty()
    parts = reconcile.differing_parts(bad, stored)
    month = T0 + timedelta(hours=24 * 400)
    assert [tuple(r) for r in parts.collect()] == [("n", month.year * 12 + month.month - 1)]
    months = reconcile.months_of(parts)
    again = reconcile.rows_of(stored, parts, months)
    assert {(r.statistic_id, r.start_at.month) for r in again.collect()} == {("n", month.month)} and again.count() <= 31
    assert "GreaterThanOrEqual(start_at" in again._jdf.queryExecution().executedPlan().toString()
    got = reconcile.reconcile(bad, stored).collect()
    assert [(r.statistic_id, r.kind, r.source_value, r.mirror_value) for r in got] == [("n", "sum", "-1.0", "9600.0")]


def test_digests_see_nulls_repeats_and_rows_without_a_time(spark):
    row = lambda low, high, at=T0: ("m", at, "hour", None, None, low, high, None, None, None)
    of = lambda *rows: spark.createDataFrame(list(rows), FACTS)
    digest = lambda df: sorted(map(tuple, reconcile.digests(df).collect()))
    assert digest(of(row(1.0, None))) != digest(of(row(None, 1.0)))
    one, two, three = row(1.0, 1.0), row(2.0, 2.0), row(3.0, 3.0)
    assert digest(of(one, two, two)) != digest(of(one, three, three))
    assert digest(of(one, two)) == digest(of(two, one)) and digest(of(row(-0.0, float("nan")))) == digest(of(row(0.0, float("nan"))))
    assert digest(of().limit(0)) == [] and reconcile.reconcile(of(one), of(one).limit(0)).first().kind == "missing_from_mirror"
    lost = row(1.0, 1.0, None)
    assert reconcile.reconcile(of(one, lost), of(one)).first().kind == "missing_from_mirror"
    near = row(1.0 + 1e-12, 1.0)
    assert reconcile.differing_parts(of(one), of(near)).count() == 1 and reconcile.reconcile(of(one), of(near)).isEmpty()


def test_digest_first_reports_what_comparing_all_rows_does(spark):
    rows = [(k, T0 + timedelta(hours=7 * h), "hour", None, 1.0, float(h % 5), None, 1.0, float(h), None) for k in "mno" for h in range(400)]
    a = spark.createDataFrame(rows, FACTS)
    b = a.where("statistic_id <> 'o' OR sum < 300").withColumn("min", F.when(F.col("sum") % 97 == 5, None).otherwise(F.col("min")))
    b = b.withColumn("grain", F.when((F.col("sum") == 201) & (F.col("statistic_id") == "m"), "day").otherwise(F.col("grain")))
    for x, y in ((a, b), (b, a)):
        assert sorted(map(str, reconcile.reconcile(x, y).collect())) == sorted(map(str, reconcile.differences(x, y).collect()))


def test_rows_above_the_watermark_are_out_of_scope_on_both_sides(spark):
    a = spark.createDataFrame([fact("m", h, float(h)) for h in range(10)], FACTS)
    b = spark.createDataFrame([fact("m", h, float(h)) for h in range(6)] + [fact("m", 40, 1.0)], FACTS)
    marks = spark.createDataFrame([("m", T0 + timedelta(hours=5), T0)],
                                  "statistic_id string, source_max_ts timestamp, observed_at timestamp")
    assert reconcile.reconcile(a, b, marks).isEmpty()
    assert reconcile.reconcile(a, b).count() == 5


@pytest.mark.parametrize("a, b, want", [
    (None, None, True), (None, 1.0, False), (float("nan"), float("nan"), True), (float("nan"), 1.0, False),
    (float("inf"), float("inf"), True), (float("inf"), float("-inf"), False), (float("inf"), 1e308, False),
    (1.0, 1.0 + 1e-10, True), (1.0, 1.0 + 1e-8, False), (1e12, 1e12 + 100, True), (0.0, 1e-10, True)])
def test_values_equal(spark, a, b, want):
    lit = lambda x: F.lit(x).cast("double")
    assert spark.range(1).select(values_equal(lit(a), lit(b)).alias("s")).first().s is want


def test_missing_column_fails(spark):
    stats, meta = source(spark, [(1, 0, 1.0)])
    with pytest.raises(ValueError, match="last_reset_ts"):
        src.scan_statistics(stats.drop("last_reset_ts"), meta)


def test_scan_bounds_reach_the_file(spark, tmp_path):
    stats, meta = source(spark, [(1, h, 1.0) for h in range(5)])
    stats.write.parquet(str(tmp_path / "s"))
    scan = src.scan_statistics(spark.read.parquet(str(tmp_path / "s")), meta, 0.0, 10.0)
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(start_ts,0.0)" in plan and "LessThan(start_ts,10.0)" in plan


def test_empty_repair_is_an_error():
    with pytest.raises(ValueError):
        runs.repair_window(T0, T0)
    assert runs.repair_window(T0) == (T0, None)


def test_health_threshold_is_strict(spark):
    catalog, _, _ = contract(spark)
    log = spark.createDataFrame([("success", "incremental", T0), ("success", "backfill", T0 + timedelta(days=9))],
                                "status string, mode string, finished_at timestamp")
    at = lambda h: runs.health(log, catalog, F.lit(T0 + timedelta(hours=h))).first()
    assert at(3).healthy and not at(3.01).healthy
    never = runs.health(log.where("mode = 'backfill'"), catalog, F.lit(T0)).first()
    assert list(never.problems) == ["no incremental run has ever succeeded"]


def test_next_window(spark):
    log = spark.createDataFrame([("a", "success", date(2024, 3, 1)), ("a", "failed", date(2024, 3, 4)),
                                 ("b", "success", date(2024, 3, 5))], "endpoint string, status string, window_end date")
    ends = spark.createDataFrame([("a",), ("b",), ("c",)], "endpoint string")
    got = {r.endpoint: r.window_start for r in runs.next_window(log, ends, date(2024, 3, 5)).collect()}
    assert got == {"a": date(2024, 3, 1), "c": date(2024, 3, 5) - timedelta(days=90)}
    full = runs.next_window(log, ends, date(2024, 3, 5), full_backfill=True).collect()
    assert {r.window_start for r in full} == {date(2015, 1, 1)} and len(full) == 3
