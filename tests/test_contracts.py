"""Merges that die half-way, repeated keys, overlapping periods."""

import shutil
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wattmirror.operators import gating, merge
from wattmirror.plans import monthly, pinned
from wattmirror.sources import statistics as src

COLUMNS = ("statistic_id string, start_at timestamp, grain string, mean double, mean_weight double, min double, "
           "max double, state double, sum double, last_reset_at timestamp")


def now():
    return F.lit(datetime(2024, 5, 1))


def facts(spark, rows):
    return spark.createDataFrame([(k, t, "hour", None, None, None, None, None, v, None) for k, t, v in rows], COLUMNS)


def stored(spark, path):
    return sorted((r.statistic_id, r.start_at, r.sum) for r in merge.read_facts(spark, path).collect())


JAN, FEB, MAR = datetime(2024, 1, 5), datetime(2024, 2, 5), datetime(2024, 3, 5)


STEPS = ["write_rows", "write_table", "months_of", "commit", "compact"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("done_before", [False, True])
def test_a_merge_that_dies_at_any_step_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch, step, done_before):
    """The job dies before or right after each of its steps; readers see the old rows or the new ones, and a rerun ends well."""
    path = str(tmp_path / "facts")
    old, new = [("a", JAN, 1.0), ("a", FEB, 2.0), ("b", FEB, 3.0)], [("a", FEB, 9.0), ("c", MAR, 4.0)]
    merge.merge_into_path(path, facts(spark, old), now())
    both = [("a", JAN, 1.0), ("a", FEB, 9.0), ("b", FEB, 3.0), ("c", MAR, 4.0)]
    beside = lambda labelled: {"marks": labelled.groupBy("statistic_id").agg(F.max("start_at").alias("at"))}
    reader = merge.read_facts(spark, path)
    real = getattr(monthly, step)

    def dies(*args, **named):
        if done_before:
            real(*args, **named)
        raise RuntimeError("executor and driver lost")

    with monkeypatch.context() as broken, pytest.raises(RuntimeError):
        broken.setattr(monthly, step, dies)
        merge.merge_into_path(path, facts(spark, new), now(), most_changes=0, beside=beside)
    switched = step == "compact" or (step == "commit" and done_before)
    marks = monthly.read_table(spark, path, "marks", "statistic_id string, at timestamp")
    assert stored(spark, path) == (both if switched else old) and marks.count() == (2 if switched else 0)
    assert sorted((r.statistic_id, r.start_at, r.sum) for r in reader.collect()) == old
    merge.merge_into_path(path, facts(spark, new), now(), most_changes=0, beside=beside)
    assert stored(spark, path) == both
    monthly.vacuum(spark, path, keep=1)
    assert stored(spark, path) == both


def test_a_reader_between_write_and_switch_sees_the_old_month_whole(spark, tmp_path, monkeypatch):
    path, seen = str(tmp_path / "facts"), []
    merge.merge_into_path(path, facts(spark, [("a", FEB, 2.0), ("b", FEB, 3.0)]), now())
    real = monthly.commit
    monkeypatch.setattr(monthly, "commit", lambda *a, **k: (seen.append(stored(spark, path)), real(*a, **k))[1])
    merge.merge_into_path(path, facts(spark, [("a", FEB, 9.0)]), now(), most_changes=0)
    assert seen[0] == [("a", FEB, 2.0), ("b", FEB, 3.0)]
    assert seen[1:] == [[("a", FEB, 9.0), ("b", FEB, 3.0)]] and stored(spark, path) == seen[1]       # before and after compaction


def test_one_late_row_writes_one_small_file(spark, tmp_path):
    path = str(tmp_path / "facts")
    merge.merge_into_path(path, facts(spark, [(f"m{i}", JAN, 1.0) for i in range(500)]), now())
    before = set((tmp_path / "facts").rglob("*.parquet"))
    merge.merge_into_path(path, facts(spark, [("m7", JAN, 2.0), ("m8", JAN, 1.0)]), now())
    added = set((tmp_path / "facts").rglob("*.parquet")) - before
    assert len(added) == 1 and spark.read.parquet(str(added.pop())).count() == 1 and before
    assert dict((r[0], r[2]) for r in stored(spark, path))["m7"] == 2.0 and len(stored(spark, path)) == 500
    merge.merge_into_path(path, facts(spark, [("m7", JAN, 2.0)]), now())                              # unchanged: nothing at all
    assert len(set((tmp_path / "facts").rglob("*.parquet"))) == len(before) + 1


def test_changes_pile_up_to_the_bound_then_the_month_is_whole_again(spark, tmp_path):
    path = str(tmp_path / "facts")
    for i in range(6):
        merge.merge_into_path(path, facts(spark, [("a", JAN, float(i)), ("b", FEB, 1.0)]), now(), most_changes=3)
    held = monthly.current(spark, path)
    assert {m: len(f) for m, f in held.months.items()} == {"2024-01": 2, "2024-02": 1}
    assert stored(spark, path) == [("a", JAN, 5.0), ("b", FEB, 1.0)]
    assert monthly.compact(spark, path, merge.FACT_SCHEMA, merge.FACT_KEY) == ["2024-01"]
    # six merges and two compactions wrote eight folders for January, one of which counts
    assert monthly.vacuum(spark, path, keep=1) == 7 and stored(spark, path) == [("a", JAN, 5.0), ("b", FEB, 1.0)]


def test_a_second_writer_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "facts")
    merge.merge_into_path(path, facts(spark, [("a", JAN, 1.0)]), now())
    held = monthly.current(spark, path)
    merge.merge_into_path(path, facts(spark, [("a", JAN, 2.0)]), now())
    with pytest.raises(monthly.Conflict):
        monthly.commit(spark, path, held, {"2024-01": ["x"]})
    assert stored(spark, path) == [("a", JAN, 2.0)]


def test_nothing_hangs_on_the_work_folder(spark, tmp_path, monkeypatch):
    path, work = str(tmp_path / "facts"), tmp_path / "expires"
    with monkeypatch.context() as other:
        other.setattr(pinned, "work_dir", lambda spark: str(work))
        merge.merge_into_path(path, facts(spark, [("a", JAN, 1.0), ("b", FEB, 1.0)]), now())
        merge.merge_into_path(path, facts(spark, [("a", JAN, 2.0)]), now())
    shutil.rmtree(work)
    merge.merge_into_path(path, facts(spark, [("b", FEB, 5.0)]), now())
    assert stored(spark, path) == [("a", JAN, 2.0), ("b", FEB, 5.0)]


def test_repeated_keys_are_rejected_before_a_merge(spark, tmp_path):
    rows = facts(spark, [("b", JAN, 1.0), ("a", FEB, 1.0), ("a", FEB, 2.0)])
    with pytest.raises(ValueError, match="^a, 2024-02-05 00:00:00 comes 2 times"):
        src.assert_unique(rows)
    with pytest.raises(ValueError):
        merge.merge_into_path(str(tmp_path / "facts"), rows, now())
    assert stored(spark, str(tmp_path / "facts")) == []


def test_overlapping_periods_are_rejected(spark):
    schema = "statistic_id string, valid_from timestamp, valid_until timestamp, grain string"
    good = spark.createDataFrame([("a", JAN, FEB, "hour"), ("a", FEB, None, "day")], schema)
    assert gating.assert_disjoint(good) is good
    bad = spark.createDataFrame([("a", JAN, MAR, "hour"), ("a", FEB, None, "day")], schema)
    with pytest.raises(ValueError, match="^a has reviewed periods that overlap from 2024-02-05"):
        gating.assert_disjoint(bad)
