import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wattmirror.plans.composed import interval_starts, state_runs
from wattmirror.plans.ordered import ROWS_CONF, SPAN, STRETCH, ordered_scan, span_of, spanned


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows belong to one key, many of them in one burst, some at equal times."""
    rng = random.Random(7)
    data = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}"
        at = 1_000_000 + (rng.randrange(30) if rng.random() < 0.5 else rng.randrange(100_000))
        data.append((key, at, i, rng.choice([None, rng.randrange(1000)]), rng.randrange(50)))
    return spark.createDataFrame(data, "k string, s bigint, no bigint, v bigint, w bigint") \
                .withColumn("ts", F.timestamp_seconds("s"))


def plain(rows):
    w = Window.partitionBy("k").orderBy("ts", "no")
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumns({
        "p": F.lag("v").over(w), "f": F.lead("v").over(w), "l": F.last("v", True).over(upto),
        "h": F.max("v").over(before), "t": F.sum("w").over(upto)})


ALL = {"previous": {"p": "v"}, "following": {"f": "v"}, "known": {"l": "v"}, "highest": {"h": "v"}, "total": {"t": "w"}}


def same(got, want, order):
    return got.select(want.columns).orderBy(order).collect() == want.orderBy(order).collect()


@pytest.mark.parametrize("width", [0.5, 3, 1000, 10 ** 9])
def test_scan_equals_plain_window(rows, width):
    got = ordered_scan(rows, ["k"], "ts", ["no"], width=width, **ALL)
    assert same(got, plain(rows), ["k", "ts", "no"])


def test_many_spans_of_one_key_hold_few_rows_each(rows):
    spread = rows.withColumn("ts", F.timestamp_seconds(F.col("no")))
    sizes = spread.withColumn("s", span_of(spread, "ts", 30)).where("k = 'hot'").groupBy("s").count().collect()
    assert len(sizes) == 30 and max(r["count"] for r in sizes) == 10
    assert same(ordered_scan(spread, ["k"], "ts", ["no"], width=30, **ALL), plain(spread), ["k", "ts", "no"])


def test_one_moment_holding_all_rows(rows):
    flat = rows.withColumn("ts", F.timestamp_seconds(F.lit(5)))
    assert same(ordered_scan(flat, ["k"], "ts", ["no"], width=1, **ALL), plain(flat), ["k", "no"])


def test_spans_rise_with_the_order_also_before_the_epoch(spark):
    df = spark.createDataFrame([(x,) for x in (-8_000_000_000, -3601, -3600, -1, 0, 1, 3599, 3600)], "s bigint") \
        .withColumn("ts", F.timestamp_seconds("s"))
    spans = [r[0] for r in df.orderBy("s").select(span_of(df, "ts")).collect()]
    assert spans == sorted(spans) and spans[1:] == [-2, -1, -1, 0, 0, 0, 1]


def test_rows_without_a_time_come_first(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", 9000, 3)], "k string, s bigint, v bigint") \
        .withColumn("ts", F.timestamp_seconds("s"))
    got = ordered_scan(df, ["k"], "ts", ["v"], previous={"p": "v"}).orderBy("v").collect()
    assert [r.p for r in got] == [None, 1, 2]


def test_integer_order_column(rows):
    got = ordered_scan(rows, ["k"], "no", width=10, total={"t": "w"})
    want = rows.withColumn("t", F.sum("w").over(Window.partitionBy("k").orderBy("no")))
    assert same(got, want, ["k", "no"])


def test_building_a_scan_runs_nothing_and_hints_no_broadcast(spark, rows):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    scan = ordered_scan(rows, ["k"], "ts", ["no"], **ALL)
    assert not tracker.getJobIdsForGroup("building")
    assert "Hint" not in scan._jdf.queryExecution().analyzed().toString() and SPAN not in scan.columns


@pytest.fixture
def few_rows(spark):
    """Cut a key's span above five rows."""
    spark.conf.set(ROWS_CONF, "5")
    yield
    spark.conf.unset(ROWS_CONF)


@pytest.mark.parametrize("width", [None, 3, 1000])
def test_scan_over_crowded_spans_equals_plain_window(rows, few_rows, width):
    assert same(ordered_scan(rows, ["k"], "ts", ["no"], width=width, **ALL), plain(rows), ["k", "ts", "no"])
    flat = rows.withColumn("ts", F.timestamp_seconds(F.lit(5)))
    assert same(ordered_scan(flat, ["k"], "ts", ["no"], width=width, **ALL), plain(flat), ["k", "no"])
    got = ordered_scan(rows, ["k"], "no", total={"t": "w"}, width=width)
    want = rows.withColumn("t", F.sum("w").over(Window.partitionBy("k").orderBy("no")))
    assert same(got, want, ["k", "no"])


def test_sparse_numbers_are_bundled(spark, few_rows):
    """However far apart the values are: at most one span, and one more per five rows of a key."""
    df = spark.range(600).selectExpr("IF(id % 3 = 0, 'hot', concat('k', id % 100)) AS k", "id * 1000000007 AS no", "id AS w")
    spans = spanned(df, ["k"], "no").groupBy("k", SPAN, STRETCH).count()
    sizes = df.groupBy("k").count().withColumnRenamed("count", "n")
    for r in spans.groupBy("k").agg(F.count("*").alias("spans"), F.max("count").alias("most")).join(sizes, "k").collect():
        assert r["spans"] <= -(-r["n"] // 5) and r["most"] <= 6
    want = df.withColumn("t", F.sum("w").over(Window.partitionBy("k").orderBy("no")))
    assert same(ordered_scan(df, ["k"], "no", total={"t": "w"}), want, ["k", "no"])


def test_a_million_rows_at_one_moment_are_cut_by_their_ties(spark):
    spark.conf.set(ROWS_CONF, "50000")
    try:
        df = spark.range(1_000_000).selectExpr("'hot' AS k", "timestamp_seconds(5) AS ts", "id * 3 AS no", "id % 7 AS w")
        sizes = spanned(df, ["k"], "ts", ["no"]).groupBy(SPAN, STRETCH).count().collect()
        assert len(sizes) == 20 and max(r["count"] for r in sizes) <= 51_000
        got = ordered_scan(df, ["k"], "ts", ["no"], previous={"p": "w"}, total={"t": "w"})
        ids = "id % 7 AS w, (id - 1) % 7 AS p, (id div 7) * 21 + (id % 7) * (id % 7 + 1) div 2 AS t".split(", ", 2)
        want = spark.range(1_000_000).selectExpr("id * 3 AS no", ids[0], "IF(id > 0, (id - 1) % 7, NULL) AS p", ids[2])
        assert got.select("no", "w", "p", "t").exceptAll(want).count() == 0 and got.count() == 1_000_000
    finally:
        spark.conf.unset(ROWS_CONF)


def plain_runs(rows, value):
    w = Window.partitionBy("k").orderBy("ts", "no")
    changed = rows.withColumn("was", F.lag(value).over(w)).where(~F.col(value).eqNullSafe(F.col("was")))
    return changed.withColumn("until", F.lead("ts").over(w)).withColumn("since", F.lag("ts").over(w))


@pytest.mark.parametrize("cut", [None, "1", "2", "5", "40"])
def test_composed_scans_equal_chained_plain_windows(spark, rows, cut):
    """Runs of states, and the intervals they make, over spans of any size."""
    states = rows.withColumn("st", F.when(F.col("w") % 5 == 0, None).otherwise(F.col("w") % 3))
    if cut:
        spark.conf.set(ROWS_CONF, cut)
    try:
        runs = state_runs(states, ["k"], "ts", ["no"], "st", "was", changed_at="until", since="since")
        want = plain_runs(states, "st")
        assert same(runs, want, ["k", "ts", "no"])
        held = runs.where("st = 1").withColumn("ends", F.least("until", F.col("ts") + F.expr("INTERVAL 300 SECONDS")))
        got = interval_starts(held, ["k"], "ts", ["no"], "ends", "starts")
        w = Window.partitionBy("k").orderBy("ts", "no")
        plain_held = want.where("st = 1").withColumn("ends", F.least("until", F.col("ts") + F.expr("INTERVAL 300 SECONDS")))
        reach = plain_held.withColumn("reach", F.max("ends").over(w.rowsBetween(Window.unboundedPreceding, -1)))
        fresh = F.when(F.col("reach").isNull() | (F.col("ts") > F.col("reach")), F.col("ts"))
        islands = reach.withColumn("starts", F.last(fresh, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        assert same(got, islands.drop("reach"), ["k", "ts", "no"])
    finally:
        spark.conf.unset(ROWS_CONF)
