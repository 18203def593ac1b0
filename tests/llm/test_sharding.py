import zlib
from collections import Counter

from pyspark.sql import functions as F

from wattmirror.llm import sharding
from wattmirror.llm.queries import QUERIES


def check(rows, shards):
    counts = Counter(r["__shard"] for r in rows)
    assert not counts or max(counts.values()) - min([counts[s] for s in range(shards)]) <= 1
    for s in counts:
        assert sorted(r["__slot"] for r in rows if r["__shard"] == s) == list(range(counts[s]))


def test_odd_rows(docs_of, odd_rows, clashes, hidden):
    docs = docs_of(odd_rows, [*clashes, *hidden])
    out = sharding.external_shuffle(docs, shards=4)
    rows = out.collect()
    check(rows, 4)
    assert out.columns == [*[c for c in docs.columns if c != "__size"], *sharding.OWN]
    assert {r["a b.c"] for r in rows} == {"s"} and {r["__key"] for r in rows} == {2}
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(d) for d, *_ in odd_rows)
    assert {r["__size"] for r in rows if r.text is None} == {16}
    assert sharding.external_shuffle(docs.limit(0)).count() == 0


def test_law_for_many_sizes(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 13)
    for n in (1, 39, 40, 41, 500):
        df = spark.range(n).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same', string(id)) AS text")
        check(sharding.external_shuffle(df).collect(), 40)


def test_equal_rows_are_spread_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 100)
    monkeypatch.setattr(sharding, "CROWD", 50)
    monkeypatch.setattr(sharding, "PIECE", 7)
    # Two kinds of rows of one hash, which other columns tell apart, and plain ones.
    df = spark.range(3000).selectExpr("if(id < 1500, null, id) AS doc_id", "if(id < 1000, '', if(id < 1500, null, string(id))) AS text",
                                      "int(id < 700) AS more")
    out = sharding.external_shuffle(df, 5)
    rows = out.collect()
    check(rows, 5)
    key = lambda r: (r.doc_id, r.text, r.more)
    assert Counter(map(key, rows)) == Counter(map(key, df.collect()))
    common = sorted(r["__shard"] * 600 + r["__slot"] for r in rows if r.doc_id is None)
    assert all(80 <= sum(lo <= c < lo + 300 for c in common) <= 220 for lo in range(0, 3000, 300))
    again = {(key(r), r["__shard"], r["__slot"]) for r in sharding.external_shuffle(df.repartition(6), 5).collect()}
    assert again == {(key(r), r["__shard"], r["__slot"]) for r in rows}
    scattered = sharding._scattered(df.selectExpr("7L AS hash", "struct(doc_id, text, more) AS row", "1L AS size"), 3)
    assert scattered.groupBy("hash").count().agg(F.max("count")).first()[0] <= 5       # no hash holds a group of copies


def test_buckets_lie_in_the_partition_of_their_number(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 10)
    df = spark.range(800).selectExpr("id AS doc_id", "string(id) AS text")
    sizes = [r["count"] for r in sharding.external_shuffle(df, 4).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 20 and max(sizes) < 80


def test_reruns_agree_and_order_is_drawn(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 50)
    df = spark.range(600).selectExpr("id AS doc_id", "string(id % 7) AS text")

    def places(frame):
        return {r.doc_id: (r["__shard"], r["__slot"]) for r in sharding.external_shuffle(frame, 8).collect()}

    one = places(df)
    assert one == places(df.repartition(5)) == places(df.orderBy("text"))
    assert one != {r.doc_id: (r["__shard"], r["__slot"]) for r in sharding.external_shuffle(df, 8, seed=99).collect()}
    in_order = [i for i, _ in sorted(one.items(), key=lambda x: x[1])]
    rising = sum(a < b for a, b in zip(in_order, in_order[1:]))
    assert 200 < rising < 400
    by_shard = Counter((i // 75, s) for i, (s, _) in one.items())          # every shard has of everything
    assert max(by_shard.values()) < 30


def test_native_plan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = sharding.external_shuffle(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_written_shards(spark, tmp_path):
    df = spark.range(100).selectExpr("id AS doc_id", "string(id) AS text")
    sharding.write_shards(df, str(tmp_path / "out"), shards=6)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and back.select("shard").distinct().count() == 6


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op9_shard_shuffle"](spark, sf).collect()
    assert len(rows) == len(texts) and {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
    counts = Counter(r.shard for r in rows)
    assert set(counts.values()) == {5} and len(counts) == 40
