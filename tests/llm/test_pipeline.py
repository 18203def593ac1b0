import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wattmirror.llm import pii, simhash, toxicity
from wattmirror.llm.common import read

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    folder, out = tmp_path_factory.mktemp("stages"), [read(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        path = str(folder / name)
        stage(spark, out[-1], SF).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_stages_keep_the_columns(staged):
    for df in staged[1:-1]:
        assert df.dtypes == staged[0].dtypes


def test_toxic_documents_go_and_clean_ones_stay(spark, staged):
    labels = read(spark, SF, "labels")
    kept = staged[1].join(labels, "doc_id").groupBy("toxic").count().collect()
    before = {r.toxic: r["count"] for r in staged[0].join(labels, "doc_id").groupBy("toxic").count().collect()}
    after = {r.toxic: r["count"] for r in kept}
    assert after[0] >= 0.99 * before[0] and after[1] <= 0.5 * before[1]
    model = toxicity.train(staged[0], labels.where("crc32(cast(cast(doc_id AS string) AS binary)) % 5 != 0"))
    scores = toxicity.score(staged[0], model, ["doc_id"]).where("predicted = 0")
    assert sorted(r.doc_id for r in scores.collect()) == sorted(r.doc_id for r in staged[1].select("doc_id").collect())


def test_one_document_of_each_class_stays(staged):
    classes = simhash.near_duplicates(staged[1]).groupBy("root").agg(F.min("doc_id").alias("doc_id")).collect()
    assert sorted(r.doc_id for r in classes) == sorted(r.doc_id for r in staged[2].select("doc_id").collect())


def test_personal_data_is_masked(staged):
    before = {r.doc_id: r.text for r in staged[2].collect()}
    masked = 0
    for r in staged[3].collect():
        assert not pii.base_spans(r.text) and r.n_chars == len(r.text)
        if not pii.base_spans(before[r.doc_id]):
            assert r.text == before[r.doc_id] or "[" in r.text
        masked += r.text != before[r.doc_id]
    assert masked


def test_mix_meets_its_targets(staged):
    from test_mixing import WORD, plain_targets
    sizes, taken = Counter(), Counter()
    for counter, df in ((sizes, staged[3]), (taken, staged[4])):
        for r in df.collect():
            counter[r.source] += len(WORD.findall(r.text or ""))
    want = plain_targets(sizes)
    assert all(taken[s] == pytest.approx(want[s], abs=1) for s in want)


def test_packing_holds_every_row_of_the_mix(staged):
    import numpy as np
    rows = staged[5].collect()
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32
    for own in by_sequence.values():
        assert [o for o, _ in sorted(own)] == [sum(n for _, n in sorted(own)[:i]) for i in range(len(own))]
        assert sum(n for _, n in own) <= 1024
    first = Counter(r.doc_id for r in rows if r.piece == 0)
    assert first == Counter(r.doc_id for r in staged[4].select("doc_id").collect())


def test_run_gives_the_rows_of_the_stages(spark, staged):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == staged[5].columns
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(str, got.select(key).collect())) == sorted(map(str, staged[5].select(key).collect()))


def test_odd_rows_go_through(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() > 0
    empty = docs_of(odd_rows).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_columns_with_clashing_names_pass(spark, docs_of, odd_rows, clashes, hidden):
    """Every stage gives the rows it gives without them, and their values stay with their documents."""
    plain, extra = docs_of(odd_rows), docs_of(odd_rows, [*clashes, *hidden])
    kept = extra.columns
    values = [c for c in kept if c not in plain.columns]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        plain, extra = stage(spark, plain, SF), stage(spark, extra, SF)
        assert extra.columns == kept
        rows = extra.collect()
        assert sorted(str(tuple(r)[:5]) for r in rows) == sorted(str(tuple(r)) for r in plain.collect())
        assert len({tuple(r)[5:] for r in rows}) == 1 and len(values) == len(kept) - 5
    assert corpus_pipeline.STAGES[-1][1](spark, extra, SF).count() == corpus_pipeline.STAGES[-1][1](spark, plain, SF).count()
