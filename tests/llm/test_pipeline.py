import pyarrow as pa

import corpus_pipeline
from tidemark.llm import common
from tidemark.llm.common import written


def test_stages_keep_columns_and_take_effect(spark, docs, base):
    """Each stage on what the one before kept, with awkward documents."""
    benchmark = next(r.text for r in docs.collect() if r.text and 51 < len(r.text.split()) < 90)
    spark.createDataFrame([(1, benchmark)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    left = docs
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        left = written(stage(spark, left, base), name)
        counts.append(left.count())
        if name == "benchmark":
            assert benchmark not in {r.text for r in left.collect()}
        if name == "personal-data":
            assert not any("a.b@c-d.co.uk" in r.text for r in left.collect())
        if name != "encode":
            assert left.columns == docs.columns
    assert counts[0] > counts[1] > counts[2] > counts[3] == counts[4] == counts[5]
    assert left.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_empty_tables(spark, nothing, base):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    left = nothing
    for name, stage in corpus_pipeline.STAGES:
        left = written(stage(spark, left, base), name)
        assert left.collect() == []


def test_memory_is_given_back_and_large_batches_are_cut(monkeypatch):
    texts = ["a" * 30, None, "", "b" * 80, "é" * 250, "c", None]
    batch = pa.record_batch([pa.array(range(7)), pa.array(texts)], ["k", "text"])
    monkeypatch.setattr(common, "RUN_BYTES", 100)
    given_back = []
    monkeypatch.setattr(common, "let_go", lambda: given_back.append(1))
    same = lambda batches: iter(batches)
    for offset in (0, 2):
        parts = list(common.thrifty(same, 1)([batch.slice(offset), batch.slice(0, 0), batch]))
        assert [k for p in parts for k in p.column(0).to_pylist()] == [*range(offset, 7), *range(7)]
        assert all(p.num_rows == 1 or p.column(1).nbytes < 200 for p in parts)
    assert [p.num_rows for p in common.thrifty(same, 1)([batch])] == [3, 1, 1, 2]
    assert [p.num_rows for p in common.thrifty(same)([batch])] == [7]
    assert len(given_back) == 4
