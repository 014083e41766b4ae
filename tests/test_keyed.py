"""The last event per key as the state of a stream."""

import random

import pytest

from tests.test_streaming import put, records
from tidemark import USERS
from tidemark.operators import merge
from tidemark.operators.envelope import wrap_kafka
from tidemark.operators.structure import judge, stage_rows
from tidemark.sources import bronze
from tidemark.streaming.keyed import keep_current, kept_current, newest_of_parts


def run(spark, base, **options):
    stream = bronze.file_stream(spark, f"{base}/records", maxFilesPerTrigger="1")
    keep_current(stream, f"{base}/changes", USERS, checkpoint=f"{base}/cp", **options).awaitTermination()


def state(df):
    return sorted((r["user_id"], r["country_code"], r["lsn"], r["src_offset"]) for r in df.collect())


def test_any_cut_into_batches(spark, base):
    rng = random.Random(4)
    rows = [(p, 1000 * p + o, rng.choice("ccuud"), rng.randrange(12), rng.choice(["SE", "DE", "NO"])) for p in (0, 1) for o in range(60)]
    events = wrap_kafka(records(spark, rows)).select("raw_json")
    stage = stage_rows(judge(events, [USERS]), USERS)
    want = state(merge.live(merge.merge_current(None, stage, USERS.pk, "ordered")))
    rng.shuffle(rows)
    cuts = [0, 7, 8, 50, 51, 90, 120]
    for a, b in zip(cuts, cuts[1:], strict=False):
        put(spark, base, rows[a:b])
        if a != 8:
            run(spark, base)
            assert spark.read.parquet(f"{base}/changes").count() <= b
    assert state(kept_current(spark, f"{base}/cp")) == want
    changes = spark.read.parquet(f"{base}/changes")
    last = {}
    for r in changes.orderBy("batch").collect():
        last[r["user_id"]] = r
    assert sorted((r["user_id"], r["country_code"], r["lsn"], r["src_offset"]) for r in last.values() if not r["is_delete"]) == want


def test_a_batch_without_news_gives_out_nothing(spark, base):
    put(spark, base, [(0, 5, "u", 1, "DE"), (0, 6, "d", 2, "SE")])
    run(spark, base)
    put(spark, base, [(0, 1, "c", 1, "SE"), (0, 2, "c", 2, "SE")])
    run(spark, base)
    assert [r["user_id"] for r in kept_current(spark, f"{base}/cp").collect()] == [1]
    by_batch = [r["n"] for r in spark.read.parquet(f"{base}/changes").groupBy("batch").count().withColumnRenamed("count", "n").collect()]
    assert by_batch == [2]


def test_deleted_keys_are_forgotten(spark, base):
    """Once the stream is so much later; older events are left out then. A key that lives again has no timer."""
    put(spark, base, [(0, 5, "d", 1, "SE"), (0, 6, "d", 2, "SE"), (0, 7, "c", 3, "SE")])
    run(spark, base, expire="10 milliseconds")
    put(spark, base, [(0, 8, "c", 2, "NO"), (0, 30, "c", 4, "NO")])
    run(spark, base, expire="10 milliseconds")
    put(spark, base, [(0, 1, "c", 1, "DE"), (0, 2, "c", 2, "XX"), (0, 31, "d", 4, "XX")])
    run(spark, base, expire="10 milliseconds")
    got = sorted((r["user_id"], r["country_code"]) for r in kept_current(spark, f"{base}/cp").collect())
    assert got == [(2, "NO"), (3, "SE")]
    stored = spark.read.format("statestore").option("stateVarName", "last").load(f"{base}/cp").select("key.*")
    assert sorted(r["user_id"] for r in stored.collect()) == [2, 3, 4]


@pytest.mark.parametrize("op, want", [("d", []), ("c", [1])])
def test_no_position_is_newest(spark, base, op, want):
    put(spark, base, [(0, 5, "u", 1, "DE")])
    run(spark, base)
    records(spark, [(0, 1, op, 1, "SE")]).selectExpr(
        "key", "cast(replace(cast(value as string), '\"lsn\": 1', '\"lsn\": null') as binary) value", "topic", "partition", "offset", "timestamp"
    ).write.mode("append").parquet(f"{base}/records")
    run(spark, base)
    assert [r["user_id"] for r in kept_current(spark, f"{base}/cp").collect()] == want


def test_newest_of_parts(spark):
    """One row per key and partition reaches the state, the newest by the order of ``ordered`` merges."""
    rng = random.Random(7)
    maybe = lambda top: rng.choice([None, *range(top)])
    rows = [(rng.choice([f"k{i}" for i in range(30)]), maybe(4), maybe(3), rng.choice([None, "a", "b"]), maybe(5), i) for i in range(2000)]
    stage = spark.createDataFrame(rows, "pk string, lsn long, ts_ms long, ingest_ts string, src_offset long, src_row long")
    got = newest_of_parts(stage, "pk").collect()
    assert len(got) == 30
    assert sorted(map(tuple, got)) == sorted(map(tuple, merge.latest_events(stage, "pk", "ordered").select(*stage.columns).collect()))
