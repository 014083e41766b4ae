"""Interval sets of offsets against sets of numbers."""

import random

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import records
from tidemark.operators import offsets
from tidemark.sources import bronze
from tidemark.streaming.ingest import land_batch


def islands(numbers):
    out = []
    for n in sorted(set(numbers)):
        if out and n == out[-1][1] + 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return [tuple(x) for x in out]


def frame(spark, landed):
    """{(partition, run): offsets}"""
    rows = [("t", p, o, r) for (p, r), found in landed.items() for o in found]
    return spark.createDataFrame(rows, "topic string, partition int, offset long, run_id string").repartition(3)


def got(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@pytest.fixture(scope="module")
def landed():
    rng = random.Random(2)
    runs = {(p, r): [o for o in range(rng.randrange(60), 60 + rng.randrange(80)) if rng.random() < q] for p, q in ((0, 0.98), (1, 0.4)) for r in "abc"}
    runs[0, "a"] += runs[0, "a"][:9]
    runs[2, "a"], runs[2, "b"] = [0, 7, 8, 15, 16, 1000, 10**12], list(range(14, 40))
    runs[3, "c"] = []
    return runs


@pytest.mark.parametrize("size", [1, 8, 1 << 20])
def test_interval_sets(spark, landed, size):
    found = offsets.intervals(frame(spark, landed), ["run_id"], size=size)
    assert got(found, "partition", "run_id", "first", "last") == sorted((p, r, a, b) for (p, r), o in landed.items() for a, b in islands(o))
    if size == 1:
        found = found.where("last < 10000000")  # blocks of one offset each can't hold a hole of 10**12
    depth = {}
    for (p, _), o in landed.items():
        for n in set(o):
            if size > 1 or n < 10**7:
                depth.setdefault(p, {}).setdefault(n, 0)
                depth[p][n] += 1
    twice = [(p, a, b, k) for p, d in depth.items() for k in (2, 3) for a, b in islands(n for n in d if d[n] == k)]
    assert got(offsets.duplicates(found, size), "partition", "first", "last", "times") == sorted(twice)
    missing = [(p, x[1] + 1, y[0] - 1) for p, d in depth.items() for x, y in zip(islands(d), islands(d)[1:], strict=False)]
    assert got(offsets.holes(found, size), "partition", "first", "last") == sorted(missing)


def test_join_with_intervals(spark, landed):
    rows = frame(spark, landed)
    wanted = spark.createDataFrame([("t", 0, 5, 90), ("t", 2, 8, 8), ("t", 2, 16, 1000), ("u", 1, 0, 99)], "topic string, partition int, first long, last long")

    def inside(p, o):
        return (p == 0 and 5 <= o <= 90) or (p == 2 and (o == 8 or 16 <= o <= 1000))

    for size in (4, 1 << 10):
        for how, want in (("semi", True), ("anti", False)):
            found = offsets.in_intervals(rows, wanted, "offset", ["topic", "partition"], how, size)
            assert got(found, "partition", "offset", "run_id") == sorted((p, o, r) for (p, r), all_ in landed.items() for o in all_ if inside(p, o) == want)


def test_nothing(spark):
    rows = spark.createDataFrame([], "topic string, partition int, offset long, run_id string")
    found = offsets.intervals(rows, ["run_id"])
    assert [df.count() for df in (found, offsets.holes(found), offsets.duplicates(found))] == [0, 0, 0]


def test_bronze_read_once(spark, base):
    """Runs that overlap, an offset twice in one file, rows of another writer without offsets."""
    def land(run, batch, ranges):
        rows = [(p, o, "c", o, "SE") for p, a, b in ranges for o in range(a, b)]
        land_batch(records(spark, rows).repartition(2), f"{base}/bronze", run_id=run, ingestion_date="2024-01-01", batch_id=batch, max_records_per_file=7)

    land("r1", 0, [(0, 0, 20), (1, 0, 5)])
    land("r2", 0, [(0, 10, 30), (0, 28, 30)])
    land("r3", 0, [(0, 35, 40), (1, 4, 6)])
    folder = bronze.run_path(f"{base}/bronze", "db", "users", "2024-01-01", "other")
    spark.createDataFrame([("2024-01-01T00:00:00Z", "{}")] * 3, "ingest_ts string, raw_json string").write.parquet(folder)
    runs = [bronze.run_path(f"{base}/bronze", "db", "users", "2024-01-01", r) for r in ("r1", "r2", "r3", "other")]
    rows = bronze.read_runs(spark, f"{base}/bronze", runs)
    once = offsets.each_once(rows, ["run_id"])
    assert once.columns == rows.columns
    kept = got(once.where("offset is not null"), "run_id", "partition", "offset")
    assert kept == sorted(
        [("r1", 0, o) for o in range(20)] + [("r1", 1, o) for o in range(5)] + [("r2", 0, o) for o in range(20, 30)]
        + [("r3", 0, o) for o in range(35, 40)] + [("r3", 1, 5)]
    )
    assert once.where("offset is null").count() == 3
    again = offsets.intervals(once.where("offset is not null"), ["run_id"])
    assert offsets.duplicates(again).count() == 0 and got(offsets.holes(again), "partition", "first", "last") == [(0, 30, 34)]
    texts = {r["raw_json"] for r in once.select("raw_json").collect()}
    assert texts == {r["raw_json"] for r in rows.select("raw_json").collect()}
    assert rows.where(F.col("offset").isNull()).count() == 3
