"""Change records in a folder: offsets, positions, restarts."""

import json

import pytest
from pyspark.sql import functions as F

from tests.test_streaming import records
from tidemark.operators.selection import starting_offsets
from tidemark.sources import change_log
from tidemark.sources.ledger import Ledger
from tidemark.streaming.ingest import batch_rows, ingest


def rows(df):
    return sorted((r["topic"], r["partition"], r["offset"]) for r in df.collect())


def some(spark, *ranges):
    """(partition, first, end) ranges as records."""
    return records(spark, [(p, o, "c", o, "SE") for p, a, b in ranges for o in range(a, b)])


def test_written_and_read(spark, base):
    log = f"{base}/a log"
    assert change_log.segments(log) == [] and rows(change_log.read(spark, log)) == []
    first = some(spark, (0, 0, 50), (1, 10, 12), (2, 5, 6)).where("offset <> 20").repartition(5)
    other = first.withColumn("topic", F.lit("odd/name=x"))
    change_log.append(first.union(other), log, segmentBytes=1000)
    found = change_log.read(spark, log)
    assert found.schema.simpleString() == "struct<key:binary,value:binary,topic:string,partition:int,offset:bigint,timestamp:timestamp>"
    want = first.union(other)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.select(*found.columns).collect()))
    parts = change_log.segments(log)
    assert {s.topic for s in parts} == {"db.public.users", "odd/name=x"} and len(parts) > 8
    assert all(a.end <= b.first for a, b in zip(parts, parts[1:], strict=False) if (a.topic, a.partition) == (b.topic, b.partition))
    start = json.dumps({"db.public.users": {"0": 40, "1": 99}, "odd/name=x": {"0": 49, "1": 12, "2": 6}})
    assert rows(change_log.read(spark, log, startingOffsets=start)) == sorted(
        [("db.public.users", 0, o) for o in range(40, 50)] + [("db.public.users", 2, 5), ("odd/name=x", 0, 49)]
    )
    assert rows(change_log.read(spark, log, startingOffsets="latest")) == []


def test_offsets_are_never_written_twice(spark, base):
    change_log.append(some(spark, (0, 0, 5)), f"{base}/log")
    for wrong in (some(spark, (0, 4, 7)), some(spark, (1, 0, 3), (1, 2, 4)), some(spark, (0, 0, 5))):
        with pytest.raises(Exception, match="offsets"):
            change_log.append(wrong, f"{base}/log")
        assert rows(change_log.read(spark, f"{base}/log")) == [("db.public.users", 0, o) for o in range(5)]
        assert not [s for s in change_log.segments(f"{base}/log") if s.partition == 1]
    with pytest.raises(Exception, match="appended"):
        some(spark, (0, 9, 10)).write.format("change_log").mode("overwrite").option("path", f"{base}/log").save()


def land(spark, base, checkpoint, **options):
    ledger = Ledger(spark, f"{base}/ledger")
    stream = change_log.stream(spark, f"{base}/log", **options)
    run = ingest(stream, f"{base}/bronze", ledger, checkpoint=f"{base}/{checkpoint}", available_now=True)
    return ledger, run


def landed(spark, base, run):
    found = batch_rows(spark, f"{base}/bronze", run.ingestion_date, run.run_id)
    return [] if found is None else rows(found)


def test_a_restart_reads_each_offset_once(spark, base):
    change_log.append(some(spark, (0, 0, 30), (1, 5, 9)), f"{base}/log", segmentBytes=500)
    _, run = land(spark, base, "one")
    assert run.finish() == "SUCCESS" and len(landed(spark, base, run)) == 34
    ledger, run = land(spark, base, "one")
    assert run.finish() == "SUCCESS" and landed(spark, base, run) == []
    change_log.append(some(spark, (0, 30, 33), (2, 0, 2)), f"{base}/log")
    ledger, run = land(spark, base, "one")
    new = [("db.public.users", 0, o) for o in (30, 31, 32)] + [("db.public.users", 2, o) for o in (0, 1)]
    assert run.finish() == "SUCCESS" and landed(spark, base, run) == new
    # positions of the ledger go on where a lost checkpoint left off
    change_log.append(some(spark, (0, 40, 42), (3, 7, 8)), f"{base}/log")
    [position] = starting_offsets(ledger.view("cdc_checkpoints")).collect()
    _, run = land(spark, base, "two", startingOffsets=position[0])
    new = [("db.public.users", 0, o) for o in (40, 41)] + [("db.public.users", 3, 7)]
    assert run.finish() == "SUCCESS" and landed(spark, base, run) == new


def test_a_batch_that_failed_is_read_again(spark, base, monkeypatch):
    change_log.append(some(spark, (0, 0, 6)), f"{base}/log")
    with monkeypatch.context() as m:
        m.setattr(Ledger, "upsert_checkpoints", lambda *a: (_ for _ in ()).throw(OSError("disk full")))
        _, run = land(spark, base, "one")
        assert run.finish() == "FAILED"
    change_log.append(some(spark, (0, 6, 8)), f"{base}/log")
    _, again = land(spark, base, "one")
    assert again.finish() == "SUCCESS"
    assert landed(spark, base, again) == [("db.public.users", 0, o) for o in range(8)]


def test_a_position_behind_the_end(spark, base):
    """Nothing is read until the log gets there; a log that was cut off is an error."""
    change_log.append(some(spark, (0, 0, 6)), f"{base}/log")
    reader = change_log.ChangeLogStreamReader({"path": f"{base}/log", "startingOffsets": '{"db.public.users": {"0": 9}}'})
    at = reader.initialOffset()
    assert reader.latestOffset() == at and reader.partitions(at, at) == []
    with pytest.raises(ValueError, match="lost"):
        reader.partitions({"db.public.users": {"0": 9}}, {"db.public.users": {"0": 12}})
