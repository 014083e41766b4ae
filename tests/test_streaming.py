"""Landing and following streams: restarts, redelivery, failure."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark import USERS, EntitySpec
from tidemark.plans.compact import compact
from tidemark.plans.merge import current_table
from tidemark.plans.pipeline import run_pipeline
from tidemark.sources import bronze, fs
from tidemark.sources.ledger import Ledger
from tidemark.streaming.current import follow
from tidemark.streaming.ingest import batch_rows, ingest, land_batch


def records(spark, rows):
    """(partition, offset, op, user, country) to stream records."""

    def value(offset, op, key, country):
        image = {"user_id": key, "email": "e", "country_code": country}
        body = {"before": image if op == "d" else None, "after": None if op == "d" else image, "op": op}
        return json.dumps({**body, "source": {"table": "users", "lsn": offset}, "ts_ms": 1704067200000 + offset}).encode()

    data = [
        (b"k", None if op is None else value(o, op, k, c), "db.public.users", p, o) for p, o, op, k, c in rows
    ]
    df = spark.createDataFrame(data, "key binary, value binary, topic string, partition int, offset long")
    return df.withColumn("timestamp", F.timestamp_seconds(F.col("offset") + 1700000000))


def put(spark, base, rows):
    records(spark, rows).coalesce(1).write.mode("append").parquet(f"{base}/records")


def start(spark, base, **options):
    ledger = Ledger(spark, f"{base}/ledger")
    stream = bronze.file_stream(spark, f"{base}/records")
    return ledger, ingest(stream, f"{base}/bronze", ledger, checkpoint=f"{base}/checkpoint", available_now=True, **options)


def offsets(spark, base):
    rows = spark.read.schema(bronze.BRONZE_DDL).parquet(f"{base}/bronze/cdc")
    return sorted((r["partition"], r["offset"]) for r in rows.collect())


def test_landing_and_restart(spark, base):
    put(spark, base, [(0, 0, "c", 1, "SE"), (0, 1, "u", 1, "DE"), (1, 0, "c", 2, "SE"), (1, 1, None, 2, "")])
    ledger, run = start(spark, base, topics=["db.public.users"], group_id="g", max_records_per_file=1)
    assert run.finish() == "SUCCESS"
    assert offsets(spark, base) == [(0, 0), (0, 1), (1, 0)], "a record without a value carries no event"
    assert (ledger.get_checkpoint("db.public.users", 0), ledger.get_checkpoint("db.public.users", 1)) == (1, 0)
    assert len(fs.glob(spark, f"{base}/bronze/cdc/*/*/*/*/batch=*/part-*")) == 3, "one row per file"
    folder = fs.folder_values(fs.glob(spark, f"{base}/bronze/cdc/*/*/*/*")[0])
    assert (folder["source"], folder["table"], folder["run_id"]) == ("db", "users", run.run_id)

    manifest = spark.read.json(f"{base}/bronze/manifests/run_id={run.run_id}/summary").collect()
    assert len(manifest) == 1
    row = manifest[0].asDict(recursive=True)
    assert (row["status"], row["kafka_group_id"], row["topics"], row["n_files"], row["rows"]) == ("SUCCESS", "g", ["db.public.users"], 3, 3)
    assert row["last_offsets"] == {"db.public.users": {"0": 1, "1": 0}}
    assert spark.read.json(f"{base}/bronze/manifests/run_id={run.run_id}/files").count() == 3

    put(spark, base, [(0, 2, "u", 1, "NO"), (1, 2, "c", 3, "SE")])
    ledger, again = start(spark, base)
    assert again.finish() == "SUCCESS" and again.run_id != run.run_id
    assert offsets(spark, base) == [(0, 0), (0, 1), (0, 2), (1, 0), (1, 2)], "nothing lost, nothing twice"
    assert ledger.get_checkpoint("db.public.users", 0) == 2


def test_ingest_stamp_and_text(spark, base):
    put(spark, base, [(0, 0, "c", 1, "SE")])
    _, run = start(spark, base, ingestion_date="2024-05-05")
    run.finish()
    row = batch_rows(spark, f"{base}/bronze", "2024-05-05", run.run_id).first()
    assert len(row["ingest_ts"]) == 20 and row["ingest_ts"].endswith("Z")
    assert json.loads(row["raw_json"])["payload"]["after"]["country_code"] == "SE"


def test_batch_delivered_again_is_replaced(spark, base):
    df = records(spark, [(0, 0, "c", 1, "SE"), (0, 1, "c", 2, "SE")])
    for _ in range(2):
        land_batch(df, f"{base}/bronze", run_id="r", ingestion_date="2024-01-01", batch_id=4, max_records_per_file=10)
    land_batch(records(spark, [(0, 2, "c", 3, "SE")]), f"{base}/bronze", run_id="r", ingestion_date="2024-01-01", batch_id=5, max_records_per_file=10)
    assert offsets(spark, base) == [(0, 0), (0, 1), (0, 2)]


def test_include_list(spark, base):
    put(spark, base, [(0, 0, "c", 1, "SE")])
    _, run = start(spark, base, tables=["public.orders"])
    assert run.finish() == "SUCCESS"
    assert batch_rows(spark, f"{base}/bronze", run.ingestion_date, run.run_id) is None


def test_failed_run_is_not_compacted(spark, base, monkeypatch):
    put(spark, base, [(0, 0, "c", 1, "SE")])
    monkeypatch.setattr(Ledger, "upsert_checkpoints", lambda *a: (_ for _ in ()).throw(OSError("disk full")))
    ledger, run = start(spark, base)
    assert run.finish() == "FAILED"
    assert "disk full" in ledger.get_run(run.run_id).details["error"]
    assert compact(spark, f"{base}/bronze", ledger).count() == 0
    assert compact(spark, f"{base}/bronze", ledger, statuses=("SUCCESS", "FAILED")).count() == 1


def test_graceful_stop(spark, base):
    put(spark, base, [(0, 0, "c", 1, "SE")])
    ledger = Ledger(spark, f"{base}/ledger")
    stream = bronze.file_stream(spark, f"{base}/records")
    run = ingest(stream, f"{base}/bronze", ledger, checkpoint=f"{base}/checkpoint", flush_seconds=1)
    assert run.stop(drain=True) == "SUCCESS"
    assert ledger.get_run(run.run_id).details == {"message": "ended by itself or was stopped"}
    assert offsets(spark, base) == [(0, 0)]


def test_follow(spark, base):
    ledger = Ledger(spark, f"{base}/ledger")

    def step():
        stream = bronze.file_stream(spark, f"{base}/records")
        follow(stream, f"{base}/silver", ledger, USERS, checkpoint=f"{base}/cp", name="f", buckets=2).awaitTermination()
        current = current_table(spark, f"{base}/silver", ledger, USERS)
        return sorted((r["user_id"], r["country_code"]) for r in current.collect())

    put(spark, base, [(0, 5, "u", 1, "DE"), (0, 6, "c", 2, "SE")])
    assert step() == [(1, "DE"), (2, "SE")]
    put(spark, base, [(0, 1, "c", 1, "SE"), (0, 9, "d", 2, "SE")])
    assert step() == [(1, "DE")], "an older event changes nothing, a delete removes"
    put(spark, base, [(0, 7, "u", 2, "NO")])
    assert step() == [(1, "DE")], "the deleted key stays away from older events"


def test_pipeline_twice(spark, base):
    put(spark, base, [(0, 0, "c", 1, "SE"), (0, 1, "c", 2, "SE"), (0, 2, "d", 2, "SE")])
    first = run_pipeline(bronze.file_stream(spark, f"{base}/records"), f"{base}/lake", [USERS], buckets=2)
    assert [r["user_id"] for r in first["users"].collect()] == [1]
    put(spark, base, [(0, 90000000, "u", 1, "DE"), (0, 90000001, "c", 5, "SE")])
    second = run_pipeline(bronze.file_stream(spark, f"{base}/records"), f"{base}/lake", [USERS])
    assert sorted((r["user_id"], r["country_code"]) for r in second["users"].collect()) == [(1, "DE"), (5, "SE")]


def test_a_wait_that_times_out_leaves_the_run_open(spark, base):
    ledger = Ledger(spark, f"{base}/ledger")
    put(spark, base, [(0, i, "c", i, "SE") for i in range(3)])
    run = ingest(bronze.file_stream(spark, f"{base}/records"), f"{base}/bronze", ledger, checkpoint=f"{base}/cp", flush_seconds=1)
    assert run.finish(timeout=1) == "STARTED" and run.query.isActive
    assert ledger.get_run(run.run_id).status == "STARTED"
    assert run.stop(drain=True) == "SUCCESS"
    with pytest.raises(ValueError, match="ended"):
        ingest(bronze.file_stream(spark, f"{base}/records"), f"{base}/bronze", ledger, checkpoint=f"{base}/cp", run_id=run.run_id)


def test_a_batch_of_other_tables_writes_no_version(spark, base):
    ledger = Ledger(spark, f"{base}/ledger")
    put(spark, base, [(0, i, "c", i, "SE") for i in range(3)])
    other = EntitySpec("absent", USERS.pk, USERS.fields)
    follow(
        bronze.file_stream(spark, f"{base}/records"), f"{base}/silver", ledger, other, checkpoint=f"{base}/cp", name="f", buckets=2
    ).awaitTermination()
    assert ledger.last_number("merge_current", "absent") == 0


def test_a_rescued_run_is_closed(spark, base, monkeypatch):
    """Rows landed into a run after its rescue would never be compacted: they go to a new run."""
    put(spark, base, [(0, i, "c", i, "SE") for i in range(5)])
    with monkeypatch.context() as m:
        m.setattr(Ledger, "upsert_checkpoints", lambda *a: (_ for _ in ()).throw(OSError("disk full")))
        ledger, run = start(spark, base, run_id="r")
        assert run.finish() == "FAILED"
    assert [r["rows"] for r in compact(spark, f"{base}/bronze", ledger, statuses=("SUCCESS", "FAILED")).collect()] == [5]
    put(spark, base, [(0, i, "c", i, "SE") for i in range(5, 8)])
    with pytest.raises(ValueError, match="compacted"):
        start(spark, base, run_id="r")
    _, again = start(spark, base, run_id="r2")
    assert again.finish() == "SUCCESS"
    compact(spark, f"{base}/bronze", ledger)
    rows = spark.read.parquet(f"{base}/bronze/compacted").select("offset").distinct()
    assert sorted(r["offset"] for r in rows.collect()) == list(range(8))


def test_a_failed_run_that_goes_on_is_no_failed_run(spark, base, monkeypatch):
    """While it lands again, nobody may rescue it."""
    put(spark, base, [(0, i, "c", i, "SE") for i in range(3)])
    with monkeypatch.context() as m:
        m.setattr(Ledger, "upsert_checkpoints", lambda *a: (_ for _ in ()).throw(OSError("disk full")))
        ledger, run = start(spark, base, run_id="r")
        assert run.finish() == "FAILED"
    ledger, run = start(spark, base, run_id="r")
    row = ledger.get_run("r")
    assert (row.status, row.end_time, row.details) == ("STARTED", None, None) and row.start_time
    assert compact(spark, f"{base}/bronze", ledger, statuses=("SUCCESS", "FAILED")).count() == 0
    assert run.finish() == "SUCCESS" and offsets(spark, base) == [(0, i) for i in range(3)]


def test_a_run_belongs_to_its_checkpoint(spark, base):
    """Batches of another checkpoint have the same numbers: they would replace those that are there."""
    put(spark, base, [(0, i, "c", i, "SE") for i in range(5)])
    ledger = Ledger(spark, f"{base}/ledger")
    stream = bronze.file_stream(spark, f"{base}/records")
    run = ingest(stream, f"{base}/bronze", ledger, checkpoint=f"{base}/one", run_id="r", flush_seconds=1)
    run.query.processAllAvailable()
    run.query.stop()
    with pytest.raises(ValueError, match="checkpoint"):
        ingest(stream, f"{base}/bronze", ledger, checkpoint=f"{base}/two", run_id="r", available_now=True)
    put(spark, base, [(0, i, "c", i, "SE") for i in range(5, 7)])
    again = ingest(stream, f"{base}/bronze", ledger, checkpoint=f"{base}/one/", run_id="r", available_now=True)
    assert again.finish() == "SUCCESS" and offsets(spark, base) == [(0, i) for i in range(7)]
