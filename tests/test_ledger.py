"""Ledger tables: latest row per key, run life cycle, tidying."""

import datetime
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tidemark.sources import fs, ledger as ledger_module
from tidemark.sources.ledger import Ledger, merged_date


def test_run_life_cycle(spark, base):
    ledger = Ledger(spark, base)
    assert ledger.get_run("r1") is None
    ledger.start_run("r1", "2024-01-01")
    run = ledger.get_run("r1")
    assert (run.status, run.details, run.ingestion_date) == ("STARTED", None, "2024-01-01")
    with pytest.raises(ValueError):
        ledger.start_run("r1")
    ledger.end_run("r1", "FAILED", {"error": "é"})
    assert (ledger.get_run("r1").status, ledger.get_run("r1").details) == ("FAILED", {"error": "é"})
    ledger.end_run("r1", "SUCCESS", {})
    assert (ledger.get_run("r1").status, ledger.get_run("r1").details) == ("SUCCESS", None)
    ledger.end_run("never started", "SUCCESS")
    rows = ledger.view("pipeline_runs").collect()
    assert [r["run_id"] for r in rows] == ["r1"] and rows[0]["start_time"] and rows[0]["end_time"]


def test_checkpoints(spark, base):
    ledger = Ledger(spark, base)
    assert ledger.get_checkpoint("t", 0) is None
    ledger.upsert_checkpoint("t", 0, 10)
    ledger.upsert_checkpoint("t", 1, 7)
    ledger.upsert_checkpoint("t", 0, 3)
    assert (ledger.get_checkpoint("t", 0), ledger.get_checkpoint("t", 1)) == (3, 7)
    offsets = spark.createDataFrame([("t", 0, 50), ("u", 0, 1)], "topic string, partition int, last_committed_offset long")
    ledger.upsert_checkpoints(offsets)
    assert [ledger.get_checkpoint(*k) for k in (("t", 0), ("t", 1), ("u", 0))] == [50, 7, 1]


def test_silver_runs(spark, base):
    ledger = Ledger(spark, base)
    ledger.start_silver_run("s1", "job", "users")
    with pytest.raises(ValueError):
        ledger.start_silver_run("s1", "job", "users")
    ledger.end_silver_run("s1", "SUCCESS", {"n": 1})
    row = ledger.view("silver_runs").first()
    assert (row["job_name"], row["table_name"], row["status"], row["details"]) == ("job", "users", "SUCCESS", {"n": "1"})


def commit(ledger, number, table, run, *dates, **facts):
    return ledger.commit_merge(number, job_name="job", table_name=table, run_id=run, dates=[merged_date(*d) for d in dates], **facts)


def test_processed_partitions(spark, base):
    ledger = Ledger(spark, base)
    assert ledger.processed_partitions("job", "users").count() == 0
    assert commit(ledger, 1, "users", "r1", ("2024-01-01", None, 5, 4))
    assert commit(ledger, 2, "users", "r2", ("2024-01-02", None, 0, 0))
    assert commit(ledger, 1, "orders", "r3", ("2024-01-01", None, 1, 1))
    assert commit(ledger, 3, "users", "r4", ("2024-01-01", None, 9, 8))
    rows = ledger.processed_partitions("job", "users").orderBy("event_date").collect()
    assert [(r["event_date"], r["run_id"], r["rows_in"], r["rows_out"]) for r in rows] == [
        ("2024-01-01", "r4", 9, 8),
        ("2024-01-02", "r2", 0, 0),
    ]
    assert ledger.has_merge("job", "users", "r2") and not ledger.has_merge("job", "users", "r3")


def test_one_merge_per_number(spark, base):
    ledger = Ledger(spark, base)
    assert ledger.live_version("job", "users") is None and ledger.last_number("job", "users") == 0
    assert commit(ledger, 1, "users", "a", version="a", rows=1)
    assert not commit(ledger, 1, "users", "b", version="b", rows=2)
    live = ledger.live_version("job", "users")
    assert (live["number"], live["version"], live["rows"]) == (1, "a", 1)
    # a commit that can't be read is no absent one: nothing may be built on the version before it
    fs.create_text(spark, ledger._merges("job", "users"), "commit-000000000002.json", "")
    with pytest.raises(RuntimeError, match="damaged"):
        ledger.live_version("job", "users")
    assert ledger.last_number("job", "users") == 2


def test_files_appear_whole_or_not_at_all(spark, base, monkeypatch):
    """A writer lost before it publishes leaves no name behind; of many writers of a name one succeeds."""
    folder = f"{base}/f"
    with monkeypatch.context() as m:
        m.setattr(fs, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            fs.create_text(spark, folder, "commit-1", "text")
    assert not fs.exists(spark, f"{folder}/commit-1")
    with ThreadPoolExecutor(6) as pool:
        made = list(pool.map(lambda i: fs.create_text(spark, folder, "commit-1", f"text {i}"), range(12)))
    assert sum(made) == 1 and fs.read_text(spark, f"{folder}/commit-1") == f"text {made.index(True)}"
    assert fs.names(spark, folder) == ["commit-1"]
    # the way of other file systems
    for name in ("a", "b"):
        fs.write_text(spark, folder, name, name)
    source, target = fs._path(spark, f"{folder}/a")[0], fs._path(spark, f"{folder}/c")[0]
    fs._rename_unless_there(spark, source, target)
    assert fs.names(spark, folder) == ["b", "c", "commit-1"]
    with pytest.raises(Exception, match="AlreadyExists"):
        fs._rename_unless_there(spark, target, fs._path(spark, f"{folder}/b")[0])
    assert fs.read_text(spark, f"{folder}/b") == "b"


def test_tidy_keeps_the_view(spark, base, monkeypatch):
    monkeypatch.setattr(ledger_module, "MAX_FILES", 3)
    ledger = Ledger(spark, base)
    for i in range(9):
        ledger.upsert_checkpoint("t", i % 2, i)
    # what a reader may have listed is still there
    assert len(fs.glob(spark, f"{base}/cdc_checkpoints/part-*")) > 9
    assert (ledger.get_checkpoint("t", 0), ledger.get_checkpoint("t", 1)) == (8, 7)
    monkeypatch.setattr(ledger_module, "GRACE_SECONDS", -1)
    for i in range(9, 13):
        ledger.upsert_checkpoint("t", i % 2, i)
    assert len(fs.glob(spark, f"{base}/cdc_checkpoints/part-*")) <= 8
    assert (ledger.get_checkpoint("t", 0), ledger.get_checkpoint("t", 1)) == (12, 11)


def test_no_row_of_several_writers_is_lost(spark, base, monkeypatch):
    monkeypatch.setattr(ledger_module, "MAX_FILES", 5)

    def write(k):
        ledger = Ledger(spark, base)
        for i in range(6):
            ledger.append_rows("cdc_checkpoints", spark.createDataFrame([(f"t{k}", i, i)], "topic string, partition int, last_committed_offset long").withColumn("updated_at", F.lit("x")))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(4)))
    rows = Ledger(spark, base).view("cdc_checkpoints").collect()
    assert {(r.topic, r.partition, r.last_committed_offset) for r in rows} == {(f"t{k}", i, i) for k in range(4) for i in range(6)}


def test_stamps_are_utc(spark, base):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        stamp = Ledger(spark, base).now()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    gap = datetime.datetime.now(datetime.timezone.utc) - datetime.datetime.fromisoformat(stamp)
    assert stamp.endswith("+00:00") and abs(gap.total_seconds()) < 60


def test_unknown_column(spark, base):
    with pytest.raises(ValueError):
        Ledger(spark, base).append("pipeline_runs", run="x")


def test_appended_rows(spark, base):
    """Columns that a frame lacks are null, the last of a key's rows counts, an empty frame leaves nothing behind, and
    no row passes through the driver."""
    ledger = Ledger(spark, base)
    details = F.when(F.col("id") % 2 == 1, F.create_map(F.lit("error"), F.lit("é")))
    rows = spark.range(0, 5000, 1, 4).select(
        F.concat(F.lit('run "'), F.expr("id div 2")).alias("run_id"), F.lit("a").alias("start_time"), details.alias("details"), "id"
    )
    with pytest.MonkeyPatch.context() as m:
        m.setattr(ledger, "_put", lambda *a: (_ for _ in ()).throw(AssertionError("rows on the driver")))
        ledger.append_rows("pipeline_runs", rows)
        ledger.append_rows("pipeline_runs", rows.where("id < 0"))
    assert len(fs.names(spark, f"{base}/pipeline_runs")) == 1
    seen = ledger.view("pipeline_runs").where("status is null and checkpoint is null and details['error'] = 'é' and start_time = 'a'")
    assert (seen.count(), seen.select("run_id").distinct().count()) == (2500, 2500)
    ledger.append("pipeline_runs", run_id='run "7', status="SUCCESS", checkpoint="c")
    assert (ledger.get_run('run "7').status, ledger.get_run('run "8').status) == ("SUCCESS", None)
