"""Compaction, structuring and merging as jobs: what lies in the folders, and what a rerun does."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tidemark import ORDERS, USERS
from tidemark.plans import compact as compact_plan
from tidemark.plans import merge as merge_plan
from tidemark.plans.compact import compact
from tidemark.plans.merge import current_table, run_merge
from tidemark.plans.structure import run_structure, structure_file
from tidemark.sources import bronze, fs, silver
from tidemark.sources.ledger import Ledger

DAY = 86400000
T0 = 1704067200000  # 2024-01-01


def user(op, key, lsn, day=0, country="SE", table="users", **payload):
    image = {"user_id": key, "email": f"u{key}@x", "country_code": country, "created_at": None, "updated_at": None}
    sides = {"before": image if op == "d" else None, "after": None if op == "d" else image}
    body = {**sides, "source": {"table": table, "lsn": lsn}, "op": op, "ts_ms": T0 + day * DAY + (lsn or 0), **payload}
    return json.dumps({"payload": body})


def write_events(spark, path, texts, files=1):
    df = spark.createDataFrame([("2024-02-01T00:00:00Z", t) for t in texts], "ingest_ts string, raw_json string")
    df.repartition(files).write.mode("append").parquet(path)


def run_folder(base, run, table="users", date="2024-02-01"):
    return bronze.run_path(f"{base}/bronze", "db", table, date, run)


def state(df):
    return sorted((r["user_id"], r["country_code"], r["lsn"]) for r in df.collect())


# Compaction ------------------------------------------------------------------------------------------------------


def test_compaction(spark, base):
    ledger = Ledger(spark, f"{base}/ledger")
    for run, status in (("ok", "SUCCESS"), ("broken", "FAILED"), ("open", None)):
        write_events(spark, run_folder(base, run), [user("c", i, i) for i in range(3)])
        write_events(spark, run_folder(base, run), [user("c", i, i) for i in range(3, 5)])
        ledger.start_run(run, "2024-02-01")
        if status:
            ledger.end_run(run, status)
    done = compact(spark, f"{base}/bronze", ledger).collect()
    assert [(r["run_id"], r["parts"], r["rows"]) for r in done] == [("ok", 2, 5)]
    out = fs.glob(spark, f"{base}/bronze/compacted/*/*/*/run_id=*/part-*")
    assert len(out) == 1 and "run_id=ok" in out[0]
    assert spark.read.parquet(out[0]).count() == 5
    assert compact(spark, f"{base}/bronze", ledger).count() == 0, "compacted once"
    assert len(fs.glob(spark, f"{run_folder(base, 'ok')}/part-*")) == 2, "originals stay"


def test_compaction_again_after_a_crash(spark, base, monkeypatch):
    """Without its ledger row a compaction is done again, and nothing is doubled."""
    ledger = Ledger(spark, f"{base}/ledger")
    write_events(spark, run_folder(base, "r"), [user("c", i, i) for i in range(7)], files=3)
    ledger.start_run("r")
    ledger.end_run("r", "SUCCESS")
    with monkeypatch.context() as m:
        m.setattr(Ledger, "append_rows", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            compact(spark, f"{base}/bronze", ledger)
    assert [r["rows"] for r in compact(spark, f"{base}/bronze", ledger).collect()] == [7]
    assert spark.read.parquet(f"{base}/bronze/compacted").count() == 7


def test_compaction_prune_date_and_markers(spark, base):
    """Runs of another writer count as finished by their _SUCCESS file."""
    ledger = Ledger(spark, f"{base}/ledger")
    for run, date in (("a", "2024-02-01"), ("b", "2024-02-02")):
        folder = run_folder(base, run, date=date)
        os.makedirs(folder)
        write_events(spark, f"{base}/tmp-{run}", [user("c", 1, 1)])
        spark.read.parquet(f"{base}/tmp-{run}").write.mode("append").parquet(folder)  # leaves _SUCCESS
    done = compact(spark, f"{base}/bronze", ledger, only_date="2024-02-02", prune=True).collect()
    assert [r["run_id"] for r in done] == ["b"]
    assert not fs.exists(spark, run_folder(base, "b", date="2024-02-02")) and fs.exists(spark, run_folder(base, "a"))
    assert [r["run_id"] for r in compact(spark, f"{base}/bronze", ledger).collect()] == ["a"]


def test_compacted_rows_keep_arrival_order(spark, base):
    ledger = Ledger(spark, f"{base}/ledger")
    write_events(spark, run_folder(base, "r"), [user("c", i, i) for i in range(50)], files=1)
    ledger.start_run("r")
    ledger.end_run("r", "SUCCESS")
    compact(spark, f"{base}/bronze", ledger)
    before = [r["raw_json"] for r in spark.read.parquet(run_folder(base, "r")).collect()]
    after = [r["raw_json"] for r in spark.read.parquet(run_folder(base, "r").replace("/cdc/", "/compacted/")).collect()]
    assert before == after


# Structure -------------------------------------------------------------------------------------------------------


def test_structure_file(spark, base):
    texts = [user("c", 1, 1), user("u", 1, 2, day=1), user("d", 1, 3, day=1), "{bad", user("c", 2, 4, table="other"), user("c", None, 5)]
    write_events(spark, f"{base}/in", texts, files=3)
    for _ in range(2):  # a rerun replaces
        counts = structure_file(spark, f"{base}/in", USERS, f"{base}/silver")
        assert (counts.total, counts.stage_rows, counts.bad_rows) == (6, 3, 3)
        stage = silver.read_stage(spark, f"{base}/silver", USERS)
        assert sorted((r["event_date"], r["op"]) for r in stage.collect()) == [
            ("2024-01-01", "c"), ("2024-01-02", "d"), ("2024-01-02", "u"),
        ]
        bad = silver.read_quarantine(spark, f"{base}/silver", "users")
        assert sorted(r["error"] for r in bad.collect()) == ["JSON_PARSE", "TABLE_MISMATCH", "USER_ID_NULL"]
    lines = [json.loads(r["value"]) for r in spark.read.text(f"{base}/silver/stage_events_quarantine/table=users/run_id=*").collect()]
    by_code = {line["error"]: set(line) for line in lines}
    assert by_code["JSON_PARSE"] == {"row", "error", "ingest_ts", "raw_json"}
    assert by_code["TABLE_MISMATCH"] == {"row", "error", "ingest_ts", "expected_table", "actual_table"}
    assert by_code["USER_ID_NULL"] == {"row", "error", "ingest_ts", "table", "op", "ts_ms", "lsn"}


def test_structure_without_rejects_writes_no_quarantine(spark, base):
    write_events(spark, f"{base}/in", [user("c", 1, 1)])
    structure_file(spark, f"{base}/in", USERS, f"{base}/silver", spread=False)
    assert not fs.exists(spark, f"{base}/silver/{silver.QUARANTINE}")


def test_structure_all_rejected(spark, base):
    write_events(spark, f"{base}/in", ["{bad", "{worse"])
    assert structure_file(spark, f"{base}/in", USERS, f"{base}/silver").bad_rows == 2
    assert silver.read_stage(spark, f"{base}/silver", USERS).count() == 0


def test_structure_input_contract(spark, base):
    with pytest.raises(FileNotFoundError):
        structure_file(spark, f"{base}/nothing", USERS, f"{base}/silver")
    spark.range(1).write.parquet(f"{base}/wrong")
    with pytest.raises(ValueError, match="ingest_ts"):
        structure_file(spark, f"{base}/wrong", USERS, f"{base}/silver")


def test_rerun_with_fewer_dates_leaves_none_behind(spark, base):
    write_events(spark, f"{base}/a", [user("c", 1, 1), user("c", 2, 2, day=1)])
    write_events(spark, f"{base}/b", [user("c", 1, 1)])
    structure_file(spark, f"{base}/a", USERS, f"{base}/silver", run_id="r")
    structure_file(spark, f"{base}/b", USERS, f"{base}/silver", run_id="r")
    assert silver.read_stage(spark, f"{base}/silver", USERS).count() == 1


def test_run_structure_is_incremental(spark, base):
    ledger = Ledger(spark, f"{base}/ledger")

    def land(run, texts):
        write_events(spark, run_folder(base, run), texts)
        ledger.start_run(run)
        ledger.end_run(run, "SUCCESS")
        compact(spark, f"{base}/bronze", ledger)

    land("r1", [user("c", 1, 1), "{bad"])
    counts = run_structure(spark, f"{base}/bronze", f"{base}/silver", ledger, [USERS, ORDERS])
    assert {t: (c.stage_rows, c.bad_rows) for t, c in counts.items()} == {"users": (1, 1)}
    assert run_structure(spark, f"{base}/bronze", f"{base}/silver", ledger, [USERS]) == {}
    land("r2", [user("c", 2, 2)])
    counts = run_structure(spark, f"{base}/bronze", f"{base}/silver", ledger, [USERS])
    assert counts["users"].stage_rows == 1
    assert silver.read_stage(spark, f"{base}/silver", USERS).count() == 2
    rows = {r["run_id"]: (r["total"], r["stage_rows"], r["bad_rows"]) for r in ledger.view("structured_runs").collect()}
    assert rows == {"r1": (2, 1, 1), "r2": (1, 1, 0)}


def test_import_stage_of_another_tool(spark, base):
    """Columns that are null throughout carry an odd type, and differ between files."""
    cdc = "'orders' AS `table`, 'c' AS op, 1L AS ts_ms, {lsn} AS lsn, '2024-01-01' AS event_date, 'x' AS ingest_ts, false AS is_delete"
    one = spark.sql(f"SELECT {cdc.format(lsn='5L')}, 1L AS order_id, CAST(NULL AS INT) AS is_deleted, 's' AS status")
    two = spark.sql(f"SELECT {cdc.format(lsn='CAST(NULL AS INT)')}, 2L AS order_id, true AS is_deleted, CAST(NULL AS INT) AS status")
    one.write.parquet(f"{base}/one")
    two.write.parquet(f"{base}/two")
    got = silver.import_stage(spark, [f"{base}/one", f"{base}/two"], ORDERS).orderBy("order_id").collect()
    assert [(r["order_id"], r["lsn"], r["is_deleted"], r["status"], r["currency"]) for r in got] == [
        (1, 5, None, "s", None), (2, None, True, None, None),
    ]
    spark.range(1).write.parquet(f"{base}/three")
    with pytest.raises(ValueError, match="lsn"):
        silver.import_stage(spark, [f"{base}/three"], ORDERS)
    folder = f"{base}/silver/stage_events/table=orders/event_date=2024-01-01"
    for name in ("one", "two"):
        os.makedirs(folder, exist_ok=True)
        os.rename(fs.glob(spark, f"{base}/{name}/part-*")[0].removeprefix("file:"), f"{folder}/{name}.parquet")
    ledger = Ledger(spark, f"{base}/ledger")
    assert run_merge(spark, f"{base}/silver", ledger, ORDERS, buckets=2, foreign=True).rows == 2


# Merge -----------------------------------------------------------------------------------------------------------


def stage(spark, base, texts, run):
    write_events(spark, f"{base}/in-{run}", texts)
    structure_file(spark, f"{base}/in-{run}", USERS, f"{base}/silver", run_id=run)


def test_merge_is_incremental(spark, base):
    ledger = Ledger(spark, f"{base}/ledger")
    silver_base = f"{base}/silver"
    assert run_merge(spark, silver_base, ledger, USERS).status == "nothing_to_process"
    assert current_table(spark, silver_base, ledger, USERS).count() == 0
    stage(spark, base, [user("c", 1, 1), user("c", 2, 2), user("c", 2, 2), user("d", 2, 3, day=1), user("c", 3, 4, day=1)], "r1")
    result = run_merge(spark, silver_base, ledger, USERS, buckets=4)
    assert result.rows == 2
    assert [(d["event_date"], d["rows_in"], d["rows_out"]) for d in result.dates] == [("2024-01-01", 2, 2), ("2024-01-02", 2, 2)]
    assert state(current_table(spark, silver_base, ledger, USERS)) == [(1, "SE", 1), (3, "SE", 4)]
    assert run_merge(spark, silver_base, ledger, USERS).status == "nothing_to_process"
    stage(spark, base, [user("u", 1, 9, day=2, country="DE"), user("d", 3, 10, day=2)], "r2")
    result = run_merge(spark, silver_base, ledger, USERS)
    assert [(d["event_date"], d["rows_in"], d["rows_out"]) for d in result.dates] == [("2024-01-03", 2, 1)]
    assert state(current_table(spark, silver_base, ledger, USERS)) == [(1, "DE", 9)]
    assert sorted(r["event_date"] for r in ledger.processed_partitions(merge_plan.JOB_NAME, "users").collect()) == [
        "2024-01-01", "2024-01-02", "2024-01-03",
    ]
    assert {r["status"] for r in ledger.view("silver_runs").collect()} == {"SUCCESS"}


def test_late_events(spark, base):
    """``replay`` never looks at a processed date again; ``ordered`` applies what came late, in its place."""
    late = [user("u", 1, 2, country="NO"), user("u", 2, 9, country="NO")]
    for mode, want in (("replay", [(1, "DE", 5), (2, "SE", 3)]), ("ordered", [(1, "DE", 5), (2, "NO", 9)])):
        here = f"{base}/{mode}"
        ledger = Ledger(spark, f"{here}/ledger")
        stage(spark, here, [user("c", 1, 1), user("c", 2, 3), user("u", 1, 5, day=1, country="DE")], "r1")
        run_merge(spark, f"{here}/silver", ledger, USERS, mode=mode, buckets=2)
        stage(spark, here, late, "r2")
        result = run_merge(spark, f"{here}/silver", ledger, USERS, mode=mode)
        assert (result.status == "nothing_to_process") == (mode == "replay")
        assert state(current_table(spark, f"{here}/silver", ledger, USERS)) == want
        if mode == "ordered":
            assert run_merge(spark, f"{here}/silver", ledger, USERS, mode=mode).status == "nothing_to_process"


def test_tombstones_stop_late_events(spark, base):
    ledger = Ledger(spark, f"{base}/ledger")
    stage(spark, base, [user("c", 1, 1), user("d", 1, 5), user("c", 2, 2)], "r1")
    result = run_merge(spark, f"{base}/silver", ledger, USERS, mode="ordered", buckets=2)
    assert result.rows == 1
    stage(spark, base, [user("u", 1, 3)], "r2")
    run_merge(spark, f"{base}/silver", ledger, USERS, mode="ordered")
    assert state(current_table(spark, f"{base}/silver", ledger, USERS)) == [(2, "SE", 2)]


def test_one_date_and_force(spark, base):
    ledger = Ledger(spark, f"{base}/ledger")
    silver_base = f"{base}/silver"
    stage(spark, base, [user("c", 1, 1, country="AA"), user("u", 1, 2, day=1, country="BB")], "r1")
    run_merge(spark, silver_base, ledger, USERS, buckets=2)
    result = run_merge(spark, silver_base, ledger, USERS, only_date="2024-01-01")
    assert [d["event_date"] for d in result.dates] == ["2024-01-01"]
    assert state(current_table(spark, silver_base, ledger, USERS)) == [(1, "AA", 1)], "an old date regresses its keys"
    assert run_merge(spark, silver_base, ledger, USERS, only_date="2030-01-01").status == "nothing_to_process"
    assert len(run_merge(spark, silver_base, ledger, USERS, force=True).dates) == 2
    assert state(current_table(spark, silver_base, ledger, USERS)) == [(1, "BB", 2)]


def test_empty_date_folder_is_marked(spark, base):
    ledger = Ledger(spark, f"{base}/ledger")
    stage(spark, base, [user("c", 1, 1)], "r1")
    os.makedirs(f"{base}/silver/stage_events/table=users/event_date=2024-01-05")
    result = run_merge(spark, f"{base}/silver", ledger, USERS, buckets=2)
    assert [(d["event_date"], d["rows_in"], d["rows_out"]) for d in result.dates] == [("2024-01-01", 1, 1), ("2024-01-05", 0, 1)]
    assert run_merge(spark, f"{base}/silver", ledger, USERS).status == "nothing_to_process"


def test_crash_before_commit(spark, base, monkeypatch):
    """A version without its ledger row is not live, and its dates stay pending."""
    ledger = Ledger(spark, f"{base}/ledger")
    silver_base = f"{base}/silver"
    stage(spark, base, [user("c", 1, 1)], "r1")
    run_merge(spark, silver_base, ledger, USERS, buckets=2)
    stage(spark, base, [user("u", 1, 2, day=1, country="DE")], "r2")
    with monkeypatch.context() as m:
        m.setattr(Ledger, "commit_merge", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            run_merge(spark, silver_base, ledger, USERS)
    assert state(current_table(spark, silver_base, ledger, USERS)) == [(1, "SE", 1)]
    assert ledger.view("silver_runs").where("status = 'FAILED'").count() == 1
    run_merge(spark, silver_base, ledger, USERS)
    assert state(current_table(spark, silver_base, ledger, USERS)) == [(1, "DE", 2)]


def test_all_deleted(spark, base):
    ledger = Ledger(spark, f"{base}/ledger")
    stage(spark, base, [user("c", 1, 1), user("d", 1, 2)], "r1")
    assert run_merge(spark, f"{base}/silver", ledger, USERS, buckets=2).rows == 0
    empty = current_table(spark, f"{base}/silver", ledger, USERS)
    assert empty.count() == 0 and "email" in empty.columns
    stage(spark, base, [user("c", 1, 3, day=1)], "r2")
    assert run_merge(spark, f"{base}/silver", ledger, USERS).rows == 1


def test_current_is_not_shuffled(spark, base):
    """The merge join reads the bucketed current table in place; only the reduced events move."""
    from tidemark.operators.merge import merge_current, merge_stats

    ledger = Ledger(spark, f"{base}/ledger")
    stage(spark, base, [user("c", i, i) for i in range(20)], "r1")
    run_merge(spark, f"{base}/silver", ledger, USERS, buckets=4)
    current = merge_plan.stored_current(spark, f"{base}/silver", ledger, USERS)
    events = silver.read_stage(spark, f"{base}/silver", USERS).drop("run_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (
            merge_current(current, events, "user_id", partitions=4),
            merge_stats(current, events, "user_id", live_before=20, partitions=4),
        ):
            text = df._jdf.queryExecution().executedPlan().toString()
            side = text[: text.index("Bucketed: true")].splitlines()[-6:]
            assert "Bucketed: true" in text
            join = next(i for i, line in enumerate(side) if "SortMergeJoin" in line or "Sort [" in line)
            assert not any("Exchange" in line for line in side[join:])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    files = fs.glob(spark, f"{base}/silver/current/table=users/version=*/part-*")
    assert len(files) == 4, "one file per bucket"


def test_an_overtaken_merge_starts_over(spark, base, monkeypatch):
    """Another merge commits between the read and the commit of the first: no key of either is lost."""
    ledger = Ledger(spark, f"{base}/ledger")
    silver_base = f"{base}/silver"
    stage(spark, base, [user("c", 1, 1), user("c", 2, 2, day=1)], "r1")
    real, other = silver.write_current, []

    def slow(*args):
        if not other:
            other.append(None)
            other[0] = run_merge(spark, silver_base, ledger, USERS, only_date="2024-01-02", buckets=2)
        return real(*args)

    monkeypatch.setattr(silver, "write_current", slow)
    result = run_merge(spark, silver_base, ledger, USERS, only_date="2024-01-01", buckets=2)
    assert other[0].status == result.status == "SUCCESS"
    assert state(current_table(spark, silver_base, ledger, USERS)) == [(1, "SE", 1), (2, "SE", 2)]
    assert len(fs.glob(spark, f"{silver_base}/current/table=users/version=*")) == 2, "what was overtaken is removed"


@pytest.mark.parametrize("mode", ["replay", "ordered"])
def test_date_folders_without_a_run_level(spark, base, mode):
    ledger = Ledger(spark, f"{base}/ledger")
    stage(spark, base, [user("c", 1, 1), user("c", 2, 2, day=1)], "r1")
    rows = silver.read_stage(spark, f"{base}/silver", USERS).drop("run_id")
    rows.write.partitionBy("table", "event_date").parquet(f"{base}/bare/stage_events")
    assert run_merge(spark, f"{base}/bare", ledger, USERS, mode=mode, buckets=2).rows == 2
    assert run_merge(spark, f"{base}/bare", ledger, USERS, mode=mode).status == "nothing_to_process"


def test_stage_without_its_key_is_an_error(spark, base):
    ledger = Ledger(spark, f"{base}/ledger")
    stage(spark, base, [user("c", 1, 1)], "r1")
    rows = silver.read_stage(spark, f"{base}/silver", USERS).drop("user_id", "lsn", "run_id")
    rows.write.partitionBy("table", "event_date").parquet(f"{base}/bare/stage_events")
    with pytest.raises(ValueError, match="user_id"):
        run_merge(spark, f"{base}/bare", ledger, USERS, buckets=2)
    assert ledger.live_version(merge_plan.JOB_NAME, "users") is None
    assert ledger.processed_partitions(merge_plan.JOB_NAME, "users").count() == 0


def test_compaction_keeps_all_columns(spark, base):
    """Runs of different shape, pruned afterwards: no column is lost with the originals."""
    ledger = Ledger(spark, f"{base}/ledger")
    plain = spark.createDataFrame([("t", user("c", 1, 1))], "ingest_ts string, raw_json string")
    plain.write.parquet(run_folder(base, "old"))
    plain.selectExpr("*", "'x' as note", "7 as shard").write.parquet(run_folder(base, "new"))
    for run in ("old", "new"):
        ledger.start_run(run)
        ledger.end_run(run, "SUCCESS")
    compact(spark, f"{base}/bronze", ledger, prune=True)
    rows = spark.read.option("mergeSchema", "true").parquet(f"{base}/bronze/compacted").orderBy("run_id").collect()
    assert [(r.run_id, r.note, r.shard) for r in rows] == [("new", "x", 7), ("old", None, None)]
    plain.select("ingest_ts").write.parquet(run_folder(base, "bad"))
    ledger.start_run("bad")
    ledger.end_run("bad", "SUCCESS")
    with pytest.raises(ValueError, match="raw_json"):
        compact(spark, f"{base}/bronze", ledger)


def test_a_run_compacted_by_another_writer_is_not_doubled(spark, base):
    folder = run_folder(base, "r")
    for name in ("events_00001", "events_compacted"):
        write_events(spark, f"{base}/{name}", [user("c", 1, 1), user("c", 2, 2)])
        os.makedirs(folder, exist_ok=True)
        os.rename(fs.glob(spark, f"{base}/{name}/part-*")[0].removeprefix("file:"), f"{folder}/{name}.parquet")
    ledger = Ledger(spark, f"{base}/ledger")
    open(f"{folder}/_SUCCESS", "w").close()
    # without its mark the other writer's compaction didn't end
    assert bronze.run_parts(spark, folder) == [f"{folder}/events_00001.parquet"]
    open(f"{folder}/_COMPACTED", "w").close()
    assert [r["rows"] for r in compact(spark, f"{base}/bronze", ledger).collect()] == [2]
    assert run_structure(spark, f"{base}/bronze", f"{base}/silver", ledger, [USERS])["users"].stage_rows == 2


def test_empty_runs_do_not_block_and_odd_names_work(spark, base):
    """A run of files without rows, names that need escaping, and a base that looks like a run folder."""
    base = f"{base}/cdc/x"
    ledger = Ledger(spark, f"{base}/ledger")
    odd = "manual__2024-01-01T00:00:00+00:00"
    write_events(spark, run_folder(base, odd), [user("c", 1, 1)])
    write_events(spark, run_folder(base, "none"), [])
    os.makedirs(run_folder(base, "bare"))
    for run in (odd, "none", "bare"):
        ledger.start_run(run, "2024-02-01")
        ledger.end_run(run, "SUCCESS")
    assert [(r["run_id"], r["rows"]) for r in compact(spark, f"{base}/bronze", ledger).collect()] == [(odd, 1)]
    assert ledger.view("compacted_runs").count() == 3
    counts = run_structure(spark, f"{base}/bronze", f"{base}/silver", ledger, [USERS])
    assert counts["users"].stage_rows == 1
    assert run_merge(spark, f"{base}/silver", ledger, USERS, mode="ordered", buckets=2).rows == 1
    assert run_merge(spark, f"{base}/silver", ledger, USERS, mode="ordered").status == "nothing_to_process"
    assert silver.read_quarantine(spark, f"{base}/silver", "users").count() == 0


def test_a_run_with_two_sources(spark, base):
    """Counts are kept apart, and a source that comes later doesn't remove the other's rows."""
    ledger = Ledger(spark, f"{base}/ledger")

    def land(source, texts):
        write_events(spark, bronze.run_path(f"{base}/bronze", source, "users", "2024-02-01", "r"), texts)
        compact(spark, f"{base}/bronze", ledger)
        run_structure(spark, f"{base}/bronze", f"{base}/silver", ledger, [USERS])

    ledger.start_run("r")
    ledger.end_run("r", "SUCCESS")
    land("one", [user("c", 1, 1), user("c", 2, 2), "{"])
    land("two", [user("c", 3, 3)])
    rows = {r["source"]: (r["total"], r["stage_rows"], r["bad_rows"]) for r in ledger.view("structured_runs").collect()}
    assert rows == {"one": (3, 2, 1), "two": (1, 1, 0)}
    assert silver.read_stage(spark, f"{base}/silver", USERS).count() == 3
    assert silver.read_quarantine(spark, f"{base}/silver", "users").count() == 1


def test_input_is_parsed_once(spark, base, monkeypatch):
    """Whatever the share of rejects, events are judged in one write; a second look reads judged rows."""
    from tidemark.plans import structure as structure_plan

    calls, real = [], structure_plan.judge
    monkeypatch.setattr(structure_plan, "judge", lambda *a, **k: calls.append(1) or real(*a, **k))
    write_events(spark, f"{base}/in", [user("c", 1, 1), "{", "[]"])
    counts = structure_file(spark, f"{base}/in", USERS, f"{base}/silver")
    assert (counts.stage_rows, counts.bad_rows, len(calls)) == (1, 2, 1)
    assert not fs.glob(spark, f"{base}/silver/_attempts/*")


def test_jobs_need_the_session_settings(spark, base):
    ledger = Ledger(spark, f"{base}/ledger")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for job in (
            lambda: compact(spark, f"{base}/bronze", ledger),
            lambda: run_structure(spark, f"{base}/bronze", f"{base}/silver", ledger, [USERS]),
            lambda: run_merge(spark, f"{base}/silver", ledger, USERS),
        ):
            with pytest.raises(RuntimeError, match="configure"):
                job()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("mode", ["replay", "ordered"])
def test_a_merge_writes_what_changed(spark, base, monkeypatch, mode):
    """One changed key writes one row; deltas are folded when they get many, and what is unused can be removed."""
    monkeypatch.setattr(merge_plan, "MAX_DELTAS", 3)
    ledger = Ledger(spark, f"{base}/ledger")
    silver_base = f"{base}/silver"
    stage(spark, base, [user("c", i, i) for i in range(1, 41)], "r0")
    run_merge(spark, silver_base, ledger, USERS, mode=mode, buckets=4)
    want = {i: ("SE", i) for i in range(1, 41)}
    parts = []
    for k in range(1, 6):
        op = "d" if k % 2 else "u"
        stage(spark, base, [user(op, k, 100 + k, day=k, country="NO")], f"r{k}")
        assert run_merge(spark, silver_base, ledger, USERS, mode=mode).rows == 40 - (k + 1) // 2
        if op == "d":
            del want[k]
        else:
            want[k] = ("NO", 100 + k)
        live_now = ledger.live_version(merge_plan.JOB_NAME, "users")
        parts.append(len(live_now["parts"]))
        newest = silver.read_current(spark, silver_base, USERS, live_now["parts"][-1], 4)
        assert newest.count() == 1 or parts[-1] == 1
        assert state(current_table(spark, silver_base, ledger, USERS)) == sorted((i, c, n) for i, (c, n) in want.items())
    assert parts == [2, 3, 4, 1, 2]
    assert not merge_plan.retire_versions(spark, silver_base, ledger, USERS), "young parts may be in use"
    gone = merge_plan.retire_versions(spark, silver_base, ledger, USERS, min_age_seconds=0)
    assert len(gone) == 4 and len(silver.stored_parts(spark, silver_base, "users")) == 2
    assert state(current_table(spark, silver_base, ledger, USERS)) == sorted((i, c, n) for i, (c, n) in want.items())


def test_other_buckets_and_modes_make_a_new_base(spark, base):
    ledger = Ledger(spark, f"{base}/ledger")
    silver_base = f"{base}/silver"
    stage(spark, base, [user("c", i, i) for i in range(1, 21)], "r0")
    assert run_merge(spark, silver_base, ledger, USERS).rows == 20
    assert ledger.live_version(merge_plan.JOB_NAME, "users")["buckets"] == merge_plan.LEAST_BUCKETS
    stage(spark, base, [user("d", 1, 50, day=1)], "r1")
    assert run_merge(spark, silver_base, ledger, USERS, buckets=2).rows == 19
    stage(spark, base, [user("d", 2, 60, day=2)], "r2")
    assert run_merge(spark, silver_base, ledger, USERS, mode="ordered").rows == 18
    version = ledger.live_version(merge_plan.JOB_NAME, "users")
    assert (version["buckets"], len(version["parts"]), version["mode"]) == (2, 1, "ordered")
    assert [r[0] for r in state(current_table(spark, silver_base, ledger, USERS))] == list(range(3, 21))


def test_a_merge_overtaken_between_reading_and_committing_loses_nothing(spark, base, monkeypatch):
    """A second merge is forced in between while its commit is not yet published."""
    ledger, silver_base = Ledger(spark, f"{base}/ledger"), f"{base}/silver"
    stage(spark, base, [user("c", 1, 1)], "r0")
    run_merge(spark, silver_base, ledger, USERS, buckets=2)
    stage(spark, base, [user("c", 2, 2, day=1)], "r1")
    real, inner = fs.publish, []

    def between(session, path, to):
        if not inner and "/commit-" in to:
            inner.append(1)
            stage(spark, base, [user("c", 3, 3, day=2)], "r2")
            inner.append(run_merge(spark, silver_base, Ledger(spark, f"{base}/ledger"), USERS, only_date="2024-01-03"))
        return real(session, path, to)

    monkeypatch.setattr(fs, "publish", between)
    assert run_merge(spark, silver_base, ledger, USERS).status == "SUCCESS" and inner[1].status == "SUCCESS"
    assert [r[0] for r in state(current_table(spark, silver_base, ledger, USERS))] == [1, 2, 3]
    assert run_merge(spark, silver_base, ledger, USERS).status == "nothing_to_process"


def test_a_run_structured_again_is_merged_again(spark, base):
    """Its folder keeps its name but has other files."""
    ledger, silver_base = Ledger(spark, f"{base}/ledger"), f"{base}/silver"
    stage(spark, base, [user("c", 1, 1)], "a")
    assert run_merge(spark, silver_base, ledger, USERS, mode="ordered", buckets=2).rows == 1
    stage(spark, base, [user("c", 2, 2)], "a")  # adds to the input and structures all of it again
    result = run_merge(spark, silver_base, ledger, USERS, mode="ordered")
    assert result.rows == 2 and [(d["event_date"], d["stage_run"]) for d in result.dates] == [("2024-01-01", "a")]
    assert run_merge(spark, silver_base, ledger, USERS, mode="ordered").status == "nothing_to_process"


def test_marks_of_an_earlier_release_count(spark, base):
    """They name a stage run but not its files."""
    ledger, silver_base = Ledger(spark, f"{base}/ledger"), f"{base}/silver"
    stage(spark, base, [user("c", 1, 1)], "a")
    old = dict(event_date="2024-01-01", stage_run="a", rows_in=1, rows_out=1, bad_rows=0)
    ledger.commit_merge(1, job_name=merge_plan.JOB_NAME, table_name="users", run_id="m", mode="ordered", dates=[old])
    assert run_merge(spark, silver_base, ledger, USERS, mode="ordered").status == "nothing_to_process"


def test_a_large_run_is_cut(spark, base, monkeypatch):
    """A run that one task reads is brought together by several, in arrival order within each; a small one by one."""
    monkeypatch.setattr(compact_plan, "PIECE_BYTES", 3000)
    monkeypatch.setattr(compact_plan, "PIECE_ROWS", 10)
    ledger = Ledger(spark, f"{base}/ledger")
    for run, n in (("large", 400), ("small", 5)):
        write_events(spark, run_folder(base, run), [user("c", i, i, note=f"{i * 7919 % 10007}" * 9) for i in range(n)])
        ledger.start_run(run, "2024-02-01")
        ledger.end_run(run, "SUCCESS")
    conf = {"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        done = compact(spark, f"{base}/bronze", ledger).orderBy("run_id").collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert [(r["run_id"], r["parts"], r["rows"]) for r in done] == [("large", 1, 400), ("small", 1, 5)]
    files = {run: fs.glob(spark, f"{base}/bronze/compacted/*/*/*/run_id={run}/part-*") for run in ("large", "small")}
    assert len(files["large"]) > 1 and len(files["small"]) == 1
    texts = [[json.loads(r["raw_json"])["payload"]["source"]["lsn"] for r in spark.read.parquet(f).collect()] for f in files["large"]]
    assert all(t == sorted(t) for t in texts) and sorted(sum(texts, [])) == list(range(400))
