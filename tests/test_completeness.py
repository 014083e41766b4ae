"""Dates closed by a watermark, late rows, and merges that wait for closed dates."""

from tests.test_jobs import stage, state, user
from tidemark import USERS
from tidemark.plans.merge import current_table, run_merge
from tidemark.sources import silver
from tidemark.sources.ledger import Ledger
from tidemark.streaming.completeness import date_states, track_dates
from workload import queries


def states(spark, base, ledger):
    track_dates(spark, f"{base}/silver", ledger, USERS, checkpoint=f"{base}/cp")
    rows = date_states(spark, f"{base}/silver", ledger, USERS).collect()
    return {r["event_date"][-2:]: (r["state"], r["rows"]) for r in rows}


def test_open_closed_late(spark, base):
    ledger, silver_base = Ledger(spark, f"{base}/ledger"), f"{base}/silver"
    assert states(spark, base, ledger) == {}
    stage(spark, base, [user("c", 1, 1), user("c", 2, 2), user("c", 3, 3, day=1), user("c", 4, 4, day=2)], "a")
    # the newest event is two days behind the start of the first date, the delay one day
    assert states(spark, base, ledger) == {"01": ("closed", 2), "02": ("open", None), "03": ("open", None)}
    result = run_merge(spark, silver_base, ledger, USERS, buckets=2, closed_only=True)
    assert [d["event_date"] for d in result.dates] == ["2024-01-01"] and result.left == ["2024-01-02", "2024-01-03"]
    again = run_merge(spark, silver_base, ledger, USERS, closed_only=True)
    assert again.status == "nothing_to_process" and again.left == result.left
    stage(spark, base, [user("u", 2, 9, country="NO"), user("c", 5, 10, day=4)], "b")
    assert states(spark, base, ledger) == {"01": ("late", 1), "02": ("closed", 1), "03": ("closed", 1), "05": ("open", None)}
    assert states(spark, base, ledger)["01"] == ("late", 1), "nothing new, nothing changes"
    result = run_merge(spark, silver_base, ledger, USERS, closed_only=True)
    assert [d["event_date"] for d in result.dates] == ["2024-01-02", "2024-01-03"]
    assert (result.left, result.late) == (["2024-01-05"], ["2024-01-01"])
    assert state(current_table(spark, silver_base, ledger, USERS)) == [(1, "SE", 1), (2, "SE", 2), (3, "SE", 3), (4, "SE", 4)]
    # the date asked for is applied again and closed
    run_merge(spark, silver_base, ledger, USERS, only_date="2024-01-01")
    assert states(spark, base, ledger)["01"][0] == "closed"
    assert state(current_table(spark, silver_base, ledger, USERS))[1] == (2, "NO", 9)


def test_ordered_merges_apply_late_rows(spark, base):
    ledger, silver_base = Ledger(spark, f"{base}/ledger"), f"{base}/silver"
    stage(spark, base, [user("c", 1, 1), user("c", 2, 5, day=3)], "a")
    states(spark, base, ledger)
    run_merge(spark, silver_base, ledger, USERS, mode="ordered", buckets=2, closed_only=True)
    stage(spark, base, [user("u", 1, 3, country="NO")], "b")
    assert states(spark, base, ledger)["01"][0] == "late"
    result = run_merge(spark, silver_base, ledger, USERS, mode="ordered", closed_only=True)
    assert result.late == ["2024-01-01"] and state(current_table(spark, silver_base, ledger, USERS)) == [(1, "NO", 3)]
    assert states(spark, base, ledger)["01"][0] == "closed"


def test_closed_dates_parses_once(spark, base, monkeypatch):
    """The waves of the query are cut from stage rows written once, not each parsed from the table again."""
    spark.sql(
        "select id event_id, timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id as int)) ts, id % 3 user_id, 'view' event_type, 1D value, '{}' props from range(30)"
    ).write.parquet(f"{base}/events.parquet")
    inputs, write = [], silver.write_stage
    monkeypatch.setattr(silver, "write_stage", lambda rows, to: (inputs.extend(rows.inputFiles()), write(rows, to)))
    monkeypatch.setattr(queries, "work_folder", lambda *_: f"{base}/work")
    got = {r["event_date"]: tuple(r)[1:] for r in queries.registry()["closed_dates"](spark, base).collect()}
    assert inputs and all("/work/events/" in f for f in inputs)
    assert len(got) == 30 and got["2024-01-02"] == ("closed", 1, 1) and got["2024-01-30"] == ("open", None, None)
