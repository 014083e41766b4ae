"""Merge semantics: scenarios, a property test against a plain fold, and the plans at scale."""

import random

import pytest

from tidemark.operators import dedupe, merge

DDL = "op string, lsn long, ts_ms long, event_date string, k long, src_row long"


def frame(spark, rows):
    return spark.createDataFrame(rows, DDL)


def big(value):
    return (value is None, value or 0)


def fold(current, events, mode):
    """Apply events one by one, date by date."""
    current, stats = dict(current), {}
    for date in sorted({e[3] for e in events}):
        seen = {}
        for e in sorted((e for e in events if e[3] == date), key=lambda e: e[5]):
            seen[(e[4], e[1], e[2], e[0])] = e
        order = lambda e: (big(e[1]), big(e[2]), e[5])
        for e in sorted(seen.values(), key=order):
            if e[4] is None:
                continue
            if mode == "replay" and e[0] == "d":
                current.pop(e[4], None)
            elif mode == "replay" or e[4] not in current or order(e) >= order(current[e[4]]):
                current[e[4]] = e
        stats[date] = (len(seen), sum(e[0] != "d" for e in current.values()))
    return current, stats


def stream(n, seed, first_row):
    r, out = random.Random(seed), []
    for i in range(n):
        e = (
            r.choice("curd"), r.choice([None, *range(30)]), r.randint(1, 4), f"2024-01-0{r.randint(1, 4)}",
            r.randint(1, 30) if r.random() > 0.02 else None, first_row + i,
        )
        out.append(e)
        if r.random() < 0.1:
            out.append((*e[:5], first_row + 10000 + i))
    return out


@pytest.mark.parametrize("mode", ["replay", "ordered"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fold(spark, seed, mode):
    first, second = stream(150, seed, 0), stream(100, seed + 50, 50000)
    state1, stats1 = fold({}, first, mode)
    state2, stats2 = fold(state1, second, mode)
    m1 = merge.merge_current(None, frame(spark, first), "k", mode)
    m2 = merge.merge_current(m1, frame(spark, second), "k", mode)
    columns = ["op", "lsn", "ts_ms", "event_date", "k", "src_row"]
    for got, want in ((m1, state1), (m2, state2)):
        assert sorted(map(tuple, got.select(columns).collect()), key=repr) == sorted(want.values(), key=repr)
    for current, events, want in ((None, first, stats1), (m1, second, stats2)):
        rows = merge.merge_stats(current, frame(spark, events), "k", mode).collect()
        assert {r["event_date"]: (r["rows_in"], r["rows_out"]) for r in rows} == want


D1, D2 = "2024-01-01", "2024-01-02"
SCENARIOS = {
    "create, update, delete": ([("c", 1, 1, D1, 1, 0), ("u", 2, 2, D1, 1, 1), ("d", 3, 3, D1, 1, 2)], "replay", []),
    "delete, then create": ([("d", 1, 1, D1, 1, 0), ("c", 2, 2, D1, 1, 1)], "replay", [1]),
    "missing position wins": ([("c", None, 1, D1, 1, 0), ("u", 99, 2, D1, 1, 1)], "replay", [0]),
    "date before position": ([("u", 99, 1, D1, 1, 0), ("u", 1, 2, D2, 1, 1)], "replay", [1]),
    "position before date": ([("u", 99, 1, D1, 1, 0), ("u", 1, 2, D2, 1, 1)], "ordered", [0]),
    "delete of an unknown key": ([("d", 1, 1, D1, 1, 0)], "replay", []),
    "no key": ([("c", 1, 1, D1, None, 0)], "replay", []),
    "tie goes to the later arrival": ([("c", 1, 1, D1, 1, 0), ("u", 1, 1, D1, 1, 1)], "replay", [1]),
}


@pytest.mark.parametrize("name", SCENARIOS)
def test_scenarios(spark, name):
    events, mode, want = SCENARIOS[name]
    got = merge.live(merge.merge_current(None, frame(spark, events), "k", mode))
    assert [r["src_row"] for r in got.collect()] == want


def test_flag_alone_deletes(spark):
    df = spark.sql("SELECT 'u' op, 1L lsn, 1L ts_ms, '2024-01-01' event_date, 1L k, true is_delete")
    assert merge.merge_current(None, df, "k").count() == 0
    df = spark.sql("SELECT 'd' op, 1L lsn, 1L ts_ms, '2024-01-01' event_date, 1L k, false is_delete")
    assert merge.merge_current(None, df, "k").count() == 0


def test_old_date_regresses_only_in_replay(spark):
    whole, old = [("u", 1, 1, D1, 1, 0), ("u", 2, 2, D2, 1, 1)], [("u", 1, 1, D1, 1, 0)]
    for mode, want in (("replay", 0), ("ordered", 1)):
        current = merge.merge_current(None, frame(spark, whole), "k", mode)
        assert merge.merge_current(current, frame(spark, old), "k", mode).first()["src_row"] == want


def test_empty_result_keeps_schema(spark):
    gone = merge.merge_current(None, frame(spark, [("d", 1, 1, D1, 1, 0)]), "k")
    assert gone.count() == 0 and gone.columns == ["op", "lsn", "ts_ms", "event_date", "k", "src_row"]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        merge.merge_current(None, frame(spark, []), "k", "fastest")


def test_dedupe_keeps_last_arrival(spark):
    rows = [("u", None, 1, D1, 1, 0), ("u", None, 1, D1, 1, 5), ("u", None, 1, D2, 1, 2), ("d", None, 1, D1, 1, 3)]
    assert sorted(r["src_row"] for r in dedupe.dedupe_replays(frame(spark, rows), "k").collect()) == [2, 3, 5]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_reduced_before_the_shuffle(spark):
    text = plan(merge.latest_events(frame(spark, stream(50, 1, 0)), "k"))
    assert text.index("Partial") > text.index("Exchange hashpartitioning"), "one row per key and task is shuffled"


def test_hot_key_result(spark):
    """A third of all rows on one key, and many replays of one event."""
    hot = spark.range(30000).selectExpr(
        "'u' op", "id lsn", "id ts_ms", "'2024-01-01' event_date", "if(id % 3 = 0, 1, id) k", "id src_row"
    )
    same = spark.range(10000).selectExpr("'u' op", "7L lsn", "7L ts_ms", "'2024-01-01' event_date", "7L k", "id src_row")
    got = merge.merge_current(None, hot.union(same), "k")
    assert got.where("k = 1").first()["lsn"] == 29997
    stats = merge.merge_stats(None, hot.union(same), "k").first()
    assert (stats["rows_in"], stats["rows_out"]) == (30000, got.count())
