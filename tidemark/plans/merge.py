"""Stage events into versions of the current table.

A version is a base, which holds a row per key, and a few deltas, which hold the last event per key of the merges since.
All are bucketed by key, so reading a version joins them in place. A merge writes one delta, whose size is that of
its events; when deltas get many or large against the base, they are folded into a new base.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import fold, is_removal, latest_events, live, merge_current, merge_stats
from tidemark.operators.selection import pending_dates
from tidemark.session import check
from tidemark.sources import fs, silver
from tidemark.sources.ledger import Ledger, merged_date
from tidemark.specs import EntitySpec
from tidemark.streaming.completeness import LATE, OPEN, date_states, reclose

JOB_NAME = "merge_current"
# Stage bytes for each bucket of a new table, and the fewest buckets.
BUCKET_BYTES, LEAST_BUCKETS = 128 << 20, 8
# Deltas of a version, and their rows against those of the base, from which on they are folded.
MAX_DELTAS, FOLD_SHARE = 8, 0.25
# Times a merge starts over because another one was committed before it.
ATTEMPTS = 20
NOTHING = "nothing_to_process"  # fixed: the status that callers compare with


@dataclass(frozen=True)
class MergeResult:
    run_id: str
    status: str
    version: str | None = None
    # None where no statistics were asked for
    rows: int | None = 0
    # event_date, stage_run, rows_in, rows_out, bad_rows
    dates: list[dict] = field(default_factory=list)
    # with ``closed_only``: dates left for later since they are open, and dates with rows that came after they were closed
    left: list[str] = field(default_factory=list)
    late: list[str] = field(default_factory=list)


def current_table(spark: SparkSession, silver_base: str, ledger: Ledger, spec: EntitySpec) -> DataFrame:
    """Live rows of the current table: one row per key."""
    stored = stored_current(spark, silver_base, ledger, spec)
    return live(spark.createDataFrame([], silver.stage_schema(spec)) if stored is None else stored)


def stored_current(spark: SparkSession, silver_base: str, ledger: Ledger, spec: EntitySpec) -> DataFrame | None:
    """Rows of the live version, tombstones included; None before the first merge."""
    return _read_version(spark, silver_base, spec, ledger.live_version(JOB_NAME, spec.table))


def _read_version(spark: SparkSession, silver_base: str, spec: EntitySpec, version: dict | None) -> DataFrame | None:
    if version is None:
        return None
    base, *deltas = [silver.read_current(spark, silver_base, spec, p, version["buckets"]) for p in version["parts"]]
    return reduce(lambda current, events: fold(current, events, spec.pk, version["mode"]), deltas, base)


def retire_versions(
    spark: SparkSession, silver_base: str, ledger: Ledger, spec: EntitySpec, *, keep: int = 1, min_age_seconds: float = 86400
) -> list[str]:
    """Remove parts that none of the last ``keep`` versions uses and that are older than any merge or reader at work."""
    used = {p for v in ledger.versions(JOB_NAME, spec.table, keep) for p in v["parts"]}
    gone = []
    for part in silver.stored_parts(spark, silver_base, spec.table):
        path = silver.version_path(silver_base, spec.table, part)
        if part not in used and fs.age_seconds(spark, path) >= min_age_seconds:
            fs.remove(spark, path)
            gone.append(part)
    return gone


def _new_buckets(stage: DataFrame) -> int:
    """Buckets of a new table: by the size of what is merged first, as far as it comes from files."""
    size = sum(fs.size(stage.sparkSession, f) for f in {f.rsplit("/", 1)[0] for f in stage.inputFiles()})
    return max(LEAST_BUCKETS, 1 << (size // BUCKET_BYTES).bit_length())


def _pending(spark, silver_base, ledger, spec, mode, only_date, force) -> DataFrame:
    """(event_date, run_id, attempt) of stage folders to apply. ``replay`` finishes a date for good; ``ordered`` looks at
    the files of every stage run of a date, so events that arrive late are applied too, also into a run merged before."""
    parts = silver.stage_partitions(spark, silver_base, spec.table, only_date)
    processed = ledger.processed_partitions(JOB_NAME, spec.table)
    if mode == "replay" or only_date is not None or force:
        dates = pending_dates(parts, processed, only_date, force)
        return parts.join(dates, "event_date", "left_semi")
    done = processed.select("event_date", F.col("stage_run").alias("run_id"), "attempt")
    same = parts["run_id"].eqNullSafe(done["run_id"]) & (parts["event_date"] == done["event_date"])
    # a merge of before attempts were noted stands for any
    same &= done["attempt"].isNull() | (parts["attempt"] == done["attempt"])
    return parts.join(done, same, "left_anti")


def run_merge(
    spark: SparkSession,
    silver_base: str,
    ledger: Ledger,
    spec: EntitySpec,
    *,
    mode: str = "replay",
    only_date: str | None = None,
    force: bool = False,
    buckets: int | None = None,
    run_id: str | None = None,
    stats: bool = True,
    foreign: bool = False,
    closed_only: bool = False,
) -> MergeResult:
    """Apply pending stage events and make the result the live version. ``foreign``: stage files of another tool.

    ``closed_only`` leaves dates pending that ``streaming.completeness`` has not closed, since a ``replay`` merge would not look
    at them again. The result names these, and late dates: ``replay`` leaves what came late to ``only_date``,
    ``ordered`` applies it and closes the date again.

    The new version is written first; one ledger row then makes it live together with the dates it covers. A
    crash before that row leaves the old version live and the dates pending.
    """
    check(spark)
    run_id = run_id or uuid.uuid4().hex
    ledger.start_silver_run(run_id, JOB_NAME, spec.table)
    try:
        for attempt in range(ATTEMPTS):
            pending = [
                (r["event_date"], r["run_id"], r["attempt"])
                for r in _pending(spark, silver_base, ledger, spec, mode, only_date, force).collect()
            ]
            left, late = [], []
            if closed_only:
                states = {r["event_date"]: r["state"] for r in date_states(spark, silver_base, ledger, spec).collect()}
                late = sorted(d for d, state in states.items() if state == LATE)
                left = sorted({d for d, _, _ in pending if states.get(d, OPEN) == OPEN})
                pending = [p for p in pending if p[0] not in left]
            if not pending:
                ledger.end_silver_run(run_id, "SUCCESS", {"message": NOTHING})
                return MergeResult(run_id, NOTHING, left=left, late=late)
            dates = sorted({d for d, _, _ in pending})
            if mode == "replay" or only_date is not None or force:
                stage = silver.read_stage(spark, silver_base, spec, dates=dates, foreign=foreign)
            else:
                stage = silver.read_stage(spark, silver_base, spec, partitions=[p[:2] for p in pending], foreign=foreign)
            result = apply_stage(
                spark,
                silver_base,
                ledger,
                spec,
                stage.drop("run_id"),
                run_id=run_id,
                version=f"{run_id}-{attempt}" if attempt else run_id,
                mode=mode,
                buckets=buckets,
                dates=dates,
                stage_runs=None if mode == "replay" else pending,
                stats=stats,
            )
            if result is not None:
                if mode == "ordered" or only_date is not None:
                    reclose(ledger, spec, dates)
                ledger.end_silver_run(run_id, "SUCCESS", {"version": result.version, "processed_dates": dates})
                return replace(result, left=left, late=late)
        raise RuntimeError(f"merge of {spec.table} was overtaken {ATTEMPTS} times")
    except Exception as error:
        ledger.end_silver_run(run_id, "FAILED", {"error": str(error)})
        raise


def apply_stage(
    spark: SparkSession,
    silver_base: str,
    ledger: Ledger,
    spec: EntitySpec,
    stage: DataFrame,
    *,
    run_id: str,
    version: str | None = None,
    mode: str = "replay",
    buckets: int | None = None,
    dates: list[str] | None = None,
    stage_runs: list[tuple] | None = None,
    stats: bool = True,
) -> MergeResult | None:
    """Fold a stage frame into the live version, write the next one, commit it.

    None if another merge was committed meanwhile: what was written lacks its rows and is removed again.
    """
    check(spark)
    version = version or run_id
    number = ledger.last_number(JOB_NAME, spec.table) + 1
    before = ledger.live_version(JOB_NAME, spec.table)
    if buckets is None:
        buckets = before["buckets"] if before else _new_buckets(stage)
    current = _read_version(spark, silver_base, spec, before)
    parts, delta_rows, base_rows = [version], 0, None
    if before and (before["mode"], before["buckets"]) == (mode, buckets):
        delta = latest_events(stage, spec.pk, mode).repartition(buckets, spec.pk)
        silver.write_current(delta, silver_base, spec, version, buckets)
        events = silver.read_current(spark, silver_base, spec, version, buckets, delta.schema)
        delta_rows, base_rows = before["delta_rows"] + events.count(), before["base_rows"]
        parts = [*before["parts"], version]
        after = fold(current, events, spec.pk, mode)
        if len(parts) > MAX_DELTAS + 1 or delta_rows > FOLD_SHARE * base_rows:
            # the delta has done its work once the new base stands
            silver.write_current(after, silver_base, spec, f"{version}-base", buckets)
            fs.remove(spark, silver.version_path(silver_base, spec.table, version))
            parts, delta_rows, base_rows = [f"{version}-base"], 0, None
    else:
        start = live(current) if before and before["mode"] == "ordered" and mode == "replay" else current
        after = merge_current(start, stage, spec.pk, mode, partitions=buckets)
        silver.write_current(after, silver_base, spec, version, buckets)
    if base_rows is None:
        after = silver.read_current(spark, silver_base, spec, parts[0], buckets, after.schema)
        base_rows = after.count()
    rows, gone = None, None
    if stats:
        # Of the parts only keys, order and deletions are read.
        counted = after.agg(F.count("*").alias("n"), F.count_if(is_removal(after)).alias("gone")).first()
        rows, gone = counted["n"] - counted["gone"], counted["gone"]

    per_date: dict[str, tuple] = {}
    if stats:
        # One row per event date.
        live_before = before["rows"] if before else 0
        daily = merge_stats(current, stage, spec.pk, mode, live_before=live_before, partitions=buckets)
        for r in daily.orderBy("event_date").collect():
            per_date[r["event_date"]] = (r["rows_in"], r["rows_out"], r["bad_rows"])
    rows_out, marks = (before["rows"] if before else 0) or 0, []
    runs_of: dict[str, list] = {}
    for d, *run in stage_runs or []:
        runs_of.setdefault(d, []).append(run)
    for d in dates if dates is not None else sorted(per_date):
        rows_in, rows_out, bad = per_date.get(d, (0, rows_out, 0))
        for stage_run, attempt in runs_of.get(d, [(None, None)]):
            marks.append(merged_date(d, stage_run, rows_in, rows_out, bad, attempt))
    committed = ledger.commit_merge(
        number,
        job_name=JOB_NAME,
        table_name=spec.table,
        run_id=run_id,
        mode=mode,
        version=version,
        buckets=buckets,
        rows=rows,
        tombstones=gone,
        parts=parts,
        base_rows=base_rows,
        delta_rows=delta_rows,
        dates=marks,
    )
    if not committed:
        fs.remove(spark, silver.version_path(silver_base, spec.table, parts[-1]))
        return None
    return MergeResult(run_id, "SUCCESS", version, rows, marks)
