"""Bronze runs to stage tables and quarantine."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import now_seconds_offset
from tidemark.operators.selection import RUN_KEYS
from tidemark.operators.structure import judge, split_rows
from tidemark.session import check
from tidemark.sources import bronze, fs, silver
from tidemark.sources.ledger import Ledger
from tidemark.specs import EntitySpec

# Where an attempt writes judged rows before they are put in place.
ATTEMPTS_FOLDER = "_attempts"

@dataclass(frozen=True)
class StageCounts:
    stage_rows: int = 0
    bad_rows: int = 0

    @property
    def total(self) -> int:
        return self.stage_rows + self.bad_rows

    def __add__(self, other: StageCounts) -> StageCounts:
        return StageCounts(self.stage_rows + other.stage_rows, self.bad_rows + other.bad_rows)


def structure_events(
    events: DataFrame,
    spec: EntitySpec,
    silver_base: str,
    *,
    run_ids: Sequence[str] | None = None,
    keep_raw_json: bool = False,
    strict_ops: bool = False,
    keep_rejected_json: bool = False,
    spread: bool = True,
) -> dict[tuple[str | None, str], StageCounts]:
    """Write the events of one table to stage and quarantine; return the counts per (source, run).

    ``events``: (ingest_ts, raw_json, run_id), optionally source, and the file and row they come from. ``run_id``
    names the output folders, so structuring the same run again replaces its rows: give all sources of a run at once.

    Events are read and parsed once, whatever the share of rejects: good and bad ones are written side by side into
    a folder of this attempt, and copied from there, narrow and already judged, to where they belong. Counts are
    those of the written rows.
    """
    spark = events.sparkSession
    check(spark)
    if "source" not in events.columns:
        events = events.withColumn("source", F.lit(None).cast("string"))
    judged = judge(events, [spec], expected_table=spec.table, strict_ops=strict_ops)
    # the two kinds of row differ, so each is a struct that is null for the other
    shaped = split_rows(judged, spec, keep_raw_json, keep_rejected_json)
    attempt = f"{silver_base.rstrip('/')}/{ATTEMPTS_FOLDER}/{uuid.uuid4().hex}"
    shaped.write.partitionBy("kind").parquet(attempt)
    try:
        if not fs.glob(spark, f"{attempt}/kind=*"):
            found, counts = None, []
        else:
            found = spark.read.schema(shaped.schema).parquet(attempt)
            # kinds and two narrow columns are read
            counts = found.groupBy("source", "run_id").agg(
                F.count_if(F.col("kind") == "stage").alias("stage_rows"), F.count_if(F.col("kind") == "bad").alias("bad_rows")
            ).collect()
        if run_ids is None:
            run_ids = sorted({r["run_id"] for r in counts})
        silver.clear_run(spark, silver_base, spec.table, run_ids)
        if any(r["stage_rows"] for r in counts):
            stage = found.where("kind = 'stage'").select("stage.*", "run_id")
            silver.write_stage(stage, silver_base, spread=spread)
        if any(r["bad_rows"] for r in counts):
            rejected = found.where("kind = 'bad'").select("bad.*", "run_id")
            silver.write_quarantine(rejected.withColumn("target_table", F.lit(spec.table)), silver_base)
    finally:
        fs.remove(spark, attempt)
    return {(r["source"], r["run_id"]): StageCounts(r["stage_rows"], r["bad_rows"]) for r in counts}


def structure_file(
    spark: SparkSession, path: str, spec: EntitySpec, silver_base: str, *, run_id: str = "manual", **options
) -> StageCounts:
    """Structure one event file (or folder) of one table."""
    events = bronze.read_events(spark, path).withColumn("run_id", F.lit(run_id))
    found = structure_events(events, spec, silver_base, run_ids=[run_id], **options)
    return found.get((None, run_id), StageCounts())


def run_structure(
    spark: SparkSession,
    bronze_base: str,
    silver_base: str,
    ledger: Ledger,
    specs: Sequence[EntitySpec],
    *,
    force: bool = False,
    **options,
) -> dict[str, StageCounts]:
    """Structure every compacted run not structured yet, one job per table over that table's folders."""
    check(spark)
    compacted = ledger.view("compacted_runs").where(F.col("table").isin(*[s.table for s in specs])).select(*RUN_KEYS)
    waiting = compacted
    if not force:
        waiting = compacted.join(ledger.view("structured_runs").select(*RUN_KEYS), RUN_KEYS, "left_anti")
    # A stage folder holds a run whatever its sources: all of them are written together, also if one came later.
    together = compacted.join(waiting.select("table", "run_id").distinct(), ["table", "run_id"], "left_semi")
    # Folder names only: one row per run waiting.
    todo = [r.asDict() for r in together.collect()]
    counts = {}
    for spec in specs:
        runs = [r for r in todo if r["table"] == spec.table]
        if not runs:
            continue
        folders = [bronze.run_path(bronze_base, *[r[k] for k in RUN_KEYS], root=bronze.COMPACTED) for r in runs]
        folders = [f for f in folders if fs.exists(spark, f)]
        per_run = {}
        if folders:
            events = bronze.read_runs(spark, bronze_base, folders, bronze.COMPACTED)
            events = events.select("ingest_ts", "raw_json", "source", "run_id", "src_file", "src_row")
            per_run = structure_events(events, spec, silver_base, run_ids=[r["run_id"] for r in runs], **options)
        done = []
        for r in runs:
            n = per_run.get((r["source"], r["run_id"]), StageCounts())
            done.append((*[r[k] for k in RUN_KEYS], n.total, n.stage_rows, n.bad_rows))
        keys = ", ".join(f"`{k}` string" for k in RUN_KEYS)
        rows = spark.createDataFrame(done, f"{keys}, total long, stage_rows long, bad_rows long")
        ledger.append_rows("structured_runs", rows.withColumn("structured_at", now_seconds_offset()))
        counts[spec.table] = sum(per_run.values(), StageCounts())
    return counts
