"""Fewer, larger files for finished bronze runs; the rows stay the same."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import now_seconds_offset
from tidemark.operators.selection import RUN_KEYS, compaction_stats, eligible_runs
from tidemark.session import check
from tidemark.sources import bronze, fs
from tidemark.sources.ledger import Ledger

log = logging.getLogger(__name__)


# File bytes of a run that are brought together for a task, and rows of a file that stay side by side in a larger run.
PIECE_BYTES, PIECE_ROWS = 16 << 20, 4096


def compact_rows(rows: DataFrame, pieces: DataFrame | None = None) -> DataFrame:
    """Bring the rows of a run together, in arrival order within a file.

    The rebalance sizes its output by bytes: small runs share a task, a run of any size is split over many. It can't split what
    one task has read of a run, which the files' compression lets be many times a file's size: ``pieces`` (run keys, pieces)
    names the runs that are cut into so many parts before.
    """
    order = [c for c in ("batch", "src_file", "src_row") if c in rows.columns]
    if pieces is None:
        return rows.hint("rebalance", *[F.col(c) for c in RUN_KEYS]).sortWithinPartitions(*RUN_KEYS, *order)
    chunk = F.xxhash64("src_path", F.floor(F.col("src_row") / PIECE_ROWS))
    cut = rows.join(F.broadcast(pieces), RUN_KEYS, "left").withColumn("_piece", F.pmod(chunk, F.coalesce("pieces", F.lit(1))))
    spread = cut.drop("pieces").hint("rebalance", *[F.col(c) for c in (*RUN_KEYS, "_piece")])
    return spread.sortWithinPartitions(*RUN_KEYS, *order).drop("_piece")


def _pieces(spark: SparkSession, parts: dict[tuple, list[str]]) -> DataFrame | None:
    """(run keys, pieces) of the runs whose files are too large for one task; None if there are none."""
    sizes = {run: sum(fs.size(spark, p) for p in found) for run, found in parts.items()}
    large = [(*run, -(-size // PIECE_BYTES)) for run, size in sizes.items() if size > PIECE_BYTES]
    return spark.createDataFrame(large, ", ".join(f"`{k}` string" for k in RUN_KEYS) + ", pieces long") if large else None


def compact(
    spark: SparkSession,
    base: str,
    ledger: Ledger,
    *,
    prune: bool = False,
    only_date: str | None = None,
    statuses: Sequence[str] = ("SUCCESS",),
) -> DataFrame:
    """Compact all eligible runs in one job and return their (run, parts, rows).

    The compacted files lie beside the run folders, never among them, so a rerun cannot read its own output.
    A run counts as compacted once its ledger row is written; before that a crash leaves nothing behind that
    the next attempt would not replace. ``prune`` removes the run folders after that. ``statuses`` may add
    FAILED to rescue the complete batches of broken runs.
    """
    check(spark)
    runs = bronze.discover_runs(spark, base, only_date=only_date)
    # A marker file counts for runs of another writer only; of its own runs the ledger knows more.
    known = ledger.view("pipeline_runs").select("run_id", "status")
    finished = known.union(bronze.marked_runs(spark, base, only_date).join(known, "run_id", "left_anti"))
    todo = eligible_runs(runs, finished, ledger.view("compacted_runs"), only_date, statuses)
    # Folder and file names only: a row per run waiting for compaction.
    waiting = [tuple(r[k] for k in RUN_KEYS) for r in todo.select(*RUN_KEYS).collect()]
    parts = {run: bronze.run_parts(spark, bronze.run_path(base, *run)) for run in waiting}
    paths = [p for found in parts.values() for p in found]
    ddl = ", ".join(f"`{k}` string" for k in RUN_KEYS)
    empty = spark.createDataFrame([], f"{ddl}, parts long, rows long")
    if not waiting:
        return empty
    before = empty
    if paths:
        rows = bronze.read_runs(spark, base, paths)
        columns = [c for c in rows.columns if c not in ("batch", "src_path", "src_file", "src_row")]
        target = f"{base.rstrip('/')}/{bronze.COMPACTED}"
        (
            compact_rows(rows, _pieces(spark, parts))
            .select(*[F.col(f"`{c}`") for c in columns])
            .write.partitionBy(*RUN_KEYS)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .parquet(target)
        )
        # Counting reads file footers and folder names, no column data.
        before = compaction_stats(rows)
        written = [p for run in waiting if fs.exists(spark, p := bronze.run_path(base, *run, root=bronze.COMPACTED))]
        after = empty.select(*RUN_KEYS, F.col("rows").alias("_out"))
        if written:
            kept = bronze.read_runs(spark, base, written, bronze.COMPACTED)
            lost = set(columns) - set(kept.columns)
            if lost:
                raise RuntimeError(f"compacted files lack columns {sorted(lost)}")
            after = kept.groupBy(*RUN_KEYS).agg(F.count("*").alias("_out"))
        wrong = before.join(after, RUN_KEYS, "left").where("rows <> coalesce(_out, 0)").limit(1).collect()
        if wrong:
            raise RuntimeError(f"compacted rows differ from the run's: {wrong[0].asDict()}")
    # A run without rows is done as well.
    named = spark.createDataFrame(waiting, ddl)
    none = named.join(before, RUN_KEYS, "left_anti").select(*RUN_KEYS, F.lit(0).alias("parts"), F.lit(0).alias("rows"))
    ledger.append_rows("compacted_runs", before.unionByName(none).withColumn("compacted_at", now_seconds_offset()))
    done = ledger.view("compacted_runs").join(named, RUN_KEYS, "left_semi").where("rows > 0")
    if prune:
        for run in waiting:
            folder = bronze.run_path(base, *run)
            try:
                fs.remove(spark, folder)
            except Exception as error:  # noqa: BLE001 - the run is safe in its compacted form
                log.warning("could not remove %s: %s", folder, error)
    return done.select(*RUN_KEYS, "parts", "rows")
