"""Change records from a stream to bronze run folders."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.times import now_seconds_z
from tidemark.functions.topics import in_table_list
from tidemark.operators.envelope import wrap_kafka
from tidemark.operators.selection import RUN_KEYS, last_offsets, run_files, run_manifest
from tidemark.session import check
from tidemark.sources import bronze, fs
from tidemark.sources.ledger import Ledger

MANIFESTS = "manifests"


def land_batch(
    records: DataFrame,
    base: str,
    *,
    run_id: str,
    ingestion_date: str,
    batch_id: int,
    max_records_per_file: int,
    tables: Sequence[str] | None = None,
) -> None:
    """Write one batch of records below its run folders.

    No shuffle: a stream partition holds one topic, so its task writes one folder. The batch number is a folder
    of its own and is replaced as a whole, so a batch delivered again within its run is not stored twice.
    """
    if tables:
        records = records.where(in_table_list(F.col("topic"), list(tables)))
    folder = {"ingestion_date": ingestion_date, "run_id": run_id, "batch": f"{batch_id:09d}"}
    rows = wrap_kafka(records).withColumn("ingest_ts", now_seconds_z())
    (
        rows.withColumns({name: F.lit(value) for name, value in folder.items()})
        .write.partitionBy(*RUN_KEYS, "batch")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .parquet(f"{base.rstrip('/')}/{bronze.RUNS}")
    )


def batch_rows(spark: SparkSession, base: str, ingestion_date: str, run_id: str, batch: str = "*") -> DataFrame | None:
    """Landed rows of a run or of one of its batches; only that run's folders are listed."""
    pattern = f"{bronze.run_path(base, '*', '*', ingestion_date, run_id)}/batch={batch}"
    folders = fs.glob(spark, pattern)
    return bronze.read_runs(spark, base, folders) if folders else None


@dataclass
class IngestRun:
    """A running ingest. ``finish`` waits for it (or stops it), then records how it ended."""

    spark: SparkSession
    query: StreamingQuery
    base: str
    ledger: Ledger
    run_id: str
    ingestion_date: str
    group_id: str | None
    topics: Sequence[str] = field(default_factory=list)

    def stop(self, drain: bool = False) -> str:
        """Graceful stop. A batch cut short leaves no files and is read again by the next run; ``drain`` first
        lands everything the source holds."""
        if self.query.isActive:
            if drain:
                self.query.processAllAvailable()
            self.query.stop()
        return self.finish()

    def finish(self, timeout: float | None = None) -> str:
        """Wait for the end and record SUCCESS, or FAILED with the error. A run that goes on after ``timeout``
        seconds stays STARTED, which is returned."""
        error = None
        try:
            if timeout is None:
                self.query.awaitTermination()
            elif not self.query.awaitTermination(timeout):
                return "STARTED"
        except Exception as failure:  # noqa: BLE001 - the outcome is recorded and returned
            error = str(failure)
        return close_run(
            self.spark, self.base, self.ledger, self.run_id, self.ingestion_date,
            group_id=self.group_id, topics=self.topics, error=error,
        )


def close_run(
    spark: SparkSession,
    base: str,
    ledger: Ledger,
    run_id: str,
    ingestion_date: str,
    *,
    group_id: str | None = None,
    topics: Sequence[str] = (),
    error: str | None = None,
) -> str:
    """Write the manifest of a run and its final ledger row. Only a SUCCESS run is compacted later."""
    status = "SUCCESS" if error is None else "FAILED"
    rows = batch_rows(spark, base, ingestion_date, run_id)
    if rows is not None:
        out = f"{base.rstrip('/')}/{MANIFESTS}/{fs.folder('run_id', run_id)}"
        facts = dict(run_id=run_id, ingestion_date=ingestion_date, status=status, group_id=group_id, topics=topics)
        run_manifest(rows, **facts, error=error).coalesce(1).write.mode("overwrite").json(f"{out}/summary")
        run_files(rows).write.mode("overwrite").json(f"{out}/files")
    ledger.end_run(run_id, status, {"message": "ended by itself or was stopped"} if error is None else {"error": error})
    return status


def ingest(
    stream: DataFrame,
    base: str,
    ledger: Ledger,
    *,
    checkpoint: str,
    topics: Sequence[str] = (),
    tables: Sequence[str] | None = None,
    group_id: str | None = None,
    run_id: str | None = None,
    ingestion_date: str | None = None,
    max_records_per_file: int = 1_000_000,
    flush_seconds: int = 5,
    available_now: bool = False,
) -> IngestRun:
    """Start landing a stream of Kafka-shaped records.

    Positions are kept by the stream's ``checkpoint``; the ledger repeats them for inspection after the files of
    a batch are written. Restarting with the same checkpoint continues behind the last complete batch. With
    the same ``run_id`` a batch that broke half-way is replaced; with a new one its rows may be stored twice, in
    the old run and the new: ``operators.offsets`` finds them, and the merge removes replays.

    A run belongs to the checkpoint it was started with, whose batch numbers name its folders. It can be gone on with
    until it ends well or its rows are compacted.
    """
    spark = stream.sparkSession
    check(spark)
    run_id = run_id or uuid.uuid4().hex
    known = ledger.get_run(run_id)
    place = checkpoint.rstrip("/")
    if known is None:
        ingestion_date = ingestion_date or datetime.now(timezone.utc).strftime("%Y-%m-%d")
        ledger.start_run(run_id, ingestion_date, place)
    else:
        # nothing would look at the folder of a compacted run again
        if known.status == "SUCCESS" or ledger.is_compacted(run_id):
            raise ValueError(f"run {run_id!r} has ended or is compacted; land into a new one")
        # batches of another checkpoint have the same numbers and would replace those that are there
        if known.checkpoint != place:
            raise ValueError(f"run {run_id!r} was started with the checkpoint {known.checkpoint}, not {place}; land into a new one")
        ingestion_date = known.ingestion_date or ingestion_date
        if known.status != "STARTED":
            ledger.reopen_run(known)

    def land(batch: DataFrame, batch_id: int) -> None:
        land_batch(
            batch,
            base,
            run_id=run_id,
            ingestion_date=ingestion_date,
            batch_id=batch_id,
            max_records_per_file=max_records_per_file,
            tables=tables,
        )
        # Read back three narrow columns of the new files instead of fetching the records again.
        rows = batch_rows(spark, base, ingestion_date, run_id, f"{batch_id:09d}")
        if rows is not None:
            ledger.upsert_checkpoints(last_offsets(rows))

    trigger = {"availableNow": True} if available_now else {"processingTime": f"{flush_seconds} seconds"}
    query = (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .queryName(f"ingest-{run_id}")
        .start()
    )
    return IngestRun(spark, query, base, ledger, run_id, ingestion_date, group_id, list(topics))
