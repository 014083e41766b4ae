"""What is still to do: runs, dates and offsets compared with the ledger.

Ledger frames hold a row per run, date or stream partition. No broadcast is forced: their size is known to the
optimizer, which broadcasts them while they are small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RUN_KEYS = ["source", "table", "ingestion_date", "run_id"]


def eligible_runs(
    runs: DataFrame,
    pipeline_runs: DataFrame,
    compacted: DataFrame,
    only_date: str | None = None,
    statuses: Sequence[str] = ("SUCCESS",),
) -> DataFrame:
    """Run folders to compact: finished with one of ``statuses``, not compacted yet, of the date if given."""
    finished = pipeline_runs.where(F.col("status").isin(*statuses)).select("run_id")
    pending = runs if only_date is None else runs.where(F.col("ingestion_date") == only_date)
    return pending.join(finished, "run_id", "left_semi").join(compacted.select(*RUN_KEYS), RUN_KEYS, "left_anti")


def pending_dates(
    stage_dates: DataFrame,
    processed: DataFrame,
    only_date: str | None = None,
    force: bool = False,
) -> DataFrame:
    """Event dates to merge: the one asked for, all of them when forced, else those not processed yet."""
    dates = stage_dates.select("event_date").distinct()
    if only_date is not None:
        return dates.where(F.col("event_date") == only_date)
    if force:
        return dates
    return dates.join(processed.select("event_date"), "event_date", "left_anti")


def last_offsets(records: DataFrame) -> DataFrame:
    """Highest offset per stream partition, the position a run has reached."""
    return records.groupBy("topic", "partition").agg(F.max("offset").alias("last_committed_offset"))


def resume_after(records: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Records behind the committed position; a partition without a position starts at its beginning."""
    position = checkpoints.select("topic", "partition", F.col("last_committed_offset").alias("_last"))
    return (
        records.join(position, ["topic", "partition"], "left")
        .where(F.col("offset") > F.coalesce("_last", F.lit(-1)))
        .select(*records.columns)
    )


def starting_offsets(checkpoints: DataFrame) -> DataFrame:
    """One row holding the ``startingOffsets`` JSON of a Kafka source: next offset per stream partition."""
    entry = F.struct(F.col("partition").cast("string"), F.col("last_committed_offset") + 1)
    per_topic = checkpoints.groupBy("topic").agg(F.map_from_entries(F.collect_list(entry)).alias("next"))
    topics = F.map_from_entries(F.collect_list(F.struct("topic", "next")))
    return per_topic.agg(F.to_json(topics).alias("starting_offsets"))


def touched_tables(rows: DataFrame) -> DataFrame:
    """The (source, table) pairs a run wrote to."""
    return rows.select("source", "table").distinct()


def run_manifest(
    rows: DataFrame,
    *,
    run_id: str,
    ingestion_date: str,
    status: str,
    group_id: str | None,
    topics: Sequence[str],
    error: str | None = None,
) -> DataFrame:
    """One row per touched (source, table): run facts, topics, last offsets and the number of files.

    ``rows`` are the run's bronze rows with source, table, topic, partition, offset and, where read from files,
    src_file. The offsets are those of the whole run, as nested maps; their size is the number of stream
    partitions. The files themselves are a table of their own (:func:`run_files`), one row each, since their
    number grows with the run.
    """
    file = F.col("src_file") if "src_file" in rows.columns else F.lit(None).cast("string")
    per_partition = rows.groupBy("source", "table", "topic", "partition", file.alias("file")).agg(
        F.max("offset").alias("offset"), F.count("*").alias("n")
    )
    touched = per_partition.groupBy("source", "table").agg(
        F.sum("n").alias("rows"), F.count_distinct("file").alias("n_files")
    )
    offsets = per_partition.groupBy("topic", "partition").agg(F.max("offset").alias("offset"))
    per_topic = offsets.groupBy("topic").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("partition").cast("string"), "offset"))).alias("next")
    )
    last = per_topic.agg(F.map_from_entries(F.collect_list(F.struct("topic", "next"))).alias("last_offsets"))
    return touched.select(
        "source",
        "table",
        F.lit(run_id).alias("run_id"),
        F.lit(ingestion_date).alias("ingestion_date"),
        F.lit(status).alias("status"),
        F.lit(group_id).cast("string").alias("kafka_group_id"),
        F.array(*[F.lit(t) for t in topics]).cast("array<string>").alias("topics"),
        "n_files",
        "rows",
        last.scalar().alias("last_offsets"),
        F.lit(error).cast("string").alias("error"),
    )


def run_files(rows: DataFrame) -> DataFrame:
    """One row per file of a run: its path where known, rows and offset range."""
    path = F.col("src_path") if "src_path" in rows.columns else F.lit(None).cast("string")
    return rows.groupBy("source", "table", "run_id", "src_file", path.alias("path")).agg(
        F.count("*").alias("rows"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")
    )


def compaction_stats(rows: DataFrame) -> DataFrame:
    """Files and rows per run; ``rows`` carry the run columns and src_file."""
    return rows.groupBy(*RUN_KEYS).agg(F.count_distinct("src_file").alias("parts"), F.count("*").alias("rows"))
