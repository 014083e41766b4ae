"""What ran, how far, and what is live: append-only tables with a latest-row-per-key view.

Every change is one JSON-lines file, or a folder of them, that appears as a whole; nothing is updated in place, and any
number of drivers can write. A reader sees the newest row per key. Once a table has collected many small files, one driver, holding
a claim, repeats its view in one file; the old ones are removed by a later tidying, when no reader can still be
using them.

Merges are different, since a merge builds on the version before it: each is a numbered file that is only created if
no other merge took that number, so that a writer learns that it was overtaken.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import now_seconds_offset
from tidemark.operators.dedupe import latest
from tidemark.sources import fs

# Columns and key per table; names are fixed by what is kept in them. seq orders the rows of a key.
TABLES: dict[str, tuple[str, list[str]]] = {
    "pipeline_runs": (
        "run_id string, start_time string, end_time string, status string, details map<string, string>, "
        "ingestion_date string, checkpoint string",
        ["run_id"],
    ),
    "cdc_checkpoints": (
        "topic string, `partition` int, last_committed_offset bigint, updated_at string",
        ["topic", "partition"],
    ),
    "compacted_runs": (
        "source string, `table` string, ingestion_date string, run_id string, parts bigint, rows bigint, "
        "compacted_at string",
        ["source", "table", "ingestion_date", "run_id"],
    ),
    "structured_runs": (
        "source string, `table` string, ingestion_date string, run_id string, total bigint, stage_rows bigint, "
        "bad_rows bigint, structured_at string",
        ["source", "table", "ingestion_date", "run_id"],
    ),
    "event_dates": (
        "table_name string, event_date string, state string, rows bigint, changed_at string",
        ["table_name", "event_date"],
    ),
    "silver_runs": (
        "run_id string, job_name string, table_name string, start_time string, end_time string, status string, "
        "details map<string, string>",
        ["run_id"],
    ),
}
# One row per merge: the version it made live and the dates it applied become visible together.
MERGES = (
    "job_name string, table_name string, run_id string, mode string, version string, buckets int, rows bigint, "
    "tombstones bigint, parts array<string>, base_rows bigint, delta_rows bigint, processed_at string, "
    "dates array<struct<event_date string, stage_run string, rows_in bigint, rows_out bigint, bad_rows bigint, attempt string>>"
)

# Files of a table from which on it is tidied, and seconds for which a reader may use files it has listed.
MAX_FILES, GRACE_SECONDS = 40, 3600


class Ledger:
    """The ledger tables below one folder."""

    def __init__(self, spark: SparkSession, base: str) -> None:
        self.spark = spark
        self.base = base.rstrip("/")
        # Start rows of runs opened here, so that closing one need not look it up.
        self._open: dict[str, dict] = {}

    def _path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def _files(self, table: str) -> list[str]:
        return fs.glob(self.spark, f"{self._path(table)}/part-*")

    def _log(self, table: str) -> DataFrame:
        ddl = f"{TABLES[table][0]}, seq bigint"
        files = self._files(table)
        if not files:
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).json(files)

    def view(self, table: str) -> DataFrame:
        """Newest row per key."""
        return latest(self._log(table), TABLES[table][1], [F.col("seq").desc()]).drop("seq")

    def _newest(self, table: str, at: Column) -> Row | None:
        """The newest row of one key."""
        return self._log(table).where(at).orderBy(F.col("seq").desc()).drop("seq").first()

    def now(self) -> str:
        """UTC time in seconds, the stamp of ledger rows."""
        return self.spark.range(1).select(now_seconds_offset()).first()[0]

    def append(self, table: str, **values) -> None:
        """Append one row."""
        unknown = set(values) - set(self._schema(table).names)
        if unknown:
            raise ValueError(f"{table} has no columns {sorted(unknown)}")
        self._write(table, [values])

    def append_rows(self, table: str, rows: DataFrame) -> None:
        """Append a frame that has the table's key: a row per run or stream partition, all seen at once. A column that it
        lacks is null, as with ``append``; of a key's rows the last one counts."""
        have, keys = {c.lower() for c in rows.columns}, TABLES[table][1]
        columns = [
            (F.col(f.name) if f.name in have or f.name in keys else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in self._schema(table).fields
        ]
        placed = rows.select(*columns).withColumn("_at", F.monotonically_increasing_id())
        last = latest(placed, keys, [F.col("_at").desc()]).drop("_at")
        if self._put_rows(table, last.withColumn("seq", F.lit(time.time_ns()))):
            self._tidy(table)

    def _schema(self, table: str) -> T.StructType:
        return T.StructType.fromDDL(TABLES[table][0])

    def _write(self, table: str, rows: list[dict]) -> None:
        if rows:
            self._put(table, [{**row, "seq": time.time_ns()} for row in rows])
            self._tidy(table)

    def _put(self, table: str, rows: list[dict]) -> None:
        lines = (json.dumps({k: v for k, v in row.items() if v is not None}, ensure_ascii=False) for row in rows)
        fs.write_text(self.spark, self._path(table), f"part-{uuid.uuid4().hex}.json", "\n".join(lines) + "\n")

    def _put_rows(self, table: str, rows: DataFrame) -> bool:
        """Write a frame that has a seq as a folder of files, by its tasks, and give it its name once it is whole. False
        if there are no rows."""
        name = f"part-{uuid.uuid4().hex}"
        hidden = f"{self._path(table)}/_{name}"
        try:
            rows.write.option("ignoreNullFields", "true").json(hidden)
            if not fs.size(self.spark, hidden):
                return False
            fs.rename(self.spark, hidden, f"{self._path(table)}/{name}")
            return True
        finally:
            fs.remove(self.spark, hidden)

    def _tidy(self, table: str) -> None:
        """Repeat the view of a table of many files in one, and remove what an earlier tidying repeated.

        A claim file keeps drivers from doing it at the same time; one left by a crash is removed when it is old.
        Rows seen twice in between change nothing, since the view has one row per key.
        """
        folder = self._path(table)
        retired = [f for f in fs.names(self.spark, folder) if f.startswith("_retired-")]
        old: set[str] = set()
        for name in retired:
            old.update(fs.read_text(self.spark, f"{folder}/{name}").split())
        files = [f.rsplit("/", 1)[-1] for f in self._files(table)]
        if len(set(files) - old) <= MAX_FILES:
            return
        claim = f"{folder}/_claim"
        if fs.exists(self.spark, claim) and fs.age_seconds(self.spark, claim) > GRACE_SECONDS:
            fs.remove(self.spark, claim)
        if not fs.create_text(self.spark, folder, "_claim", "tidying"):
            return
        try:
            for name in retired:
                if fs.age_seconds(self.spark, f"{folder}/{name}") > GRACE_SECONDS:
                    for file in fs.read_text(self.spark, f"{folder}/{name}").split():
                        fs.remove(self.spark, f"{folder}/{file}")
                    fs.remove(self.spark, f"{folder}/{name}")
            covered = sorted(set(files) - old)
            log = self.spark.read.schema(f"{TABLES[table][0]}, seq bigint").json([f"{folder}/{f}" for f in covered])
            rows = latest(log, TABLES[table][1], [F.col("seq").desc()])
            self._put_rows(table, rows)
            fs.write_text(self.spark, folder, f"_retired-{uuid.uuid4().hex}", "\n".join(covered))
        finally:
            fs.remove(self.spark, claim)

    # Bronze runs -----------------------------------------------------------------------------------------

    def start_run(self, run_id: str, ingestion_date: str | None = None, checkpoint: str | None = None) -> None:
        """Open a run; ``checkpoint`` is that of the stream which lands it."""
        if self.get_run(run_id) is not None:
            raise ValueError(f"run {run_id!r} exists already")
        self._start("pipeline_runs", run_id=run_id, ingestion_date=ingestion_date, checkpoint=checkpoint)

    def reopen_run(self, run: Row) -> None:
        """Mark a run that failed as started again, so that nobody takes it for one that has ended."""
        row = {**run.asDict(), "status": "STARTED", "end_time": None, "details": None}
        self.append("pipeline_runs", **row)
        self._open[row["run_id"]] = row

    def is_compacted(self, run_id: str) -> bool:
        """Whether rows of a bronze run were compacted already."""
        return self._newest("compacted_runs", F.col("run_id") == run_id) is not None

    def _start(self, table: str, **row) -> None:
        row = {**row, "start_time": self.now(), "status": "STARTED"}
        self.append(table, **row)
        self._open[row["run_id"]] = row

    def _end(self, table: str, run_id: str, status: str, details: dict | None) -> None:
        row = self._open.get(run_id) or self._newest(table, F.col("run_id") == run_id)
        if row is not None:
            row = row if isinstance(row, dict) else row.asDict()
            texts = {k: v if isinstance(v, str) else json.dumps(v) for k, v in (details or {}).items()} or None
            self.append(table, **{**row, "end_time": self.now(), "status": status, "details": texts})

    def end_run(self, run_id: str, status: str, details: dict | None = None) -> None:
        """Close a run; a run that was never started stays unknown."""
        self._end("pipeline_runs", run_id, status, details)

    def get_run(self, run_id: str) -> Row | None:
        """The row of a bronze run; its details are texts by name, null if there are none."""
        return self._newest("pipeline_runs", F.col("run_id") == run_id)

    # Stream positions --------------------------------------------------------------------------------------

    def get_checkpoint(self, topic: str, partition: int) -> int | None:
        row = self._newest("cdc_checkpoints", (F.col("topic") == topic) & (F.col("partition") == partition))
        return None if row is None else row["last_committed_offset"]

    def upsert_checkpoint(self, topic: str, partition: int, offset: int) -> None:
        """The last write wins, also when its offset is lower."""
        self.append(
            "cdc_checkpoints",
            topic=topic,
            partition=partition,
            last_committed_offset=int(offset),
            updated_at=self.now(),
        )

    def upsert_checkpoints(self, offsets: DataFrame) -> None:
        """(topic, partition, last_committed_offset) rows."""
        self.append_rows("cdc_checkpoints", offsets.withColumn("updated_at", now_seconds_offset()))

    # Silver runs -------------------------------------------------------------------------------------------

    def start_silver_run(self, run_id: str, job_name: str, table_name: str) -> None:
        if self._newest("silver_runs", F.col("run_id") == run_id) is not None:
            raise ValueError(f"run {run_id!r} exists already")
        self._start("silver_runs", run_id=run_id, job_name=job_name, table_name=table_name)

    def end_silver_run(self, run_id: str, status: str, details: dict | None = None) -> None:
        self._end("silver_runs", run_id, status, details)

    # Merges ------------------------------------------------------------------------------------------------

    def _merges(self, job_name: str, table_name: str) -> str:
        return f"{self.base}/merges/{fs.folder('job', job_name)}/{fs.folder('table', table_name)}"

    def _numbers(self, job_name: str, table_name: str) -> list[int]:
        found = fs.names(self.spark, self._merges(job_name, table_name))
        return sorted((int(n[7:-5]) for n in found if n.startswith("commit-")), reverse=True)

    def _commit(self, job_name: str, table_name: str, number: int) -> dict:
        """Facts of a merge. Commits appear whole: one that can't be read is damaged, and building on the version before
        it would lose its rows."""
        path = f"{self._merges(job_name, table_name)}/commit-{number:012d}.json"
        try:
            return json.loads(fs.read_text(self.spark, path))
        except ValueError as error:
            raise RuntimeError(f"{path} is damaged; restore or remove it") from error

    def last_number(self, job_name: str, table_name: str) -> int:
        """The highest number taken by a merge; the next one must take a higher one."""
        return next(iter(self._numbers(job_name, table_name)), 0)

    def versions(self, job_name: str, table_name: str, limit: int) -> list[dict]:
        """Facts of the newest merges of a table, newest first: number, version, parts, buckets, rows, mode and how
        many rows base and deltas have. Reads that many files."""
        facts = ("version", "parts", "buckets", "rows", "mode", "base_rows", "delta_rows")
        numbers = self._numbers(job_name, table_name)[:limit]
        rows = [(number, self._commit(job_name, table_name, number)) for number in numbers]
        return [{"number": number, **{k: row.get(k) for k in facts}} for number, row in rows]

    def live_version(self, job_name: str, table_name: str) -> dict | None:
        """Facts of the newest merge of a table."""
        return next(iter(self.versions(job_name, table_name, 1)), None)

    def commit_merge(self, number: int, **row) -> bool:
        """Make a merge live under a number; False if another one has taken it."""
        folder = self._merges(row["job_name"], row["table_name"])
        row = {**row, "processed_at": self.now()}
        return fs.create_text(self.spark, folder, f"commit-{number:012d}.json", json.dumps(row, ensure_ascii=False) + "\n")

    def _merge_log(self, job_name: str, table_name: str) -> DataFrame:
        folder = self._merges(job_name, table_name)
        if not self._numbers(job_name, table_name):
            return self.spark.createDataFrame([], f"{MERGES}, seq bigint")
        number = F.regexp_extract("_metadata.file_name", "([0-9]+)", 1).cast("bigint")
        return self.spark.read.schema(MERGES).json(f"{folder}/commit-*.json").withColumn("seq", number)

    def has_merge(self, job_name: str, table_name: str, run_id: str) -> bool:
        return bool(self._merge_log(job_name, table_name).where(F.col("run_id") == run_id).limit(1).count())

    def processed_partitions(self, job_name: str, table_name: str) -> DataFrame:
        """Newest row per merged (event_date, stage_run); stage_run is null where whole dates are tracked, ``attempt``
        names the files that a stage run had."""
        one = F.inline("dates").alias("event_date", "stage_run", "rows_in", "rows_out", "bad_rows", "attempt")
        rows = self._merge_log(job_name, table_name).select(
            "job_name", "table_name", "processed_at", "run_id", "seq", one
        )
        return latest(rows, ["event_date", "stage_run"], [F.col("seq").desc()]).drop("seq")


def merged_date(
    event_date: str, stage_run: str | None, rows_in: int, rows_out: int, bad_rows: int = 0, attempt: str | None = None
) -> dict:
    facts = dict(event_date=event_date, stage_run=stage_run, rows_in=rows_in, rows_out=rows_out, bad_rows=bad_rows)
    return facts if attempt is None else {**facts, "attempt": attempt}
