"""Raw change events: stream source, run folders, scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.selection import RUN_KEYS
from tidemark.operators.union import promote_union, require_columns
from tidemark.sources import fs

# The contract is (ingest_ts, raw_json). Files landed by this engine also hold the stream position in three
# narrow columns, so that offsets are read without touching the texts.
BRONZE_DDL = "ingest_ts string, raw_json string, topic string, `partition` int, `offset` bigint"
KAFKA_DDL = "key binary, value binary, topic string, `partition` int, `offset` bigint, timestamp timestamp"

RUNS = "cdc"
COMPACTED = "compacted"


def kafka_options(
    bootstrap: str,
    topics: Sequence[str],
    *,
    group_id: str | None = None,
    starting_offsets: str = "earliest",
    max_records: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of the Kafka source: all topics, from the earliest record unless positions are given."""
    if not topics:
        raise ValueError("no topics to read")
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
    }
    if group_id:
        options["kafka.group.id"] = group_id
    if max_records:
        options["maxOffsetsPerTrigger"] = str(max_records)
    return {**options, **(extra or {})}


def kafka_stream(spark: SparkSession, bootstrap: str, topics: Sequence[str], **options) -> DataFrame:
    """Streaming frame of change records. Needs Spark's Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(bootstrap, topics, **options)).load()


def file_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """Change records from Parquet files with the Kafka source's columns, for replays and tests."""
    return spark.readStream.schema(KAFKA_DDL).options(**options).parquet(path)


def run_path(base: str, source: str, table: str, ingestion_date: str, run_id: str, root: str = RUNS) -> str:
    values = zip(RUN_KEYS, (source, table, ingestion_date, run_id), strict=True)
    return "/".join([base.rstrip("/"), root, *[f"{k}=*" if v == "*" else fs.folder(k, v) for k, v in values]])


def discover_runs(spark: SparkSession, base: str, root: str = RUNS, only_date: str | None = None) -> DataFrame:
    """Run folders as rows, from folder names alone; of one ingestion date if given."""
    found = [fs.folder_values(p) for p in fs.glob(spark, run_path(base, "*", "*", only_date or "*", "*", root))]
    ddl = ", ".join(f"`{k}` string" for k in RUN_KEYS)
    return spark.createDataFrame([tuple(v[k] for k in RUN_KEYS) for v in found], ddl).orderBy(*RUN_KEYS)


def marked_runs(spark: SparkSession, base: str, only_date: str | None = None) -> DataFrame:
    """Runs another writer closed with a ``_SUCCESS`` file in the run folder: (run_id, status)."""
    pattern = f"{run_path(base, '*', '*', only_date or '*', '*')}/_SUCCESS"
    found = {fs.folder_values(p)["run_id"] for p in fs.glob(spark, pattern)}
    return spark.createDataFrame([(r, "SUCCESS") for r in sorted(found)], "run_id string, status string")


def run_parts(spark: SparkSession, folder: str) -> list[str]:
    """What to read of a run folder: its batches, or the event files of another writer.

    That writer's compaction repeats the rows of a run in ``events_compacted*`` files and then marks the run with
    ``_COMPACTED``. Of a marked run these files alone are read, of others they are left out.
    """
    found = fs.names(spark, folder)
    if any(n.startswith("batch=") for n in found):
        return [folder]
    files = [n for n in found if n.endswith(".parquet")]
    compacted = [n for n in files if n.startswith("events_compacted")]
    use = compacted if "_COMPACTED" in found and compacted else [n for n in files if n not in compacted]
    return [folder] if use == files and files else [f"{folder}/{n}" for n in use]


def _read_promoted(spark: SparkSession, root: str, paths: Sequence[str]) -> DataFrame:
    """Files of different age as one frame with all their columns, the declared ones in their declared types."""
    def read(some: Sequence[str]) -> DataFrame:
        df = spark.read.option("basePath", root).option("mergeSchema", "true").parquet(*some)
        df = require_columns(df, ["ingest_ts", "raw_json"], f"event files in {some[0]}")
        known = {f.name: f.dataType for f in T.StructType.fromDDL(BRONZE_DDL)}
        own = [(F.col(f"`{c}`").cast(known[c]) if c in known else F.col(f"`{c}`")).alias(c) for c in df.columns]
        lacking = [F.lit(None).cast(t).alias(c) for c, t in known.items() if c not in df.columns]
        return df.select(
            *own,
            *lacking,
            # the metadata column holds a URI; readers take paths
            F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("src_path"),
            F.col("_metadata.file_name").alias("src_file"),
            F.col("_metadata.row_index").alias("src_row"),
        )

    try:
        return read(paths)
    except AnalysisException:
        raise
    except Exception:  # noqa: BLE001 - files that can't be read with one schema are read one by one
        if len(paths) == 1:
            raise
        parts = [read([p]) for p in paths]
        kinds: dict[str, set] = {}
        for part in parts:
            for f in part.schema:
                kinds.setdefault(f.name, set()).add(f.dataType.simpleString())
        mixed = {c for c, found in kinds.items() if len(found) > 1}
        return promote_union([p.withColumns({c: F.col(f"`{c}`").cast("string") for c in mixed & set(p.columns)}) for p in parts])


def read_runs(spark: SparkSession, base: str, paths: Sequence[str], root: str = RUNS) -> DataFrame:
    """Rows of the given run folders or files with all their columns, their folder columns and the file and row they
    come from. A column that some files lack is null there; one that must be there is an error if none has it."""
    return _read_promoted(spark, f"{base.rstrip('/')}/{root}", paths)


def read_events(spark: SparkSession, *paths: str) -> DataFrame:
    """Rows of compacted event files written by any tool, after checking the column contract."""
    for path in paths:
        if not fs.glob(spark, path):
            raise FileNotFoundError(f"no input at {path}")
    df = require_columns(spark.read.parquet(*paths), ["ingest_ts", "raw_json"], "the event file")
    return df.select(
        F.col("ingest_ts").cast("string").alias("ingest_ts"),
        F.col("raw_json").cast("string").alias("raw_json"),
        F.col("_metadata.file_name").alias("src_file"),
        F.col("_metadata.row_index").alias("src_row"),
    )
