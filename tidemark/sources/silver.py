"""Stage, quarantine and current tables."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.union import promote_union, require_columns
from tidemark.sources import fs
from tidemark.specs import QUARANTINE_SCHEMA, EntitySpec, stage_schema

# Columns that stage data must have besides the key; fixed.
NEEDED = ("op", "ts_ms", "lsn", "is_delete")
STAGE = "stage_events"
QUARANTINE = "stage_events_quarantine"
CURRENT = "current"


def _table(base: str, kind: str, table: str) -> str:
    return f"{base.rstrip('/')}/{kind}/table={table}"


# Stage -----------------------------------------------------------------------------------------------------


def write_stage(stage: DataFrame, base: str, *, spread: bool = True, max_records_per_file: int = 5_000_000) -> None:
    """Write stage rows to table=/event_date=/run_id= folders in one job; a rerun of a run replaces its folders.

    ``spread`` groups the rows by folder first, so that a folder gets few large files even when every input
    file holds many dates. The rebalance splits a hot date over many tasks and packs small ones together. Without
    it every task writes its own file per date it holds, which is the cheaper plan when a run covers a day or two.
    """
    folders = ["table", "event_date", "run_id"]
    rows = stage.hint("rebalance", *[F.col(c) for c in folders]) if spread else stage
    (
        rows.write.partitionBy(*folders)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records_per_file)
        .parquet(f"{base.rstrip('/')}/{STAGE}")
    )


def stage_partitions(spark: SparkSession, base: str, table: str, only_date: str | None = None) -> DataFrame:
    """(event_date, run_id, attempt) of the stage folders, from names alone; empty when there is no stage.

    ``attempt`` is a digest of the names of a folder's files. Every write has new ones, so a run that was structured
    again, or got more files, is told from what it was before.
    """
    root, date = _table(base, STAGE, table), only_date or "*"
    files: dict[tuple[str, str | None], list[str]] = {}
    for level in ("", "/run_id=*"):
        for path in fs.glob(spark, f"{root}/event_date={date}{level}"):
            values = fs.folder_values(path)
            files[values["event_date"], values.get("run_id")] = []
        for path in fs.glob(spark, f"{root}/event_date={date}{level}/*.parquet"):
            values = fs.folder_values(path)
            files[values["event_date"], values.get("run_id")].append(path.rsplit("/", 1)[-1])
    have = {d for d, r in files if r is not None}
    # A date folder written by another tool, or left empty, has no run level.
    rows = sorted((d, r, hashlib.md5("/".join(sorted(f)).encode()).hexdigest()) for (d, r), f in files.items() if r is not None or d not in have)
    return spark.createDataFrame(rows, "event_date string, run_id string, attempt string")


def read_stage(
    spark: SparkSession,
    base: str,
    spec: EntitySpec,
    *,
    dates: Sequence[str] | None = None,
    partitions: Sequence[tuple[str, str]] | None = None,
    keep_raw_json: bool = False,
    foreign: bool = False,
) -> DataFrame:
    """Stage rows of a table. Given dates or (event_date, run_id) pairs, only their folders are listed and read.

    ``foreign``: files of another tool, whose all-null columns can have any type, are read one by one and cast.
    """
    schema = stage_schema(spec, keep_raw_json)
    root = _table(base, STAGE, spec.table)
    if partitions is not None:
        # a date folder of another tool has no run level
        paths = [f"{root}/event_date={d}" + ("" if r is None else f"/{fs.folder('run_id', r)}") for d, r in partitions]
    elif dates is not None:
        paths = [f"{root}/event_date={d}" for d in dates]
    else:
        paths = [root]
    paths = [p for p in paths if fs.exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], schema).withColumn("run_id", F.lit(None).cast("string"))
    if foreign:
        files = [f for p in paths for level in ("", "/run_id=*") for f in fs.glob(spark, f"{p}{level}/*.parquet")]
        return import_stage(spark, files, spec).withColumn("run_id", F.lit(None).cast("string"))
    reader = spark.read.option("basePath", f"{base.rstrip('/')}/{STAGE}")
    try:
        stored = reader.option("mergeSchema", "true").parquet(*paths)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # folders without files
            return spark.createDataFrame([], schema).withColumn("run_id", F.lit(None).cast("string"))
        raise
    require_columns(stored, [*NEEDED, spec.pk], f"stage data of {spec.table}")
    return reader.schema(f"{_ddl(schema)}, run_id string").parquet(*paths).select(*schema.names, "run_id")


def _run_folders(spark: SparkSession, root: str, run_ids: Sequence[str]) -> list[str]:
    """Folders of some runs among all of a table, from one listing."""
    wanted = set(run_ids)
    return [p for p in fs.glob(spark, f"{root}/run_id=*") if fs.folder_values(p)["run_id"] in wanted]


def clear_run(spark: SparkSession, base: str, table: str, run_ids: Sequence[str]) -> None:
    """Remove what an earlier attempt wrote for some runs, so that dates it alone had do not linger."""
    for root in (f"{_table(base, STAGE, table)}/event_date=*", _table(base, QUARANTINE, table)):
        for path in _run_folders(spark, root, run_ids):
            fs.remove(spark, path)


def import_stage(spark: SparkSession, paths: Sequence[str], spec: EntitySpec) -> DataFrame:
    """Stage files written by another tool, brought to the declared schema.

    Such files carry a column that is null throughout with a type of its own, so every group of like files is
    given as one path, read with its own schema, cast, and put together by name.
    """
    schema = stage_schema(spec)
    needed = [*NEEDED, spec.pk]
    groups = []
    for path in paths:
        df = require_columns(spark.read.parquet(path), needed, f"stage data at {path}")
        df = df.withColumn("src_file", F.col("_metadata.file_name")).withColumn("src_row", F.col("_metadata.row_index"))
        named = {f.name: f.dataType for f in schema.fields}
        groups.append(df.select(*[F.col(c).try_cast(named[c]).alias(c) for c in df.columns if c in named]))
    whole = promote_union([spark.createDataFrame([], schema), *groups])
    return whole.select(*schema.names)


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


# Quarantine ------------------------------------------------------------------------------------------------


def write_quarantine(quarantine: DataFrame, base: str) -> None:
    """JSON lines below table=/run_id=; null fields are left out, so each kind of error keeps its own shape.

    ``quarantine`` has the quarantine columns plus target_table and run_id, which name the folder.
    """
    body = F.to_json(F.struct(*QUARANTINE_SCHEMA.names))
    (
        quarantine.select(body.alias("value"), F.col("target_table").alias("table"), "run_id")
        .write.partitionBy("table", "run_id")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .text(f"{base.rstrip('/')}/{QUARANTINE}")
    )


def read_quarantine(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Rejected events of a table; none if nothing was rejected."""
    paths = fs.glob(spark, f"{_table(base, QUARANTINE, table)}/run_id=*")
    if not paths:
        return spark.createDataFrame([], QUARANTINE_SCHEMA)
    return spark.read.schema(QUARANTINE_SCHEMA).json(paths)


# Current ---------------------------------------------------------------------------------------------------


def version_path(base: str, table: str, version: str) -> str:
    return f"{_table(base, CURRENT, table)}/{fs.folder('version', version)}"


def stored_parts(spark: SparkSession, base: str, table: str) -> list[str]:
    """Bases and deltas of the current table, from folder names."""
    return [fs.folder_values(p)["version"] for p in fs.glob(spark, f"{_table(base, CURRENT, table)}/version=*")]


def _entry_name(table: str) -> str:
    return f"tidemark_{''.join(c if c.isalnum() else '_' for c in table)}_{uuid.uuid4().hex}".lower()


def write_current(rows: DataFrame, base: str, spec: EntitySpec, version: str, buckets: int) -> str:
    """Write a version of the current table, bucketed by key so that the next merge need not shuffle it.

    Rows that come from the bucketed merge join are in place already: each task writes the file of one bucket.
    The table entry in the session catalog only carries the bucketing to the writer and is dropped again; the
    files stay.
    """
    path, name = version_path(base, spec.table, version), _entry_name(spec.table)
    (
        rows.write.format("parquet")
        .bucketBy(buckets, spec.pk)
        .sortBy(spec.pk)
        .option("path", path)
        .mode("overwrite")
        .saveAsTable(name)
    )
    rows.sparkSession.sql(f"DROP TABLE {name}")
    return path


def read_current(
    spark: SparkSession, base: str, spec: EntitySpec, version: str, buckets: int, schema: StructType | None = None
) -> DataFrame:
    """A version as a bucketed table: joins on the key with the same bucket count do not shuffle it.

    The catalog entry tells Spark about the buckets; the frame keeps the resolved files once it is dropped.
    """
    path, name = version_path(base, spec.table, version), _entry_name(spec.table)
    if not fs.glob(spark, f"{path}/part-*"):
        return spark.createDataFrame([], stage_schema(spec))
    schema = schema or spark.read.parquet(path).schema
    spark.sql(
        f"CREATE TABLE {name} ({_ddl(schema)}) USING parquet "
        f"CLUSTERED BY (`{spec.pk}`) SORTED BY (`{spec.pk}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    df = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return df
