"""Change records in a folder, read and written as a stream with a position per topic and partition.

The folder holds one file of records per range of offsets: ``topic=T/partition=P/FIRST-END.parquet`` with the offsets
FIRST <= offset < END. Names alone tell what there is, so planning opens no file. Positions are spelled as those of
a Kafka source, ``{"topic": {"0": next offset}}``, and taken from ``startingOffsets`` in the same way.

Any file system that pyarrow knows can hold the folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
    WriterCommitMessage,
)

from tidemark.sources import fs

FORMAT = "change_log"
# The columns of Spark's Kafka source that bronze needs; fixed.
DDL = "key binary, value binary, topic string, `partition` int, `offset` bigint, timestamp timestamp"
ARROW = pa.schema(
    [
        ("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()), ("partition", pa.int32()),
        ("offset", pa.int64()), ("timestamp", pa.timestamp("us", "UTC")),
    ]
)
STAGING = "_staging"
# Bytes of records in one file as they are in memory, and bytes of files that one task reads.
SEGMENT_BYTES, TASK_BYTES = 128 << 20, 256 << 20


@dataclass(frozen=True)
class Segment:
    topic: str
    partition: int
    first: int
    end: int
    path: str
    size: int = 0

    @property
    def name(self) -> str:
        return f"{fs.folder('topic', self.topic)}/partition={self.partition}/{self.first:020d}-{self.end:020d}.parquet"


@dataclass
class Task(InputPartition):
    """Files of one topic and partition, and the range of offsets to take from them."""

    paths: list[str]
    topic: str
    partition: int
    start: int
    end: int


@dataclass
class Written(WriterCommitMessage):
    segments: list[Segment]


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    # Spark and Hadoop write file:/a for file:///a
    path = path.rstrip("/")
    return pafs.FileSystem.from_uri("file://" + path.removeprefix("file:") if path.startswith("file:/") and "://" not in path else path)


def segments(path: str) -> list[Segment]:
    """What the folder holds, by topic, partition and offset; from file names alone."""
    files, root = _open(path)
    found = []
    for info in files.get_file_info(pafs.FileSelector(root, allow_not_found=True, recursive=True)):
        inside = info.path.removeprefix(root).lstrip("/")
        if info.is_file and inside.endswith(".parquet") and not inside.startswith(STAGING):
            values = fs.folder_values(inside.rsplit("/", 1)[0])
            first, end = inside.rsplit("/", 1)[1].removesuffix(".parquet").split("-")
            found.append(Segment(values["topic"], int(values["partition"]), int(first), int(end), info.path, info.size))
    return sorted(found, key=lambda s: (s.topic, s.partition, s.first))


def _ends(found: list[Segment]) -> dict[str, dict[str, int]]:
    ends: dict[str, dict[str, int]] = {}
    for s in found:
        at = ends.setdefault(s.topic, {})
        at[str(s.partition)] = max(s.end, at.get(str(s.partition), 0))
    return ends


def _tasks(found: list[Segment], start: dict, end: dict) -> list[Task]:
    """Consecutive files of a partition share a task as long as they are small."""
    tasks: list[Task] = []
    room = 0
    for s in found:
        low = start.get(s.topic, {}).get(str(s.partition), 0)
        high = end.get(s.topic, {}).get(str(s.partition), 0)
        if s.end <= low or s.first >= high:
            continue
        last = tasks[-1] if tasks else None
        if last and (last.topic, last.partition) == (s.topic, s.partition) and s.size <= room:
            last.paths.append(s.path)
            room -= s.size
        else:
            tasks.append(Task([s.path], s.topic, s.partition, low, high))
            room = TASK_BYTES - s.size
    return tasks


def _read(path: str, task: Task | None) -> Iterator[pa.RecordBatch]:
    files, _ = _open(path)
    # Spark asks for one read where there are no partitions
    for file in task.paths if task else ():
        with files.open_input_file(file) as source:
            for batch in pq.ParquetFile(source).iter_batches(batch_size=4096):
                offset = batch.column("offset")
                batch = batch.filter(pc.and_(pc.greater_equal(offset, task.start), pc.less(offset, task.end)))
                n = batch.num_rows
                if n:
                    named = {"topic": pa.repeat(task.topic, n), "partition": pa.repeat(pa.scalar(task.partition, pa.int32()), n)}
                    columns = [named[f.name] if f.name in named else batch.column(f.name).cast(f.type) for f in ARROW]
                    yield pa.RecordBatch.from_arrays(columns, schema=ARROW)


def _position(options: dict[str, str]) -> dict:
    """Where to start: ``startingOffsets`` is earliest, latest or JSON; partitions it does not name start at their first."""
    asked = options.get("startingOffsets", "earliest")
    if asked == "latest":
        return _ends(segments(options["path"]))
    return {} if asked == "earliest" else json.loads(asked)


class ChangeLogReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.start = options["path"], _position(options)

    def partitions(self) -> list[Task]:
        found = segments(self.path)
        return _tasks(found, self.start, _ends(found))

    def read(self, partition: Task) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition)


class ChangeLogStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.options, self.path = options, options["path"]

    def initialOffset(self) -> dict:
        return _position(self.options)

    def latestOffset(self) -> dict:
        # a position behind what lies in the folder, such as one given to start from, stays as it is
        ends = _ends(segments(self.path))
        for topic, partitions in _position(self.options).items():
            for partition, offset in partitions.items():
                at = ends.setdefault(topic, {})
                at[partition] = max(offset, at.get(partition, 0))
        return ends

    def partitions(self, start: dict, end: dict) -> list[Task]:
        found = segments(self.path)
        ends = _ends(found)
        for topic, partitions in start.items():
            for partition, offset in partitions.items():
                if offset > ends.get(topic, {}).get(partition, 0) and end.get(topic, {}).get(partition, 0) > offset:
                    raise ValueError(f"{self.path} ends before offset {offset} of {topic}-{partition}: records were lost")
        return _tasks(found, start, end)

    def read(self, partition: Task) -> Iterator[pa.RecordBatch]:
        return _read(self.path, partition)


class ChangeLogWriter(DataSourceArrowWriter):
    """Tasks write hidden files; the driver gives them their names once all are there."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.attempt = options["path"], f"{STAGING}/{uuid.uuid4().hex}"
        self.segment_bytes = int(options.get("segmentBytes", SEGMENT_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, root = _open(self.path)
        made: list[Segment] = []
        held: list[pa.RecordBatch] = []

        def flush() -> None:
            if held:
                table = pa.Table.from_batches(held)
                held.clear()
                offsets = table.column("offset")
                least = pc.min(pc.pairwise_diff(offsets.combine_chunks())).as_py()
                if offsets.null_count or (least is not None and least < 1):
                    raise ValueError("records of a topic and partition must have rising offsets")
                staged = f"{root}/{self.attempt}/{uuid.uuid4().hex}.parquet"
                files.create_dir(staged.rsplit("/", 1)[0])
                pq.write_table(table.drop_columns(["topic", "partition"]), staged, filesystem=files, compression="zstd")
                topic, partition = (table.column(c)[0].as_py() for c in ("topic", "partition"))
                made.append(Segment(topic, partition, offsets[0].as_py(), offsets[-1].as_py() + 1, staged))

        for batch in iterator:
            batch = batch.select(ARROW.names).cast(ARROW)
            runs = pc.run_end_encode(pc.binary_join_element_wise(batch.column("topic"), batch.column("partition").cast(pa.string()), "\n"))
            rows = max(1, self.segment_bytes * batch.num_rows // max(1, batch.nbytes))
            cuts = [0, *runs.run_ends.to_pylist()]
            for part in (batch.slice(i, min(rows, b - i)) for a, b in zip(cuts, cuts[1:], strict=False) for i in range(a, b, rows)):
                same = held and [held[-1].column(c)[0] for c in ("topic", "partition")] == [part.column(c)[0] for c in ("topic", "partition")]
                if held and (not same or sum(b.nbytes for b in held) >= self.segment_bytes):
                    flush()
                held.append(part)
        flush()
        return Written(made)

    def commit(self, messages: list[Written | None]) -> None:
        files, root = _open(self.path)
        new = sorted((s for m in messages if m for s in m.segments), key=lambda s: (s.topic, s.partition, s.first))
        ends = _ends(segments(self.path))
        for s in new:
            at = ends.setdefault(s.topic, {})
            if s.first < at.get(str(s.partition), 0):
                self.abort(messages)
                raise ValueError(f"offsets of {s.topic}-{s.partition} from {s.first} on lie in the log already")
            at[str(s.partition)] = s.end
        for s in new:
            target = f"{root}/{s.name}"
            files.create_dir(target.rsplit("/", 1)[0])
            files.move(s.path, target)
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        files, root = _open(self.path)
        if files.get_file_info(f"{root}/{self.attempt}").type != pafs.FileType.NotFound:
            files.delete_dir(f"{root}/{self.attempt}")


class ChangeLog(DataSource):
    """``spark.read``, ``spark.readStream`` and ``df.write`` with the format ``change_log``; option ``path``, and
    ``startingOffsets`` to read from."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return DDL

    def reader(self, schema) -> ChangeLogReader:
        return ChangeLogReader(self.options)

    def streamReader(self, schema) -> ChangeLogStreamReader:
        return ChangeLogStreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> ChangeLogWriter:
        if overwrite:
            raise ValueError("a change log is only appended to")
        return ChangeLogWriter(self.options)


def _registered(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(ChangeLog)
    return spark


def append(records: DataFrame, path: str, **options) -> None:
    """Append records (the columns of DDL) behind the end of the log; they appear together.

    Ranges of offsets are sorted and written by a task each, so a partition of any size is spread. Of several writers of
    the same partitions only one may be at work at a time, as with a broker's leader.
    """
    _registered(records.sparkSession)
    order = ["topic", "partition", "offset"]
    ranged = records.select(*ARROW.names).repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.format(FORMAT).mode("append").options(path=path, **options).save()


def read(spark: SparkSession, path: str, **options) -> DataFrame:
    """All records, or those from ``startingOffsets`` on."""
    return _registered(spark).read.format(FORMAT).options(path=path, **options).load()


def stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """Records as a stream with the columns of Spark's Kafka source; a batch takes what the folder holds.

    Python sources can't say how far an ``availableNow`` query should go. Spark's wrapper asks for the end once, at the
    start; without it such a query would be over after the batch that failed before.
    """
    spark.conf.set("spark.sql.streaming.triggerAvailableNowWrapper.enabled", "true")
    return _registered(spark).readStream.format(FORMAT).options(path=path, **options).load()
