"""The last event of each key as the state of a stream: a batch costs its events, whatever the size of the table.

Unlike ``streaming.current``, which merges batches into a stored table, nothing is read back and nothing is folded: Spark keeps
one row per key in its state store, and every batch gives out the rows that changed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.operators.columns import arrival_columns
from tidemark.operators.envelope import wrap_kafka
from tidemark.operators.merge import is_removal, live
from tidemark.operators.structure import judge, stage_rows
from tidemark.session import check
from tidemark.specs import EntitySpec, stage_schema

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "last"
# Rows that a task holds at once to find the newest among them.
HELD_ROWS = 200_000


class LastEvent(StatefulProcessor):
    """Keeps the newest event of a key, deletes too; gives it out when it changes.

    With ``expires`` a timer forgets a deleted key once the watermark passes its delete; Spark leaves out events from before
    the watermark, so none of them can bring the key back.
    """

    def __init__(self, schema: T.StructType, arrival: list[str], expires: bool) -> None:
        self._schema, self._arrival, self._expires = schema, arrival, expires

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState(STATE, self._schema)
        self._names = self._schema.names
        self._at = {name: i for i, name in enumerate(self._names)}

    def _order(self, row: tuple) -> tuple:
        lsn, ts_ms = row[self._at["lsn"]], row[self._at["ts_ms"]]
        marks = [row[self._at[c]] for c in self._arrival]
        # a missing log position or time is the newest, a missing mark of arrival the oldest
        return (lsn is None, lsn or 0, ts_ms is None, ts_ms or 0, *((m is not None, m) if m is not None else (False, 0) for m in marks))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest = max((tuple(row[name] for name in self._names) for row in rows), key=self._order, default=None)
        before = tuple(self._last.get()) if self._last.exists() else None
        if newest is None or (before is not None and self._order(before) > self._order(newest)):
            return
        self._last.update(newest)
        if self._expires:
            for timer in list(self._handle.listTimers()):
                self._handle.deleteTimer(timer)
            if newest[self._at["is_delete"]]:
                self._handle.registerTimer(newest[self._at["ts_ms"]])
        yield Row(**dict(zip(self._names, newest, strict=True)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self._last.exists() and self._last.get()[self._at["is_delete"]]:
            self._last.clear()
        yield from ()

    def close(self) -> None: ...


def _newest(rows: pa.Table, pk: str, arrival: list[str]) -> pa.Table:
    """The newest row of each key, in the order of ``LastEvent``."""
    marks = {}
    # a missing log position or time is the newest, a missing mark of arrival the oldest
    for name in ("lsn", "ts_ms", *arrival):
        column = rows[name]
        if column.null_count:
            missing = pc.is_null(column) if name in ("lsn", "ts_ms") else pc.is_valid(column)
            marks[f"{name} rank"] = pc.cast(missing, pa.int8())
        marks[name] = column
    keyed = pa.table({"": rows[pk], **marks})
    index = pc.sort_indices(keyed, sort_keys=[(c, "ascending") for c in keyed.column_names])
    keys = pc.take(rows[pk], index).combine_chunks()
    last = pa.concat_arrays([pc.not_equal(keys[:-1], keys[1:]), pa.array([True])])
    return rows.take(index.filter(last))


def newest_of_parts(stage: DataFrame, pk: str) -> DataFrame:
    """Of rows that have keys, at least the newest of each, and of a partition few more. It keeps no state, so a stream can do
    it before the rows meet theirs: the state is then asked once per key and batch, not given every event."""
    arrival = arrival_columns(stage)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= HELD_ROWS:
                yield from _newest(pa.Table.from_batches(held), pk, arrival).combine_chunks().to_batches()
                held = []
        if held:
            yield from _newest(pa.Table.from_batches(held), pk, arrival).combine_chunks().to_batches()

    return stage.repartition(F.col(pk)).mapInArrow(reduce, stage.schema)


def keep_current(
    stream: DataFrame,
    changes: str,
    spec: EntitySpec,
    *,
    checkpoint: str,
    expire: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the newest event per key of a stream of Kafka-shaped records, in the order of ``ordered`` merges.

    The rows that a batch changed, deletes included, are written to ``changes`` in a folder per batch, which a
    batch delivered again replaces. The state itself lies in ``checkpoint`` and is read by :func:`kept_current`. It has as many
    partitions as ``spark.sql.shuffle.partitions`` says when the query first starts.

    Deleted keys are kept for good, or with ``expire`` until the newest event time is so much later; events that are older than
    that against the newest one are then left out.
    """
    spark = stream.sparkSession
    check(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    schema = stage_schema(spec)
    events = wrap_kafka(stream).where(F.col("table") == spec.table).select("raw_json")
    stage = stage_rows(judge(events, [spec], expected_table=spec.table), spec).where(F.col(spec.pk).isNotNull())
    stage = stage.withColumn("is_delete", is_removal(stage))
    if expire is None:
        stage = newest_of_parts(stage, spec.pk)
    else:
        # events too late are left out by the state itself, so none may be taken for the newest before
        stage = stage.withColumn("_event_time", F.timestamp_millis("ts_ms")).withWatermark("_event_time", expire)
    last = stage.groupBy(spec.pk).transformWithState(
        LastEvent(schema, arrival_columns(stage), expire is not None),
        outputStructType=schema,
        outputMode="Update",
        timeMode="None" if expire is None else "EventTime",
    )

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes.rstrip('/')}/batch={batch_id:09d}")

    return (
        last.writeStream.outputMode("update")
        .foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def kept_current(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The live rows that :func:`keep_current` holds, read from its state after the last complete batch."""
    stored = spark.read.format("statestore").option("stateVarName", STATE).load(checkpoint)
    return live(stored.select("value.*"))
