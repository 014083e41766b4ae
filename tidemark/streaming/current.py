"""A current table kept up to date from the stream, batch by batch."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.envelope import wrap_kafka
from tidemark.operators.structure import judge, stage_rows
from tidemark.plans.merge import ATTEMPTS, JOB_NAME, apply_stage
from tidemark.session import check
from tidemark.sources.ledger import Ledger
from tidemark.specs import EntitySpec


def follow(
    stream: DataFrame,
    silver_base: str,
    ledger: Ledger,
    spec: EntitySpec,
    *,
    checkpoint: str,
    name: str,
    mode: str = "ordered",
    buckets: int | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Merge every batch of Kafka-shaped records into the current table of ``spec``.

    ``ordered`` is the default: batches cut the stream anywhere, so a batch may hold events older than the
    current row. A batch is one merge named after query and batch number; one already committed is skipped, so
    a batch delivered again changes nothing. Records of other tables and unusable events are left to the
    bronze path.
    """

    check(stream.sparkSession)

    def apply(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{name}-{batch_id:09d}"
        events = wrap_kafka(batch).where(F.col("table") == spec.table).select("raw_json")
        if events.isEmpty():
            return
        stage = stage_rows(judge(events, [spec], expected_table=spec.table), spec)
        for attempt in range(ATTEMPTS):
            if ledger.has_merge(JOB_NAME, spec.table, run_id):
                return
            result = apply_stage(
                batch.sparkSession,
                silver_base,
                ledger,
                spec,
                stage,
                run_id=run_id,
                version=f"{run_id}-{attempt}-{uuid.uuid4().hex}",
                mode=mode,
                buckets=buckets,
                dates=[],
                stats=False,
            )
            if result is not None:
                return
        raise RuntimeError(f"batch {batch_id} was overtaken {ATTEMPTS} times")

    return (
        stream.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .queryName(name)
        .start()
    )
