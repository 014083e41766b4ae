"""Which event dates are complete: a date is closed once the event time of the stream has passed it by some delay.

Stage files are followed as a stream with a watermark. A daily count in append mode comes out when the watermark passes
the end of the day, and then closes the date in the ledger. Rows that arrive for a closed date make it late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.times import now_seconds_offset
from tidemark.session import check
from tidemark.sources import silver
from tidemark.sources.ledger import Ledger
from tidemark.specs import EntitySpec

# States of a date; open ones have no ledger row yet.
OPEN, CLOSED, LATE = "open", "closed", "late"


def date_states(spark: SparkSession, silver_base: str, ledger: Ledger, spec: EntitySpec) -> DataFrame:
    """(event_date, state, rows) of all dates that have stage folders. ``rows``: counted when the date was closed, or that
    came late."""
    dates = silver.stage_partitions(spark, silver_base, spec.table).select("event_date").distinct()
    known = ledger.view("event_dates").where(F.col("table_name") == spec.table).select("event_date", "state", "rows")
    return dates.join(known, "event_date", "left").select("event_date", F.coalesce("state", F.lit(OPEN)).alias("state"), "rows")


def _note(ledger: Ledger, dates: DataFrame, spec: EntitySpec, state: str) -> None:
    """dates: event_date, rows."""
    ledger.append_rows(
        "event_dates",
        dates.withColumns({"table_name": F.lit(spec.table), "state": F.lit(state), "changed_at": now_seconds_offset()}),
    )


def reclose(ledger: Ledger, spec: EntitySpec, dates: list[str]) -> list[str]:
    """Close late dates among the given ones again, once their late rows are applied."""
    late = ledger.view("event_dates").where((F.col("table_name") == spec.table) & (F.col("state") == LATE))
    found = late.where(F.col("event_date").isin(dates)).select("event_date", "rows")
    names = sorted(r["event_date"] for r in found.select("event_date").collect())
    if names:
        _note(ledger, found, spec, CLOSED)
    return names


def track_dates(
    spark: SparkSession,
    silver_base: str,
    ledger: Ledger,
    spec: EntitySpec,
    *,
    checkpoint: str,
    delay: str = "1 day",
) -> None:
    """Look at the stage files that are new since the last call, note late dates, then close dates.

    Late rows are those of dates closed by an earlier call; these are just the rows that the watermark drops. Both steps are
    streaming queries with a checkpoint each, so a file counts once however often the call is repeated or breaks.
    Rows of a file that was replaced meanwhile are counted from the new one.
    """
    check(spark)
    root = f"{silver_base.rstrip('/')}/{silver.STAGE}"
    schema = "ts_ms bigint, event_date string, run_id string"

    def files() -> DataFrame:
        return spark.readStream.schema(schema).option("ignoreMissingFiles", "true").parquet(f"{root}/table={spec.table}")

    def late(batch: DataFrame, _: int) -> None:
        closed = ledger.view("event_dates").where((F.col("table_name") == spec.table) & (F.col("state") != OPEN))
        came = batch.groupBy("event_date").agg(F.count("*").alias("rows"))
        _note(ledger, came.join(closed.select("event_date"), "event_date", "left_semi"), spec, LATE)

    def close(batch: DataFrame, _: int) -> None:
        day = F.date_format(F.col("window.start"), "yyyy-MM-dd")
        _note(ledger, batch.select(day.alias("event_date"), "rows"), spec, CLOSED)

    def run(query: StreamingQuery) -> None:
        query.awaitTermination()

    if not silver.stage_partitions(spark, silver_base, spec.table).take(1):
        return
    now = {"availableNow": True}
    run(files().writeStream.foreachBatch(late).option("checkpointLocation", f"{checkpoint}/late").trigger(**now).start())
    timed = files().select(F.timestamp_millis("ts_ms").alias("event_time")).withWatermark("event_time", delay)
    daily = timed.groupBy(F.window("event_time", "1 day")).agg(F.count("*").alias("rows"))
    out = daily.writeStream.outputMode("append").foreachBatch(close)
    run(out.option("checkpointLocation", f"{checkpoint}/closed").trigger(**now).start())
