"""Current state: one row per primary key after all changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.columns import arrival_columns
from tidemark.operators.dedupe import latest, newest_first


def is_removal(df: DataFrame) -> Column:
    """The event deletes its key. A false or missing flag does not save an event whose op is a delete."""
    removal = F.coalesce(F.col("op") == "d", F.lit(False))
    return F.coalesce(F.col("is_delete"), F.lit(False)) | removal if "is_delete" in df.columns else removal


def latest_events(stage: DataFrame, pk: str, mode: str = "replay") -> DataFrame:
    """Last event per key, deletes included; events without a key are skipped.

    This one pass stands for applying the events in order: an upsert replaces the whole row and a delete
    removes it, so only the last event of a key decides. Replayed events cannot change which one is last.
    """
    return latest(stage.where(F.col(pk).isNotNull()), [pk], newest_first(stage, mode))


def live(current: DataFrame) -> DataFrame:
    """Current rows without the tombstones the ``ordered`` mode keeps."""
    return current.where(~is_removal(current))


def _order_key(row: Column, columns: list[str], *, dated: bool) -> Column:
    """Sortable struct of an event's position; compares like ``newest_first``."""
    leading = [row["event_date"].alias("event_date")] if dated else []
    return F.struct(
        *leading,
        row["lsn"].isNull().alias("lsn_null"),
        row["lsn"].alias("lsn"),
        row["ts_ms"].isNull().alias("ts_null"),
        row["ts_ms"].alias("ts_ms"),
        *[row[c].alias(c) for c in columns],
    )


def merge_current(
    current: DataFrame | None,
    stage: DataFrame,
    pk: str,
    mode: str = "replay",
    *,
    partitions: int | None = None,
) -> DataFrame:
    """Fold stage events into the current state.

    ``replay``: the new events win over the current row whatever its age, and deleted keys disappear.
    ``ordered``: an event older than the current row is ignored, and a deleted key stays as a tombstone
    (``is_delete`` true, hidden by :func:`live`) so that a late event cannot bring it back.

    The stage side is reduced to one row per key before it meets the current state. The two sides hold one row
    per key each, so the full outer join has no hot keys. ``partitions`` is the bucket count of a bucketed
    current table: the reduced events are hashed the same way and the current side is not shuffled at all.
    """
    events = latest_events(stage, pk, mode)
    if partitions is not None:
        events = events.repartition(partitions, pk)
    return fold(current, events, pk, mode)


def fold(current: DataFrame | None, events: DataFrame, pk: str, mode: str = "replay") -> DataFrame:
    """The current state after events of which each key has one at most. Two sides bucketed alike stay in place."""
    if current is None:
        return events if mode == "ordered" else live(events)
    columns = [*current.columns, *[c for c in events.columns if c not in current.columns]]
    left = current.select(F.col(pk).alias("_pk"), F.struct(*current.columns).alias("_cur"))
    right = events.select(F.col(pk).alias("_pk"), F.struct(*events.columns).alias("_new"))
    joined = left.join(right, "_pk", "full_outer")
    takes_new = F.col("_new").isNotNull()
    if mode == "ordered":
        arrival = [c for c in arrival_columns(current) if c in events.columns]
        cur = _order_key(F.col("_cur"), arrival, dated=False)
        new = _order_key(F.col("_new"), arrival, dated=False)
        takes_new = takes_new & (F.col("_cur").isNull() | (new >= cur))

    def pick(name: str) -> Column:
        old = F.col("_cur")[name] if name in current.columns else F.lit(None)
        new = F.col("_new")[name] if name in events.columns else F.lit(None)
        return F.when(F.col("_takes_new"), new).otherwise(old).alias(name)

    merged = joined.withColumn("_takes_new", takes_new).select(*[pick(c) for c in columns])
    return merged if mode == "ordered" else live(merged)


def merge_stats(
    current: DataFrame | None,
    stage: DataFrame,
    pk: str,
    mode: str = "replay",
    *,
    live_before: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Per event date: events after replay removal, and live keys after that date is applied.

    Reads only the key, order and delete columns. Distinct events are counted, and the last one per (date, key) is
    kept; the live keys follow from where a key's liveness changes from date to date. Of the current
    table only keys with new events take part: ``live_before`` is its number of live keys, counted when not
    given, and ``partitions`` its bucket count, with which it is joined without a shuffle.
    """
    dated = mode == "replay"
    arrival = arrival_columns(stage)
    extra = ["is_delete"] if "is_delete" in stage.columns else []
    narrow = stage.select("event_date", F.col(pk).alias("_pk"), "lsn", "ts_ms", "op", *extra, *arrival)
    # Keys alone are counted by hash, and of each date and key the last event is found before the shuffle.
    distinct = narrow.select("event_date", "_pk", "lsn", "ts_ms", "op").distinct()
    counted = distinct.groupBy("event_date").agg(F.count("*").alias("rows_in"))
    last = latest(narrow, ["event_date", "_pk"], newest_first(narrow, mode))
    row = F.struct("event_date", "lsn", "ts_ms", *arrival)
    event = F.struct(_order_key(row, arrival, dated=dated).alias("key"), (~is_removal(last)).alias("live"))
    per_key = last.select("event_date", "_pk", event.alias("_e"))

    if current is None:
        steps, total = per_key.withColumn("_before", F.lit(None).cast(per_key.schema["_e"].dataType)), F.lit(0)
    else:
        if partitions is not None:
            per_key = per_key.repartition(partitions, "_pk")
        values = {"event_date": F.lit(""), "lsn": F.col("lsn"), "ts_ms": F.col("ts_ms")}
        if dated:
            # An empty date ranks below every event, whatever stands in the other columns.
            values |= {c: F.lit(None).cast("long") for c in ("lsn", "ts_ms")}
        for c in arrival:
            kept = not dated and c in current.columns
            values[c] = F.col(c) if kept else F.lit(None).cast(stage.schema[c].dataType)
        row = F.struct(*[v.alias(c) for c, v in values.items()])
        state = F.struct(_order_key(row, arrival, dated=dated).alias("key"), (~is_removal(current)).alias("live"))
        steps = per_key.join(current.select(F.col(pk).alias("_pk"), state.alias("_before")), "_pk", "left")
        total = F.lit(live_before) if live_before is not None else live(current).agg(F.count("*")).scalar()

    by_date = Window.partitionBy("_pk").orderBy("event_date")
    alive = F.col("_pk").isNotNull() & F.greatest("_last", "_before")["live"]
    was = (F.col("_pk").isNotNull() & F.coalesce(F.col("_before")["live"], F.lit(False))).cast("long")
    steps = (
        steps.withColumn("_last", F.max("_e").over(by_date))
        .withColumn("_live", alive.cast("long"))
        .withColumn("_delta", F.col("_live") - F.coalesce(F.lag("_live").over(by_date), was))
    )
    daily = counted.join(steps.groupBy("event_date").agg(F.sum("_delta").alias("_delta")), "event_date")
    # One row per date is left here, so the running total over all dates is a small window.
    return daily.select(
        "event_date",
        "rows_in",
        (total + F.sum("_delta").over(Window.orderBy("event_date"))).cast("long").alias("rows_out"),
        F.lit(0).cast("long").alias("bad_rows"),
    )
