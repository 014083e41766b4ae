"""Replay removal and the order of change events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.columns import arrival_columns


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row per key in the given order.

    ``row_number() = 1`` lets Spark drop all but one row per key and input partition before the shuffle, so a
    key holding a third of all rows sends one row per task, not all of them.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def newest_first(df: DataFrame, mode: str = "replay") -> list[Column]:
    """Order of events, newest first.

    ``replay``: the date of the event decides, then the log position, then its time. ``ordered``: the log
    position decides whatever the date. A null position or time counts as newest. Ties go to the later arrival.
    """
    if mode not in ("replay", "ordered"):
        raise ValueError(f"unknown merge mode {mode!r}")
    leading = [F.col("event_date").desc_nulls_last()] if mode == "replay" else []
    return [
        *leading,
        F.col("lsn").desc_nulls_first(),
        F.col("ts_ms").desc_nulls_first(),
        *[F.col(c).desc_nulls_last() for c in arrival_columns(df)],
    ]


def dedupe_replays(stage: DataFrame, pk: str) -> DataFrame:
    """Keep the last arrival of every event delivered more than once on a date; nulls compare equal."""
    arrival = [F.col(c).desc_nulls_last() for c in arrival_columns(stage)] or [F.lit(1)]
    return latest(stage, ["event_date", pk, "lsn", "ts_ms", "op"], arrival)
