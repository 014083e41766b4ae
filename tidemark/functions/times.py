"""Epoch-millisecond and UTC text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First and last millisecond of the years 1 to 9999.
MIN_TS_MS = -62135596800000
MAX_TS_MS = 253402300799999
DAY_MS = 86400000


def in_date_range(ts_ms: Column) -> Column:
    return ts_ms.between(MIN_TS_MS, MAX_TS_MS)


def event_date(ts_ms: Column) -> Column:
    """UTC date of epoch milliseconds as ``YYYY-MM-DD``; null outside the years 1 to 9999.

    Whole-day arithmetic on the integer, so neither the session time zone nor a timestamp is involved.
    """
    day_start = ts_ms - F.pmod(ts_ms, F.lit(DAY_MS))
    days = F.call_function("div", day_start, F.lit(DAY_MS)).cast("int")
    return F.when(in_date_range(ts_ms), F.date_from_unix_date(days).cast("string"))


def iso_micros(ts_ms: Column) -> Column:
    """Epoch milliseconds as ``YYYY-MM-DDTHH:MM:SS.ffffffZ``."""
    return F.date_format(F.timestamp_millis(ts_ms), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def now_seconds_z() -> Column:
    """Current UTC time with seconds and ``Z``: the stamp of a landed file."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def now_seconds_offset() -> Column:
    """Current UTC time with seconds and ``+00:00``, whatever the session's time zone: the stamp of ledger rows."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def now_micros_offset() -> Column:
    """Current UTC time with microseconds and ``+00:00``: the default when a bronze row has no stamp."""
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def unix_millis(ts: Column) -> Column:
    """Epoch milliseconds of a timestamp column, with or without zone (then read as UTC)."""
    return F.unix_millis(ts.cast("timestamp"))
