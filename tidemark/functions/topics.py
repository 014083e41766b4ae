"""Topic names and record text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_topic_list(text: str) -> list[str]:
    """Comma-separated topic option to a list, without blanks."""
    return [name for name in map(str.strip, text.split(",")) if name]


def _parts(topic: Column) -> Column:
    return F.split(topic, r"\.", -1)


def topic_source(topic: Column) -> Column:
    """``<prefix>.<schema>.<table>`` -> prefix; a topic of fewer parts is its own source."""
    parts = _parts(topic)
    return F.when(F.size(parts) >= 3, F.element_at(parts, 1)).otherwise(topic)


def topic_table(topic: Column) -> Column:
    """``<prefix>.<schema>.<table>`` -> table; ``unknown`` for a topic of fewer parts."""
    parts = _parts(topic)
    return F.when(F.size(parts) >= 3, F.element_at(parts, -1)).otherwise(F.lit("unknown"))


def in_table_list(topic: Column, tables: list[str]) -> Column:
    """True when the topic's ``schema.table`` ending is on the include list."""
    return F.substring_index(topic, ".", -2).isin(*tables)


def utf8_text(value: Column) -> Column:
    """Bytes (or text) as valid UTF-8; invalid bytes become U+FFFD, null stays null."""
    return F.make_valid_utf8(value.cast("string"))
