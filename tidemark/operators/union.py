"""Frames of different age put together."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def promote_union(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name; a column some frames lack is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def require_columns(df: DataFrame, needed: Sequence[str], what: str) -> DataFrame:
    """Return ``df``, or raise naming the columns it lacks."""
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {df.columns}")
    return df
