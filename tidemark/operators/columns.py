"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.specs import ARRIVAL_FIELDS


def pin(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated once per row, whatever reads them later.

    A filter on a plain projected column is pushed below the projection and repeats its expression; with an
    expensive one (parsing JSON) that means several parses per row. The optimizer does not push through a
    generator, so the columns go through a one-element ``inline``.
    """
    row = F.struct(*[expr.alias(name) for name, expr in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def or_null(df: DataFrame, name: str, dtype: str) -> Column:
    """Column ``name`` of ``df``, or a typed null where the frame has no such column."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype).alias(name)


def arrival_columns(df: DataFrame) -> list[str]:
    """Columns that tell which of two otherwise equal events arrived later, most significant first."""
    names = ["ingest_ts", *[f.name for f in ARRIVAL_FIELDS]]
    return [name for name in names if name in df.columns]
