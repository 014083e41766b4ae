"""Typed views of stage or current rows, and reference checks between tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.specs import EntitySpec, FieldSpec


def _unscaled(text: Column) -> Column:
    """Base64 of a big-endian two's-complement integer (how connectors send exact decimals) as decimal(38,0).

    The 16 last bytes hold any value of 38 digits; bytes before them may only repeat the sign. They are read as two
    64-bit halves, the upper one with its sign.
    """
    digits = F.hex(F.try_to_binary(text, F.lit("base64")))
    negative = F.conv(F.substring(digits, 1, 1), 16, 10).cast("int") >= 8
    sign = F.when(negative, "F").otherwise("0")
    last = F.when(F.length(digits) < 32, F.lpad(digits, 32, sign)).otherwise(F.right(digits, F.lit(32)))
    extra = F.substring(digits, F.lit(1), F.length(digits) - 32)
    fits = (F.length(digits) <= 32) | (
        (F.translate(extra, "F0", "") == "") & (F.length(F.replace(extra, sign)) == 0)
        & ((F.conv(F.substring(last, 1, 1), 16, 10).cast("int") >= 8) == negative)
    )

    def half(start: int) -> Column:
        return F.conv(F.substring(last, start, 16), 16, 10).cast("decimal(20,0)")

    step = F.lit("18446744073709551616").cast("decimal(20,0)")
    # a negative number counts up to nought, so that no part of the sum is larger than the sum
    upper = F.when(negative, half(1) - step + 1).otherwise(half(1)).cast("decimal(20,0)")
    lower = F.when(negative, half(17) - step).otherwise(half(17)).cast("decimal(20,0)")
    return F.when((F.length(digits) > 0) & fits, F.try_add(F.try_multiply(upper, step), lower).cast("decimal(38,0)"))


def _shifted(whole: Column, scale: int) -> Column:
    """The text of a whole number divided by 10 ** scale, exactly."""
    if not scale:
        return whole.cast("string")
    # the text, since abs() rounds to 34 digits
    digits = F.replace(whole.cast("string"), F.lit("-"))
    digits = F.lpad(digits, F.greatest(F.length(digits), F.lit(scale + 1)), "0")
    cut = F.length(digits) - scale
    return F.concat(
        F.when(whole < 0, "-").otherwise(""), F.substring(digits, F.lit(1), cut), F.lit("."), F.substring(digits, cut + 1, F.lit(scale))
    )


def typed(field: FieldSpec, encoded_decimals: bool = False) -> Column:
    """Column of a field in its real type; a text that does not parse becomes null."""
    value = F.col(field.name)
    if field.kind == "timestamptz":
        return F.try_to_timestamp(value).alias(field.name)
    if field.kind == "decimal":
        target = f"decimal({field.precision},{field.scale})"
        if encoded_decimals:
            # null only where the declared precision can't hold the value
            return _shifted(_unscaled(value), field.scale).try_cast(target).alias(field.name)
        return value.try_cast(target).alias(field.name)
    return value


def typed_view(current: DataFrame, spec: EntitySpec, *, encoded_decimals: bool = False) -> DataFrame:
    """Timestamps as TIMESTAMP and decimals as DECIMAL, other columns unchanged.

    ``encoded_decimals``: amounts are base64 integers, the connector's default for NUMERIC columns.
    """
    fields = {f.name: f for f in spec.fields}
    return current.select(*[typed(fields[c], encoded_decimals) if c in fields else F.col(c) for c in current.columns])


def orphans(child: DataFrame, parent: DataFrame, on: str) -> DataFrame:
    """Child rows whose key is set but has no parent row."""
    return child.where(F.col(on).isNotNull()).join(parent.select(on), on, "left_anti")
