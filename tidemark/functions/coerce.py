"""JSON value to column type.

The reader hands over every value as text, which is cheap but hides what the value was: ``"2"`` and ``2`` look
alike. Most texts mean the same either way. For the few that do not, each rule here says when it is *in doubt*,
and such an event is parsed once more as VARIANT, which keeps the types.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.specs import EntitySpec, FieldSpec

# Texts that count as a boolean, compared without case.
TRUE_TEXTS = ("true", "t", "1", "yes")
FALSE_TEXTS = ("false", "f", "0", "no")

_NUMBER = r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
_FRACTION = r"^-?[0-9]+(\.[0-9]+([eE][+-]?[0-9]+)?|[eE][+-]?[0-9]+)$"


def image_type(spec: EntitySpec) -> str:
    """DDL of a row image; anything but a JSON object reads as null."""
    return "struct<" + ", ".join(f"`{f.name}` {'double' if f.kind == 'double' else 'string'}" for f in spec.fields) + ">"


# What a text tells -----------------------------------------------------------------------------------------


def _starts_with_any(text: Column, chars: str) -> Column:
    return F.substring(text, 1, 1).isin(*chars)


def string_in_doubt(text: Column, name: str, raw: Column) -> Column:
    """The text may be a fraction, and a JSON number is spelled anew while a string stays as it is.

    It is none unless the event holds a number under that name somewhere; an escaped name could hide it.
    """
    number_somewhere = raw.rlike(f'"{re.escape(name)}"\\s*:\\s*[-0-9]') | raw.contains("\\u")
    return _starts_with_any(text, "-0123456789") & text.rlike(_FRACTION) & number_somewhere


def name_in_doubt(text: Column) -> Column:
    """The text may come from something else than a JSON string."""
    return _starts_with_any(text, "-0123456789{[") | text.isin("true", "false")


def int_in_doubt(text: Column) -> Column:
    return text.isNotNull() & text.try_cast("bigint").isNull()


def bool_in_doubt(text: Column) -> Column:
    """Numbers count by value, but the same digits in a string are no boolean."""
    return _starts_with_any(text, "-0123456789") & ~text.isin("0", "1") & text.rlike(_NUMBER)


def text_as_bool(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.isin(*TRUE_TEXTS), F.lit(True)).when(low.isin(*FALSE_TEXTS), F.lit(False))


# What a VARIANT tells ----------------------------------------------------------------------------------------


def is_absent(value: Column) -> Column:
    """A VARIANT that is missing or JSON null."""
    return value.isNull() | F.is_variant_null(value)


def is_json_string(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def to_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def to_int(value: Column) -> Column:
    return F.try_variant_get(value, "$", "bigint")


def to_bool(value: Column) -> Column:
    """Booleans and numbers by value, strings only from the two lists, everything else null."""
    return F.when(is_json_string(value), text_as_bool(to_text(value))).otherwise(
        F.try_variant_get(value, "$", "boolean")
    )


def to_decimal_text(value: Column) -> Column:
    """Text of a decimal. A whole JSON float keeps its ``.0``, which the VARIANT text drops."""
    text = to_text(value)
    whole_float = ~text.contains(".") & F.schema_of_variant(value).startswith("DECIMAL")
    return F.when(whole_float, F.concat(text, F.lit(".0"))).otherwise(text)


# Fields ------------------------------------------------------------------------------------------------------


def _iso_only(text: Column) -> Column:
    """ISO timestamps are recognised by their ``T`` and kept as they are; anything else is null."""
    return F.when(text.contains("T"), text)


def _in_doubt(field: FieldSpec, text: Column, raw: Column) -> Column:
    if field.kind == "int":
        return int_in_doubt(text)
    if field.kind == "bool":
        return bool_in_doubt(text)
    if field.kind == "double":
        return F.lit(False)
    return string_in_doubt(text, field.name, raw)


_FROM_TEXT = {
    "int": lambda text: text.try_cast("bigint"),
    "bool": text_as_bool,
    "string": lambda text: text,
    "timestamptz": _iso_only,
    "decimal": lambda text: text,
    "double": lambda value: value,
}
_FROM_VARIANT = {
    "int": to_int,
    "bool": to_bool,
    "string": to_text,
    "timestamptz": lambda value: _iso_only(to_text(value)),
    "decimal": to_decimal_text,
}


def entity_in_doubt(spec: EntitySpec, image: Column, raw: Column) -> Column:
    """Some value of the image needs its JSON type; ``raw`` is the text of the event."""
    return any_of([_in_doubt(f, image[f.name], raw) for f in spec.fields])


def any_of(conditions: list[Column]) -> Column:
    """At least one condition holds; a null condition does not."""
    return reduce(or_, [F.coalesce(c, F.lit(False)) for c in conditions])


def staged_entity(spec: EntitySpec, image: Column, variant: Column) -> Column:
    """Stage values of an image; null when there is no image. ``variant`` is the same image as VARIANT where the
    event is in doubt, null otherwise."""

    def value(f: FieldSpec) -> Column:
        plain = _FROM_TEXT[f.kind](image[f.name])
        if f.kind not in _FROM_VARIANT:
            return plain
        exact = _FROM_VARIANT[f.kind](F.try_variant_get(variant, f"$['{f.name}']", "variant"))
        return F.when(variant.isNotNull(), exact).otherwise(plain)

    return F.when(image.isNotNull(), F.struct(*[value(f).alias(f.name) for f in spec.fields]))


def is_missing(field: FieldSpec, entity: Column) -> Column:
    """True when a required field of a staged entity has no usable value."""
    value = entity[field.name]
    return (value.isNull() | (value == "")) if field.empty_is_missing else value.isNull()
