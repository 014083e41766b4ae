"""Entities described as data: a new table is one more EntitySpec, not more code."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# kind -> type of the staged column. Zoned timestamps and decimals stay text in stage so nothing is lost;
# operators.quality.typed_view turns them into real types.
STAGED_TYPE = {
    "int": T.LongType(),
    "bool": T.BooleanType(),
    "string": T.StringType(),
    "timestamptz": T.StringType(),
    "decimal": T.StringType(),
    "double": T.DoubleType(),
}


@dataclass(frozen=True)
class FieldSpec:
    """One column of an entity.

    ``required_code`` is the quarantine code when the value is missing; None makes the column optional.
    ``empty_is_missing`` treats the empty text like a missing value.
    ``scale`` is used by the typed view of decimal columns.
    """

    name: str
    kind: str
    required_code: str | None = None
    empty_is_missing: bool = False
    precision: int = 12
    scale: int = 2

    def __post_init__(self) -> None:
        if self.kind not in STAGED_TYPE:
            raise ValueError(f"unknown kind {self.kind!r} for column {self.name!r}")


@dataclass(frozen=True)
class EntitySpec:
    """Table name, primary key and columns; required columns are checked in the order given."""

    table: str
    pk: str
    fields: tuple[FieldSpec, ...]

    def __post_init__(self) -> None:
        if self.pk not in [f.name for f in self.fields]:
            raise ValueError(f"primary key {self.pk!r} is not a column of {self.table!r}")

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, STAGED_TYPE[f.kind]) for f in self.fields])


USERS = EntitySpec(
    "users",
    "user_id",
    (
        FieldSpec("user_id", "int", "USER_ID_NULL"),
        FieldSpec("email", "string", "EMAIL_NULL", empty_is_missing=True),
        FieldSpec("country_code", "string", "COUNTRY_CODE_NULL", empty_is_missing=True),
        FieldSpec("created_at", "timestamptz"),
        FieldSpec("updated_at", "timestamptz"),
    ),
)

ORDERS = EntitySpec(
    "orders",
    "order_id",
    (
        FieldSpec("order_id", "int", "ORDER_ID_NULL"),
        FieldSpec("user_id", "int", "USER_ID_NULL"),
        FieldSpec("status", "string", "STATUS_NULL", empty_is_missing=True),
        FieldSpec("total_amount", "decimal", "TOTAL_AMOUNT_NULL"),
        FieldSpec("currency", "string", "CURRENCY_NULL", empty_is_missing=True),
        FieldSpec("ordered_at", "timestamptz", "ORDERED_AT_NULL"),
        FieldSpec("updated_at", "timestamptz"),
        FieldSpec("is_deleted", "bool"),
    ),
)

# Specs for two of the driver's tables.
EVENTS = EntitySpec(
    "events",
    "user_id",
    (
        FieldSpec("user_id", "int", "USER_ID_NULL"),
        FieldSpec("event_id", "int"),
        FieldSpec("event_type", "string", "EVENT_TYPE_NULL", empty_is_missing=True),
        FieldSpec("value", "double"),
        FieldSpec("props", "string"),
    ),
)

CUSTOMER = EntitySpec(
    "customer",
    "c_custkey",
    (
        FieldSpec("c_custkey", "int", "C_CUSTKEY_NULL"),
        FieldSpec("c_name", "string", "C_NAME_NULL", empty_is_missing=True),
        FieldSpec("c_nationkey", "int"),
        FieldSpec("c_acctbal", "double"),
        FieldSpec("c_mktsegment", "string"),
    ),
)

# CDC columns in front of the entity columns of a stage row.
CDC_FIELDS = (
    T.StructField("table", T.StringType()),
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("lsn", T.LongType()),
    T.StructField("event_date", T.StringType()),
    T.StructField("ingest_ts", T.StringType()),
    T.StructField("is_delete", T.BooleanType()),
)

# Where an event came from. These trail the stage row and make the order of ties reproducible: the reader's
# file and row, and the stream offset when the event carries one.
ARRIVAL_FIELDS = (
    T.StructField("src_offset", T.LongType()),
    T.StructField("src_file", T.StringType()),
    T.StructField("src_row", T.LongType()),
)


def stage_schema(spec: EntitySpec, keep_raw_json: bool = False) -> T.StructType:
    """Schema of a stage row: CDC columns, entity columns, optional raw text, arrival columns."""
    raw = [T.StructField("raw_json", T.StringType())] if keep_raw_json else []
    return T.StructType([*CDC_FIELDS, *spec.schema.fields, *raw, *ARRIVAL_FIELDS])


QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField("ingest_ts", T.StringType()),
        T.StructField("raw_json", T.StringType()),
        T.StructField("expected_table", T.StringType()),
        T.StructField("actual_table", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("lsn", T.LongType()),
    ]
)
