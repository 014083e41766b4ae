"""Events to typed stage rows, everything unusable to quarantine rows with one reason code each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import coerce, times
from tidemark.operators.columns import pin
from tidemark.operators.envelope import (
    AFTER_OPS,
    ENVELOPE_CODES,
    envelope_error,
    open_envelope,
    with_input_defaults,
)
from tidemark.specs import CDC_FIELDS, EntitySpec, stage_schema


def _entity(spec: EntitySpec) -> str:
    return f"_entity_{spec.table}"


def _entity_error(spec: EntitySpec) -> Column:
    """Code of the first unusable column of an entity, null if none."""
    entity = F.col(_entity(spec))
    error = F.when(entity.isNull(), "ROW_NULL")
    for field in spec.fields:
        if field.required_code is not None:
            error = error.when(coerce.is_missing(field, entity), field.required_code)
    return error


def judge(
    df: DataFrame,
    specs: Sequence[EntitySpec],
    *,
    expected_table: str | None = None,
    strict_ops: bool = False,
) -> DataFrame:
    """Read every event once and decide where it goes.

    Input: rows (ingest_ts, raw_json) and, where known, row, src_file, src_row. Output: one row per event with
    the CDC columns, one struct per entity and ``error`` (null for a good event). ``expected_table`` makes
    events of another table a TABLE_MISMATCH. ``strict_ops`` rejects operations other than c, u, r and d.
    """
    specs = list(specs)
    tables = [s.table for s in specs]
    carried = [c for c in df.columns if c not in ("ingest_ts", "raw_json", "src_file", "src_row")]
    # One entity: the images are read straight into its columns. Several: they stay VARIANT until the table is known.
    single = specs[0] if len(specs) == 1 else None
    opened = open_envelope(with_input_defaults(df), single)
    if single is not None:
        entities = {_entity(single): coerce.staged_entity(single, F.col("_image"), F.col("_exact"))}
    else:
        of_table = {
            f"{_entity(s)}_image": F.when(
                F.col("src_table") == s.table, F.try_variant_get("_image", "$", coerce.image_type(s))
            )
            for s in specs
        }
        opened = pin(opened, **of_table)
        entities = {
            _entity(s): coerce.staged_entity(s, image := F.col(f"{_entity(s)}_image"), F.when(image.isNotNull(), F.col("_image")))
            for s in specs
        }
    read = pin(opened, **entities)

    per_entity = F.lit(None).cast("string")
    for s in specs:
        per_entity = F.when(F.col("src_table") == s.table, _entity_error(s)).otherwise(per_entity)
    checks = [envelope_error()]
    if expected_table is not None:
        checks.append(F.when(F.col("src_table") != expected_table, "TABLE_MISMATCH"))
    if strict_ops:
        checks.append(F.when(~F.col("op").isin(*AFTER_OPS, "d"), "UNSUPPORTED_OP"))
    checks += [
        F.when(~F.col("src_table").isin(*tables), "UNSUPPORTED_TABLE"),
        per_entity,
        F.when(~times.in_date_range(F.col("ts_ms")), "TS_MS_RANGE"),
    ]
    return read.select(
        *carried,
        "ingest_ts",
        "raw_json",
        "src_offset",
        "src_file",
        "src_row",
        "op",
        "src_table",
        "ts_ms",
        "lsn",
        *[_entity(s) for s in specs],
        F.coalesce(*checks).alias("error"),
        F.lit(expected_table).cast("string").alias("expected_table"),
    )


def _stage_columns(judged: DataFrame, spec: EntitySpec, keep_raw_json: bool) -> list[Column]:
    entity = F.col(_entity(spec))
    cdc = {
        "table": F.col("src_table"),
        "event_date": times.event_date(F.col("ts_ms")),
        "is_delete": F.col("op") == "d",
    }
    fields = {f.name: entity[f.name] for f in spec.fields}
    return [
        (cdc.get(f.name, F.col(f.name)) if i < len(CDC_FIELDS) else fields.get(f.name, F.col(f.name))).alias(f.name)
        for i, f in enumerate(stage_schema(spec, keep_raw_json).fields)
    ]


def stage_rows(judged: DataFrame, spec: EntitySpec, *, keep_raw_json: bool = False, extra: Sequence[str] = ()):
    """Typed stage rows of one entity. ``extra`` names carried input columns to append."""
    good = judged.where(F.col("error").isNull() & (F.col("src_table") == spec.table))
    return good.select(*_stage_columns(judged, spec, keep_raw_json), *extra)


def _quarantine_columns(judged: DataFrame, keep_raw_json: bool) -> list[Column]:
    in_envelope = F.col("error").isin(*ENVELOPE_CODES)
    mismatch = F.col("error") == "TABLE_MISMATCH"
    typed = ~in_envelope & ~mismatch
    raw = F.col("raw_json") if keep_raw_json else F.when(in_envelope, F.col("raw_json"))
    row = F.col("row") if "row" in judged.columns else F.col("src_row")
    return [
        row.alias("row"),
        F.col("error"),
        F.col("ingest_ts"),
        raw.alias("raw_json"),
        F.when(mismatch, F.col("expected_table")).alias("expected_table"),
        F.when(mismatch, F.col("src_table")).alias("actual_table"),
        F.when(typed, F.col("src_table")).alias("table"),
        F.when(typed, F.col("op")).alias("op"),
        F.when(typed, F.col("ts_ms")).alias("ts_ms"),
        F.when(typed, F.col("lsn")).alias("lsn"),
    ]


def quarantine_rows(judged: DataFrame, *, keep_raw_json: bool = False, extra: Sequence[str] = ()) -> DataFrame:
    """Rejected events. Which columns are filled depends on how far an event got: envelope errors carry the raw
    text, mismatches the two table names, entity errors the event's table, op, ts_ms and lsn."""
    return judged.where("error is not null").select(*_quarantine_columns(judged, keep_raw_json), *extra)


def split_rows(judged: DataFrame, spec: EntitySpec, keep_raw_json: bool, keep_rejected_json: bool) -> DataFrame:
    """source, run_id, kind (stage or bad), and a struct of that kind's columns: every event once, in one pass."""
    good = F.col("error").isNull() & (F.col("src_table") == spec.table)
    stage = _stage_columns(judged, spec, keep_raw_json)
    bad = _quarantine_columns(judged, keep_rejected_json)
    return judged.where(good | F.col("error").isNotNull()).select(
        "source",
        "run_id",
        F.when(good, F.struct(*stage)).alias("stage"),
        F.when(~good, F.struct(*bad)).alias("bad"),
        F.when(good, "stage").otherwise("bad").alias("kind"),
    )


def structure(
    df: DataFrame,
    specs: Sequence[EntitySpec],
    *,
    expected_table: str | None = None,
    keep_raw_json: bool = False,
    strict_ops: bool = False,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Stage frame per entity, and the quarantine frame."""
    judged = judge(df, specs, expected_table=expected_table, strict_ops=strict_ops)
    stages = {s.table: stage_rows(judged, s, keep_raw_json=keep_raw_json) for s in specs}
    return stages, quarantine_rows(judged, keep_raw_json=keep_raw_json)


def stage_summary(judged: DataFrame) -> DataFrame:
    """One row: input events, stage rows, rejected events."""
    return judged.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("error").isNull()).alias("stage_rows"),
        F.count_if(F.col("error").isNotNull()).alias("bad_rows"),
    )


def rows_per_date(stage: DataFrame) -> DataFrame:
    return stage.groupBy("event_date").agg(F.count("*").alias("n_rows"))


def quarantine_histogram(quarantine: DataFrame) -> DataFrame:
    """Rejected events per table and code; the table is null where the event did not get that far."""
    table = F.coalesce("table", "actual_table")
    return quarantine.groupBy(table.alias("table"), "error").agg(F.count("*").alias("n_rows"))
