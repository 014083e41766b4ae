"""Change-event envelopes: write them from table rows, read them back, wrap stream records."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import coerce, topics
from tidemark.functions.times import now_micros_offset
from tidemark.operators.columns import or_null, pin
from tidemark.specs import EntitySpec

# Fixed values of the envelope format.
CONNECTOR_VERSION = "2.7.3.Final"
CONNECTOR_KIND = "postgresql"
CONNECTOR_NAME = "source_db"
DATABASE = "sample_source"
DB_SCHEMA = "public"

# Operations whose row image is ``after``: create, update, snapshot read.
AFTER_OPS = ("c", "u", "r")

# Codes of events rejected before their table is known, in the order they are checked.
ENVELOPE_CODES = (
    "JSON_PARSE",
    "JSON_NOT_OBJECT",
    "MISSING_PAYLOAD",
    "MISSING_OP",
    "MISSING_SOURCE",
    "MISSING_SOURCE_TABLE",
    "MISSING_TS_MS",
    "AFTER_NULL_FOR_CU",
    "BEFORE_NULL_FOR_D",
)

# Closing element put behind a text that is parsed again, see open_envelope.
_END = "~end of event~"


def envelope(
    *,
    table: str | Column,
    op: str | Column,
    ts_ms: Column,
    lsn: Column,
    before: Column | None = None,
    after: Column | None = None,
    txid: Column | None = None,
    bare: bool = False,
) -> Column:
    """JSON text of one change event. ``before`` and ``after`` are struct columns, None for JSON null.

    ``bare`` leaves out the schema block and the ``payload`` level, as records look on a topic whose converter
    runs without schemas.
    """
    table = F.lit(table) if isinstance(table, str) else table
    op = F.lit(op) if isinstance(op, str) else op
    null = F.lit(None).cast("string")
    schema = F.struct(
        F.lit("struct").alias("type"),
        F.lit(False).alias("optional"),
        F.concat(F.lit(f"{CONNECTOR_NAME}.{DB_SCHEMA}."), table, F.lit(".Envelope")).alias("name"),
    )
    source = F.struct(
        F.lit(CONNECTOR_VERSION).alias("version"),
        F.lit(CONNECTOR_KIND).alias("connector"),
        F.lit(CONNECTOR_NAME).alias("name"),
        ts_ms.alias("ts_ms"),
        F.lit("false").alias("snapshot"),
        F.lit(DATABASE).alias("db"),
        F.lit(DB_SCHEMA).alias("schema"),
        table.alias("table"),
        (null if txid is None else txid).alias("txId"),
        lsn.alias("lsn"),
    )
    payload = F.struct(
        (null if before is None else before).alias("before"),
        (null if after is None else after).alias("after"),
        source.alias("source"),
        null.alias("transaction"),
        op.alias("op"),
        ts_ms.alias("ts_ms"),
    )
    whole = payload if bare else F.struct(schema.alias("schema"), payload.alias("payload"))
    return F.to_json(whole, {"ignoreNullFields": "false"})


def encode_envelope(df: DataFrame, **parts) -> DataFrame:
    """Append ``raw_json``, the change event built by :func:`envelope` from columns of ``df``."""
    return df.withColumn("raw_json", envelope(**parts))


def snapshot_to_events(df: DataFrame, spec: EntitySpec, *, ts_ms: Column, lsn: Column | None = None) -> DataFrame:
    """Initial contents of a table as ``r`` events: one ``raw_json`` per row."""
    image = F.struct(*[F.col(f.name) for f in spec.fields])
    lsn = F.lit(None).cast("long") if lsn is None else lsn
    return df.select(envelope(table=spec.table, op="r", ts_ms=ts_ms, lsn=lsn, after=image).alias("raw_json"))


def wrap_kafka(df: DataFrame) -> DataFrame:
    """Stream records to bronze rows: (source, table, raw_json, topic, partition, offset).

    A value that is valid JSON is put into the wrapper letter for letter, so its numbers, key order and
    spelling survive; any other text becomes a JSON string and is quarantined by the stage job. Records
    without a value (tombstones) carry no event and are left out.
    """
    value = topics.utf8_text(F.col("value"))
    record = F.struct(
        "topic",
        "partition",
        "offset",
        F.unix_millis("timestamp").alias("timestamp_ms"),
        topics.utf8_text(F.col("key")).alias("key"),
    )
    held = F.when(F.col("_single"), F.col("_value")).otherwise(
        # The text as a JSON string: cut it out of {"s":"..."}.
        F.expr("""substring(to_json(struct(_value AS s)), 6, length(to_json(struct(_value AS s))) - 6)""")
    )
    wrapped = F.concat(
        F.lit('{"kafka":'), F.to_json(record, {"ignoreNullFields": "false"}), F.lit(',"payload":'), held, F.lit("}")
    )
    texts = df.withColumn("_value", value).where("_value is not null")
    return (
        pin(texts, _single=_is_json(F.col("_value")))
        .select(
            topics.topic_source(F.col("topic")).alias("source"),
            topics.topic_table(F.col("topic")).alias("table"),
            wrapped.alias("raw_json"),
            "topic",
            "partition",
            "offset",
        )
    )


def _is_json(text: Column) -> Column:
    """The text is exactly one JSON value: as an array of its own it has one element, and nothing follows."""
    alone = F.concat(F.lit("["), text, F.lit("]"))
    return F.try_parse_json(text).isNotNull() & (F.coalesce(F.json_array_length(alone), F.lit(0)) == 1)


# JSON as the standard has it: Spark's reader is more lenient by default.
_JSON_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def open_envelope(df: DataFrame, spec: EntitySpec | None = None) -> DataFrame:
    """Read ``raw_json`` once and add the envelope's parts and ``_late_error``, a code found on the way.

    Adds op, src_table, ts_ms, lsn, src_offset, ``_image`` (the row image the operation uses: the struct of
    ``spec``, or VARIANT), ``_exact`` (the same image as VARIANT for events in doubt, else null) and flags.

    The text is read as the first of two array elements: trailing text breaks the array or changes its size.
    Objects that are missing or of another JSON type read as null, a repeated key keeps its last value, and what
    the engine does not need is skipped. Events whose texts do not tell their JSON type, and events that are
    about to be rejected, are parsed a second time as a whole; Spark evaluates that branch for no other row.
    """
    image_ddl = "variant" if spec is None else coerce.image_type(spec)
    ddl = (
        f"array<struct<payload struct<op string, ts_ms string, before {image_ddl}, after {image_ddl}, "
        "source struct<`table` string, lsn string>>, kafka struct<`offset` string>>>"
    )
    text = F.concat(F.lit("["), F.col("raw_json"), F.lit(",{}]"))
    read = df.withColumn("_events", F.from_json(text, ddl, _JSON_OPTIONS))
    root = F.get("_events", 0)
    payload = root["payload"]
    op = payload["op"]
    flat = pin(
        read,
        _op=op,
        _table=payload["source"]["table"],
        _ts=payload["ts_ms"],
        _lsn=payload["source"]["lsn"],
        src_offset=root["kafka"]["offset"].try_cast("bigint"),
        _image=F.when(op.isin(*AFTER_OPS), payload["after"]).otherwise(payload["before"]),
        _readable=F.coalesce(F.size("_events") == 2, F.lit(False)) & root.isNotNull(),
        _has_payload=payload.isNotNull(),
        _has_source=payload["source"].isNotNull(),
    )
    image = F.col("_image")
    no_image = coerce.is_absent(image) if spec is None else image.isNull()
    no_image = F.col("_has_source") & F.col("_op").isin("c", "u", "d") & no_image
    doubts = [
        ~F.col("_readable"),
        coerce.name_in_doubt(F.col("_op")),
        coerce.name_in_doubt(F.col("_table")),
        coerce.int_in_doubt(F.col("_ts")),
        coerce.int_in_doubt(F.col("_lsn")),
        no_image,
    ]
    if spec is not None:
        doubts.append(coerce.entity_in_doubt(spec, image, F.col("raw_json")))
    again = F.try_parse_json(F.concat(F.lit("["), F.col("raw_json"), F.lit(f',"{_END}"]')))
    looked = pin(flat, _no_image=no_image, _doc=F.when(coerce.any_of(doubts), again))

    doc, after = F.col("_doc"), F.col("_op").isin(*AFTER_OPS)

    def at(path: str) -> Column:
        return F.try_variant_get(doc, path, "variant")

    def exact(path: str, convert, plain: Column) -> Column:
        return F.when(doc.isNotNull(), convert(at(path))).otherwise(plain)

    settled = pin(
        looked,
        op=exact("$[0].payload.op", _text_only, F.col("_op")),
        src_table=exact("$[0].payload.source.table", _text_only, F.col("_table")),
        ts_ms=exact("$[0].payload.ts_ms", coerce.to_int, F.col("_ts").try_cast("bigint")),
        lsn=exact("$[0].payload.source.lsn", coerce.to_int, F.col("_lsn").try_cast("bigint")),
        _exact=F.when(after, at("$[0].payload.after")).otherwise(at("$[0].payload.before")),
    )
    single = F.coalesce(F.try_variant_get(doc, "$[1]", "string") == _END, F.lit(False)) & at("$[2]").isNull()
    unreadable = F.when(single, "JSON_NOT_OBJECT").otherwise("JSON_PARSE")
    missing = F.when(F.col("_op") == "d", "BEFORE_NULL_FOR_D").otherwise("AFTER_NULL_FOR_CU")
    late = F.when(~F.col("_readable"), unreadable).when(
        F.col("_no_image"), F.when(coerce.is_absent(F.col("_exact")), missing)
    )
    return settled.withColumn("_late_error", late)


def _text_only(value: Column) -> Column:
    """Text of a JSON string, null for any other JSON type."""
    return F.when(coerce.is_json_string(value), coerce.to_text(value))


def envelope_error() -> Column:
    """Code of the first failed envelope check over the columns of :func:`open_envelope`, null if none."""
    return (
        F.when(~F.col("_readable"), F.col("_late_error"))
        .when(~F.col("_has_payload"), "MISSING_PAYLOAD")
        .when(F.col("op").isNull(), "MISSING_OP")
        .when(~F.col("_has_source"), "MISSING_SOURCE")
        .when(F.col("src_table").isNull(), "MISSING_SOURCE_TABLE")
        .when(F.col("ts_ms").isNull(), "MISSING_TS_MS")
        .otherwise(F.col("_late_error"))
    )


def with_input_defaults(df: DataFrame) -> DataFrame:
    """Bronze rows with the stamps, texts and origin columns the stage operators expect."""
    return df.select(
        *[c for c in df.columns if c not in ("ingest_ts", "raw_json", "src_file", "src_row")],
        F.coalesce(F.nullif(or_null(df, "ingest_ts", "string"), F.lit("")), now_micros_offset()).alias("ingest_ts"),
        F.coalesce("raw_json", F.lit("")).alias("raw_json"),
        or_null(df, "src_file", "string"),
        or_null(df, "src_row", "long"),
    )


def parse_envelope(df: DataFrame) -> DataFrame:
    """Add op, src_table, ts_ms, lsn, before, after (both VARIANT) and error to (ingest_ts, raw_json) rows."""
    defaults = with_input_defaults(df)
    payload = F.get("_events", 0)["payload"]
    return pin(open_envelope(defaults), error=envelope_error()).select(
        *defaults.columns,
        "op",
        "src_table",
        "ts_ms",
        "lsn",
        payload["before"].alias("before"),
        payload["after"].alias("after"),
        "error",
    )
