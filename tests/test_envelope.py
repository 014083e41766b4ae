"""Codes, coercion and wrapping over literal events."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark import ORDERS, USERS
from tidemark.operators import envelope, structure

ORDER = {
    "order_id": 1, "user_id": 2, "status": "created", "total_amount": "1.50", "currency": "EUR",
    "ordered_at": "2024-01-01T00:00:00.000000Z", "updated_at": None, "is_deleted": False,
}
USER = {"user_id": 7, "email": "a@b.c", "country_code": "SE", "created_at": None, "updated_at": None}


def event(op="c", image=ORDER, table="orders", ts_ms=1704067200000, lsn=5, **payload):
    sides = {"before": image if op == "d" else None, "after": None if op == "d" else image}
    return json.dumps({"payload": {**sides, "source": {"table": table, "lsn": lsn}, "op": op, "ts_ms": ts_ms, **payload}})


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "row long, raw_json string")


def without(d, *names):
    return {k: v for k, v in d.items() if k not in names}


def _drop(key):
    e = json.loads(event())
    del e["payload"][key]
    return json.dumps(e)


CODES = [
    ("{not valid json", "JSON_PARSE"),
    ("", "JSON_PARSE"),
    (None, "JSON_PARSE"),
    ('{"a":1} xyz', "JSON_PARSE"),
    ('{"a":1} {"b":2}', "JSON_PARSE"),
    (event() + "," + event(), "JSON_PARSE"),
    (event() + "],[1", "JSON_PARSE"),
    ("{'a':1}", "JSON_PARSE"),
    ('{"payload":{"op":NaN}}', "JSON_PARSE"),
    ("[1,2]", "JSON_NOT_OBJECT"),
    ("5", "JSON_NOT_OBJECT"),
    ("null", "JSON_NOT_OBJECT"),
    ('"text"', "JSON_NOT_OBJECT"),
    ("{}", "MISSING_PAYLOAD"),
    ('{"payload":[1]}', "MISSING_PAYLOAD"),
    ('{"payload":"x"}', "MISSING_PAYLOAD"),
    (_drop("op"), "MISSING_OP"),
    (event(op=5), "MISSING_OP"),
    (event(op=True), "MISSING_OP"),
    (event(op={"c": 1}), "MISSING_OP"),
    ('{"payload":{"payload":' + json.dumps(json.loads(event())["payload"]) + "}}", "MISSING_OP"),
    (_drop("source"), "MISSING_SOURCE"),
    (event(source="orders"), "MISSING_SOURCE"),
    (event(source={"lsn": 1}), "MISSING_SOURCE_TABLE"),
    (event(table=12), "MISSING_SOURCE_TABLE"),
    (event(ts_ms=None), "MISSING_TS_MS"),
    (event(ts_ms="soon"), "MISSING_TS_MS"),
    (event(ts_ms="1e3"), "MISSING_TS_MS"),
    (event(after=None), "AFTER_NULL_FOR_CU"),
    (_drop("after"), "AFTER_NULL_FOR_CU"),
    (event(op="u", after=None), "AFTER_NULL_FOR_CU"),
    (event(op="d", before=None), "BEFORE_NULL_FOR_D"),
    (event(table="users"), "TABLE_MISMATCH"),
    (event(after="x"), "ROW_NULL"),
    (event(op="d", before=[1]), "ROW_NULL"),
    (event(op="r", after=None), "ROW_NULL"),
    (event(op="t"), "ROW_NULL"),
    (event(image={}), "ORDER_ID_NULL"),
    (event(image={**ORDER, "order_id": "3.9"}), "ORDER_ID_NULL"),
    (event(image={**ORDER, "user_id": {}}), "USER_ID_NULL"),
    (event(image={**ORDER, "status": ""}), "STATUS_NULL"),
    (event(image={**ORDER, "total_amount": None}), "TOTAL_AMOUNT_NULL"),
    (event(image=without(ORDER, "currency")), "CURRENCY_NULL"),
    (event(image={**ORDER, "ordered_at": "2024-01-01"}), "ORDERED_AT_NULL"),
    (event(image={**ORDER, "ordered_at": 1704067200000}), "ORDERED_AT_NULL"),
    (event(ts_ms=253402300800000), "TS_MS_RANGE"),
    (event(ts_ms=253402300800000, image={}), "ORDER_ID_NULL"),
    (event(), None),
    (event(image={**ORDER, "total_amount": ""}), None),
    (event(lsn=None), None),
    (event(op="d"), None),
    (event(op="t", before=ORDER, after=None), None),
    ("  " + event() + "\n", None),
]


def test_codes(spark):
    judged = structure.judge(frame(spark, [text for text, _ in CODES]), [ORDERS], expected_table="orders")
    got = {r["row"]: r["error"] for r in judged.select("row", "error").collect()}
    assert {i: got[i] for i in got} == {i: code for i, (_, code) in enumerate(CODES)}


def test_codes_with_several_entities(spark):
    """The same codes when the table is found out from the event; a table without a spec is unsupported."""
    cases = [(t, c) for t, c in CODES if c != "TABLE_MISMATCH"]
    cases += [
        (event(table="other"), "UNSUPPORTED_TABLE"),
        (event(table="users", image=USER), None),
        (event(table="users", image={**USER, "email": ""}), "EMAIL_NULL"),
        (event(table="users", image={**USER, "country_code": None}), "COUNTRY_CODE_NULL"),
        (event(table="users", image={}), "USER_ID_NULL"),
    ]
    judged = structure.judge(frame(spark, [text for text, _ in cases]), [USERS, ORDERS])
    got = {r["row"]: r["error"] for r in judged.select("row", "error").collect()}
    assert got == {i: code for i, (_, code) in enumerate(cases)}


def test_generic_parse_agrees(spark):
    """parse_envelope finds the same envelope codes and keeps both images."""
    cases = [(t, c if c in envelope.ENVELOPE_CODES else None) for t, c in CODES]
    parsed = envelope.parse_envelope(frame(spark, [text for text, _ in cases]))
    got = {r["row"]: r["error"] for r in parsed.select("row", "error").collect()}
    assert got == {i: code for i, (_, code) in enumerate(cases)}


COERCED = {
    "order_id": [(12, 12), ("12", 12), (" 12 ", 12), (3.9, 3), (-3.9, -3), (True, 1), (12.0, 12)],
    "is_deleted": [
        (True, True), ("T", True), ("yes", True), ("1", True), (2, True), (0.5, True), (1, True), (-1, True),
        (False, False), ("f", False), ("NO", False), ("0", False), (0, False), (0.0, False),
        ("y", None), ("on", None), ("", None), ([], None), ("2", None), ("0.5", None), (None, None),
    ],
    "status": [("a", "a"), (1.5, "1.5"), (7, "7"), ("1.50", "1.50"), (True, "true"), ("  ", "  "), ("é\n\"", "é\n\"")],
    "updated_at": [
        ("2026-01-12T21:50:09.953905Z", "2026-01-12T21:50:09.953905Z"), ("2026-01-12", None), (1768254609953, None),
        ("NOT A DATE", "NOT A DATE"), (None, None),
    ],
    "total_amount": [("120.50", "120.50"), (120.5, "120.5"), ("", ""), (80.0, "80.0"), (80, "80"), ("LxI=", "LxI=")],
    "currency": [({"a": 1}, '{"a":1}')],
}


@pytest.mark.parametrize("several", [False, True])
def test_coercion(spark, several):
    cases = [(field, value, want) for field, pairs in COERCED.items() for value, want in pairs]
    texts = [event(image={**ORDER, field: value}) for field, value, _ in cases]
    specs = [USERS, ORDERS] if several else [ORDERS]
    judged = structure.judge(frame(spark, texts), specs)
    rows = {r["row"]: r for r in structure.stage_rows(judged, ORDERS, extra=["row"]).collect()}
    got = [rows[i][field] if i in rows else "rejected" for i, (field, _, _) in enumerate(cases)]
    assert list(zip(cases, got)) == [(c, c[2]) for c in cases]


def test_number_spellings(spark):
    """Spellings Python's encoder would not write."""
    texts = [
        event().replace('"lsn": 5', f'"lsn": {lsn}').replace('"status": "created"', f'"status": {status}')
        for lsn, status in [("3.9", "1.50"), ('"7"', "1e2"), ("true", '"1e2"'), ("99999999999999999999", "10")]
    ]
    judged = structure.judge(frame(spark, texts), [ORDERS])
    rows = structure.stage_rows(judged, ORDERS, extra=["row"]).orderBy("row").collect()
    assert [(r["lsn"], r["status"]) for r in rows] == [(3, "1.5"), (7, "100.0"), (1, "1e2"), (None, "10")]


def test_last_duplicate_key_wins(spark):
    text = event().replace('"op": "c"', '"op": "x", "op": "u"').replace('"status": "created"', '"status": 1, "status": "z"')
    row = structure.stage_rows(structure.judge(frame(spark, [text]), [ORDERS]), ORDERS).first()
    assert (row["op"], row["status"]) == ("u", "z")


def test_event_dates(spark):
    texts = [event(ts_ms=t) for t in (-1, 0, 253402300799999, -62135596800000)]
    rows = structure.stage_rows(structure.judge(frame(spark, texts), [ORDERS], expected_table="orders"), ORDERS)
    assert {r["ts_ms"]: r["event_date"] for r in rows.collect()} == {
        -1: "1969-12-31", 0: "1970-01-01", 253402300799999: "9999-12-31", -62135596800000: "0001-01-01",
    }


def test_quarantine_shapes(spark):
    texts = ["{bad", event(table="users"), event(image={})]
    bad = structure.quarantine_rows(structure.judge(frame(spark, texts), [ORDERS], expected_table="orders"))
    rows = {r["row"]: {k: v for k, v in r.asDict().items() if v is not None} for r in bad.drop("ingest_ts").collect()}
    assert rows == {
        0: {"row": 0, "error": "JSON_PARSE", "raw_json": "{bad"},
        1: {"row": 1, "error": "TABLE_MISMATCH", "expected_table": "orders", "actual_table": "users"},
        2: {"row": 2, "error": "ORDER_ID_NULL", "table": "orders", "op": "c", "ts_ms": 1704067200000, "lsn": 5},
    }


def test_input_defaults_and_raw_json(spark):
    df = spark.createDataFrame([("", event()), (None, event()), ("2024-01-01T00:00:00Z", event())], "ingest_ts string, raw_json string")
    stages, bad = structure.structure(df, [ORDERS], expected_table="orders", keep_raw_json=True)
    rows = stages["orders"].collect()
    assert bad.count() == 0 and all(r["raw_json"] == event() for r in rows)
    assert sorted(r["ingest_ts"] == "2024-01-01T00:00:00Z" for r in rows) == [False, False, True]
    assert all("T" in r["ingest_ts"] for r in rows)


def test_strict_ops(spark):
    judged = structure.judge(frame(spark, [event(op="t", before=ORDER, after=None), event()]), [ORDERS], strict_ops=True)
    assert {r["row"]: r["error"] for r in judged.collect()} == {0: "UNSUPPORTED_OP", 1: None}


def test_wrap_kafka(spark):
    values = [b'{"a": 1.50, "a": 2}', b'plain "text"', b'{"a":1} x', b"\xffok", None, b"5", b"1,2"]
    rows = [(b"k", v, "db.public.users", 3, i, 1.5) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset long, s double")
    df = df.withColumn("timestamp", F.timestamp_seconds("s")).drop("s")
    out = envelope.wrap_kafka(df).orderBy("offset").collect()
    assert [r["offset"] for r in out] == [0, 1, 2, 3, 5, 6]
    assert {(r["source"], r["table"]) for r in out} == {("db", "users")}
    payloads = [json.loads(r["raw_json"])["payload"] for r in out]
    assert payloads == [{"a": 2}, 'plain "text"', '{"a":1} x', "�ok", 5, "1,2"]
    assert '"payload":{"a": 1.50, "a": 2}}' in out[0]["raw_json"]
    kafka = json.loads(out[0]["raw_json"])["kafka"]
    assert kafka == {"topic": "db.public.users", "partition": 3, "offset": 0, "timestamp_ms": 1500, "key": "k"}


def test_wrapped_event_is_staged(spark):
    """A record of the writer's shape goes through the same parser and keeps its offset."""
    bare = json.dumps(json.loads(event())["payload"]).encode()
    df = spark.createDataFrame([(None, bare, "db.public.orders", 0, 42)], "key binary, value binary, topic string, partition int, offset long")
    wrapped = envelope.wrap_kafka(df.withColumn("timestamp", F.timestamp_seconds(F.lit(1))))
    row = structure.stage_rows(structure.judge(wrapped.select("raw_json"), [ORDERS]), ORDERS).first()
    assert (row["order_id"], row["src_offset"]) == (1, 42)


def test_encode_round_trip(spark):
    image = F.struct(F.lit(7).alias("user_id"), F.lit("ä\"b").alias("email"), F.lit("SE").alias("country_code"))
    df = envelope.encode_envelope(
        spark.range(1), table="users", op="u", ts_ms=F.lit(1000), lsn=F.lit(None).cast("long"), before=image, after=image
    )
    e = json.loads(df.first()["raw_json"])
    assert e["schema"]["name"] == "source_db.public.users.Envelope"
    assert e["payload"]["transaction"] is None and e["payload"]["source"]["lsn"] is None
    row = structure.stage_rows(structure.judge(df, [USERS], expected_table="users"), USERS).first()
    assert (row["user_id"], row["email"], row["lsn"]) == (7, 'ä"b', None)


def test_one_reading_per_event(spark):
    """The text is read once, whatever is filtered on top; only the conditional second look is a parse of its own."""
    judged = structure.judge(frame(spark, [event()]), [ORDERS], expected_table="orders")
    for df in (structure.stage_rows(judged, ORDERS), structure.quarantine_rows(judged), structure.stage_summary(judged)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1 and plan.count("parseJson(") <= 1


def test_plain_events_need_no_second_look(spark):
    """Usual events are settled by the first reading; text that only a JSON type can settle is not."""
    usual = [event(), event(op="d"), event(lsn=None), event(image={**ORDER, "status": "v1.10"})]
    unusual = [event(ts_ms="12.5"), event(image={**ORDER, "total_amount": 1.5}), event(image={**ORDER, "is_deleted": 2})]
    opened = envelope.open_envelope(envelope.with_input_defaults(frame(spark, usual + unusual)), ORDERS)
    looked = {r["row"]: r["again"] for r in opened.selectExpr("row", "_doc is not null again").collect()}
    assert looked == {i: i >= len(usual) for i in range(len(usual) + len(unusual))}
