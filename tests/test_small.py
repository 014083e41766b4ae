"""Topics, source options, selections, typed views, entry point."""

import base64
import datetime
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tidemark import ORDERS, EntitySpec, FieldSpec
from tidemark.functions import topics
from tidemark.operators import quality, selection, union
from tidemark.sources import bronze
from workload.oracle import ORACLE
from workload.queries import registry


def test_topics(spark):
    names = ["db.public.users", "a.b.c.d", "a.b", "x", "a..", "source_db.public.orders"]
    df = spark.createDataFrame([(n,) for n in names], "t string")
    rows = df.select("t", topics.topic_source(F.col("t")).alias("s"), topics.topic_table(F.col("t")).alias("n")).collect()
    assert [(r["s"], r["n"]) for r in rows] == [
        ("db", "users"), ("a", "d"), ("a.b", "unknown"), ("x", "unknown"), ("a", ""), ("source_db", "orders"),
    ]
    kept = df.where(topics.in_table_list(F.col("t"), ["public.users", "public.orders"])).count()
    assert kept == 2
    assert topics.parse_topic_list(" a, b ,,c ") == ["a", "b", "c"] and topics.parse_topic_list("") == []


def test_kafka_options():
    with pytest.raises(ValueError):
        bronze.kafka_options("h:1", [])
    options = bronze.kafka_options("h:1", ["a", "b"], group_id="g", max_records=10, starting_offsets='{"a":{"0":5}}')
    assert options == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "a,b", "startingOffsets": '{"a":{"0":5}}', "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "10",
    }
    assert bronze.kafka_options("h:1", ["a"])["startingOffsets"] == "earliest"


def test_starting_offsets(spark):
    ck = spark.createDataFrame([("a", 0, 4), ("a", 1, 9)], "topic string, partition int, last_committed_offset long")
    assert selection.starting_offsets(ck).first()[0] in ('{"a":{"0":5,"1":10}}', '{"a":{"1":10,"0":5}}')


def test_spec_checks():
    with pytest.raises(ValueError):
        FieldSpec("x", "money")
    with pytest.raises(ValueError):
        EntitySpec("t", "id", (FieldSpec("x", "int"),))


def test_typed_view(spark):
    rows = [(1, "120.50", "2024-01-01T10:00:00.123456Z"), (2, "LxI=", "NOT A DATE"), (3, "", None)]
    df = spark.createDataFrame(rows, "order_id long, total_amount string, ordered_at string")
    got = quality.typed_view(df, ORDERS).collect()
    assert [r["total_amount"] for r in got] == [Decimal("120.50"), None, None]
    assert [r["ordered_at"] for r in got] == [datetime.datetime(2024, 1, 1, 10, 0, 0, 123456), None, None]
    encoded = quality.typed_view(spark.createDataFrame([("LxI=",), ("/w==",), ("AA==",), ("0O4=",), ("!",)], "total_amount string"), ORDERS, encoded_decimals=True)
    assert [r[0] for r in encoded.collect()] == [Decimal("120.50"), Decimal("-0.01"), Decimal("0.00"), Decimal("-120.50"), None]


@pytest.mark.parametrize("precision, scale", [(38, 0), (20, 2), (38, 10)])
def test_encoded_amounts_of_any_length(spark, precision, scale):
    """Null only where the declared precision can't hold the value; bytes that repeat the sign change nothing."""
    values = [s * 2**e + d for e in (0, 7, 8, 15, 54, 55, 56, 60, 63, 64, 65, 100, 125, 126) for s in (1, -1) for d in (-1, 0, 1)]
    values += [10**38 - 1, 1 - 10**38, 10**38, 2**127 - 1, -(2**127)]

    def encoded(value, more):
        size = next(n for n in range(1, 17) if -(1 << (8 * n - 1)) <= value < 1 << (8 * n - 1))
        return base64.b64encode(value.to_bytes(size + more, "big", signed=True)).decode()

    field = FieldSpec("a", "decimal", precision=precision, scale=scale)
    rows = [(i, encoded(v, more)) for i, v in enumerate(values) for more in (0, 3)]
    got = spark.createDataFrame(rows, "i int, a string").select("i", quality.typed(field, True)).collect()
    with localcontext(prec=60):
        want = {i: Decimal(v).scaleb(-scale) if abs(v) < 10**precision else None for i, v in enumerate(values)}
    assert len(got) == len(rows) and all(r["a"] == want[r["i"]] for r in got)


def test_orphans_and_union(spark):
    child = spark.createDataFrame([(1, 1), (2, 9), (3, None)], "id int, user_id int")
    parent = spark.createDataFrame([(1,)], "user_id int")
    assert [r["id"] for r in quality.orphans(child, parent, "user_id").collect()] == [2]
    both = union.promote_union([child, parent])
    assert both.columns == ["id", "user_id"] and both.count() == 4
    with pytest.raises(ValueError, match="nope"):
        union.require_columns(child, ["id", "nope"], "the frame")


def test_every_query_has_its_sql():
    """Every query of the reference's operators; some of those on training text can't be said in SQL."""
    assert set(registry()) == set(ORACLE)
    assert set(registry()) <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    df = driver.entry(spark)
    rows = df.collect()
    assert len(rows) == 12 and sum(r["ts_ms"] for r in rows) == 20479509606548
    assert df.columns == ["user_id", "event_id", "event_type", "op", "ts_ms", "lsn", "event_date"]


@pytest.mark.parametrize(
    "name", ["quarantine_by_code", "coerce_values", "current_null_lsn", "current_guarded_late", "merge_stats_incremental", "run_manifest"]
)
def test_against_sql(spark, name):
    """A sample of the registered queries against their SQL; check.py runs them all."""
    import duckdb

    from check import TABLES, rows_of

    sf_dir = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = driver.queries()[name](spark, sf_dir)
    result = con.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, result.fetchall())
