"""Change feeds derived from the driver's tables, the input of the registered queries and the bench."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import iso_micros, unix_millis
from tidemark.operators.envelope import envelope
from tidemark.specs import EVENTS, ORDERS, USERS

EVENTS_TOPIC = "source_db.public.events"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_rows(df: DataFrame) -> DataFrame:
    """Rows over all cores, however few parts their files have: making and parsing JSON costs far more than reading a table.
    By their values, since a spread without keys sorts the rows of a task first."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *df.columns)


def events_changes(spark: SparkSession, sf_dir: str, *, permuted: bool = False, spread: bool = False) -> DataFrame:
    """``events`` as change events keyed by user: op, ts_ms, lsn and the row image.

    ``permuted`` gives log positions that do not follow time, one in eleven missing, so that the two merge
    modes differ.
    """
    op = (
        F.when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "purchase", "r")
        .when(F.col("event_type") == "error", "d")
        .otherwise("u")
    )
    lsn = F.col("event_id")
    if permuted:
        lsn = F.when(lsn % 11 != 0, (lsn * 7919) % 1000003)
    events = table(spark, sf_dir, "events")
    return (spread_rows(events) if spread else events).select(
        "event_id",
        "user_id",
        "ts",
        op.alias("op"),
        unix_millis(F.col("ts")).alias("ts_ms"),
        lsn.alias("lsn"),
        F.struct(*[F.col(f.name) for f in EVENTS.fields]).alias("image"),
    )


def _sides(op: Column, image: Column) -> dict[str, Column]:
    return {"before": F.when(op == "d", image), "after": F.when(op != "d", image)}


def events_feed(spark: SparkSession, sf_dir: str, *, permuted: bool = False, spread: bool = False) -> DataFrame:
    """(event_id, raw_json) of every event."""
    op = F.col("op")
    raw = envelope(
        table=EVENTS.table, op=op, ts_ms=F.col("ts_ms"), lsn=F.col("lsn"), **_sides(op, F.col("image"))
    )
    return events_changes(spark, sf_dir, permuted=permuted, spread=spread).select("event_id", raw.alias("raw_json"))


def dirty_events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, raw_json) with one defect per class of ``event_id % 40``; class 12 is delivered twice."""
    defect = F.col("event_id") % 40
    changes = events_changes(spark, sf_dir).withColumn("defect", defect)
    op = (
        F.when(F.col("defect") == 6, "u").when(F.col("defect") == 7, "d").when(F.col("defect") == 9, "r")
        .otherwise(F.col("op"))
    )
    image = F.col("image")
    image = F.when(F.col("defect") == 10, image.withField("user_id", F.lit(None).cast("long"))).otherwise(image)
    image = F.when(F.col("defect") == 11, image.withField("event_type", F.lit(""))).otherwise(image)
    changes = changes.withColumn("op", op).withColumn("image", image)
    lost = F.col("defect").isin(6, 7, 9)
    sides = {k: F.when(~lost, v) for k, v in _sides(F.col("op"), F.col("image")).items()}

    source = F.struct(
        F.when(F.col("defect") == 8, "other").when(F.col("defect") != 4, EVENTS.table).alias("table"),
        F.col("lsn").alias("lsn"),
    )
    payload = F.struct(
        sides["before"].alias("before"),
        sides["after"].alias("after"),
        F.when(F.col("defect") != 3, source).alias("source"),
        F.when(F.col("defect") != 2, F.col("op")).alias("op"),
        F.when(F.col("defect") != 5, F.col("ts_ms")).alias("ts_ms"),
    )
    whole = F.to_json(F.struct(F.when(F.col("defect") != 1, payload).alias("payload")), {"ignoreNullFields": "false"})
    raw = F.when(F.col("defect") == 0, "{not valid json").otherwise(whole)
    copies = F.when(F.col("defect") == 12, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return changes.select("event_id", raw.alias("raw_json"), F.explode(copies).alias("copy")).drop("copy")


def kafka_records(spark: SparkSession, sf_dir: str, *, permuted: bool = False, spread: bool = False) -> DataFrame:
    """The event feed as Kafka-shaped records: four partitions by user, the event number as offset."""
    op = F.col("op")
    raw = envelope(
        table=EVENTS.table, op=op, ts_ms=F.col("ts_ms"), lsn=F.col("lsn"), bare=True, **_sides(op, F.col("image"))
    )
    return events_changes(spark, sf_dir, permuted=permuted, spread=spread).select(
        F.encode(F.col("user_id").cast("string"), "UTF-8").alias("key"),
        F.encode(raw, "UTF-8").alias("value"),
        F.lit(EVENTS_TOPIC).alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def users_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers and their nation as the users entity."""
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("user_id"),
        F.concat("c_name", F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("country_code"),
        F.lit(None).cast("string").alias("created_at"),
        F.lit(None).cast("string").alias("updated_at"),
    )


def orders_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the orders entity; amounts are text with two places, times ISO text."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("total_amount"),
        F.lit("EUR").alias("currency"),
        iso_micros(unix_millis(F.col("o_orderdate"))).alias("ordered_at"),
        F.lit(None).cast("string").alias("updated_at"),
        (F.col("o_orderkey") % 20 == 0).alias("is_deleted"),
    )


SNAPSHOT_TS_MS = 1704067200000  # 2024-01-01T00:00:00Z


def users_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    image = users_image(spark, sf_dir)
    raw = envelope(
        table=USERS.table, op="c", ts_ms=F.lit(SNAPSHOT_TS_MS) + F.col("user_id"), lsn=F.col("user_id"),
        after=F.struct(*[F.col(f.name) for f in USERS.fields]),
    )
    return image.select(raw.alias("raw_json"))


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    image = orders_image(spark, sf_dir)
    raw = envelope(
        table=ORDERS.table, op="c", ts_ms=F.lit(SNAPSHOT_TS_MS) + F.col("order_id"), lsn=F.col("order_id"),
        after=F.struct(*[F.col(f.name) for f in ORDERS.fields]),
    )
    return image.select(raw.alias("raw_json"))
