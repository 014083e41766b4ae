"""One query per operator, each over whole tables. Names match workload.oracle."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import EVENTS, ORDERS, USERS, FieldSpec, configure
from tidemark.functions import coerce, times, topics
from tidemark.operators import dedupe, envelope, merge, offsets, quality, selection, structure, union
from tidemark.plans.compact import compact, compact_rows
from tidemark.plans.merge import current_table, run_merge
from tidemark.plans.pipeline import run_pipeline
from tidemark.plans.structure import structure_events, structure_file
from tidemark.session import shared_dir
from tidemark.sources import bronze, change_log, fs, silver
from tidemark.sources.ledger import Ledger
from tidemark.streaming.completeness import date_states, track_dates
from tidemark.streaming.current import follow
from tidemark.streaming.ingest import batch_rows, ingest, land_batch
from tidemark.streaming.keyed import keep_current, kept_current
from workload import feeds

STATE = ["user_id", "event_id", "event_type", "op", "ts_ms", "lsn", "event_date"]

_REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    _REGISTRY[fn.__name__] = run
    return run


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_REGISTRY)


def events_stage(spark: SparkSession, sf_dir: str, *, permuted: bool = False, spread: bool = False) -> DataFrame:
    """Stage rows of the event feed, through JSON and back."""
    feed = feeds.events_feed(spark, sf_dir, permuted=permuted, spread=spread)
    judged = structure.judge(feed, [EVENTS], expected_table="events")
    return structure.stage_rows(judged, EVENTS)


def dirty_judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure.judge(feeds.dirty_events_feed(spark, sf_dir), [EVENTS], expected_table="events")


def work_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# Envelopes ---------------------------------------------------------------------------------------------------


@query
def envelope_encode(spark, sf_dir):
    """Table rows to change events, looked at with plain JSON paths."""
    feed = feeds.events_feed(spark, sf_dir)

    def at(path: str):
        return F.get_json_object("raw_json", f"$.{path}")

    return feed.select(
        "event_id",
        at("schema.name").alias("schema_name"),
        at("payload.op").alias("op"),
        at("payload.ts_ms").cast("long").alias("ts_ms"),
        at("payload.source.table").alias("source_table"),
        at("payload.source.lsn").cast("long").alias("lsn"),
        at("payload.before.user_id").cast("long").alias("before_user"),
        at("payload.after.user_id").cast("long").alias("after_user"),
    )


@query
def envelope_parse(spark, sf_dir):
    parsed = envelope.parse_envelope(feeds.events_feed(spark, sf_dir))
    return parsed.select(
        "event_id",
        "op",
        "src_table",
        "ts_ms",
        "lsn",
        times.event_date(F.col("ts_ms")).alias("event_date"),
        coerce.is_absent(F.col("before")).alias("no_before"),
        coerce.is_absent(F.col("after")).alias("no_after"),
        "error",
    )


@query
def iso_times(spark, sf_dir):
    changes = feeds.events_changes(spark, sf_dir)
    return changes.select(
        "event_id",
        times.iso_micros(F.col("ts_ms")).alias("iso"),
        times.event_date(F.col("ts_ms")).alias("event_date"),
    )


@query
def topic_route(spark, sf_dir):
    """Topic names of all shapes to (source, table)."""
    events = feeds.table(spark, sf_dir, "events")
    topic = (
        F.when(F.col("event_type") == "signup", F.concat(F.lit("shop.public.t"), F.col("user_id")))
        .when(F.col("event_type") == "click", F.concat(F.lit("a.b.c.t"), F.col("user_id")))
        .when(F.col("event_type") == "view", F.concat(F.lit("a.t"), F.col("user_id")))
        .otherwise(F.concat(F.lit("t"), F.col("user_id")))
    )
    routed = events.select(topics.topic_source(topic).alias("source"), topics.topic_table(topic).alias("table"))
    return routed.groupBy("source", "table").agg(F.count("*").alias("n_records"))


@query
def table_include_list(spark, sf_dir):
    """Only topics whose schema.table is on the list."""
    records = feeds.table(spark, sf_dir, "events").withColumn(
        "topic", F.concat(F.lit("db."), F.when(F.col("value") > 20, "public.").otherwise("audit."), F.col("event_type"))
    )
    kept = records.where(topics.in_table_list(F.col("topic"), ["public.click", "public.view"]))
    return kept.groupBy("topic").agg(F.count("*").alias("n_records"))


@query
def record_envelope(spark, sf_dir):
    """Stream records wrapped for bronze; every seventh value is not JSON, every eleventh is a tombstone."""
    records = feeds.kafka_records(spark, sf_dir).withColumn(
        "value",
        F.when(F.col("offset") % 11 == 0, F.lit(None))
        .when(F.col("offset") % 7 == 0, F.encode(F.concat(F.lit('not "json" '), F.col("offset")), "UTF-8"))
        .otherwise(F.col("value")),
    )
    wrapped = envelope.wrap_kafka(records)

    def at(path: str):
        return F.get_json_object("raw_json", f"$.{path}")

    return wrapped.select(
        "source",
        "table",
        at("kafka.partition").cast("int").alias("partition"),
        at("kafka.offset").cast("long").alias("offset"),
        at("kafka.timestamp_ms").cast("long").alias("timestamp_ms"),
        at("kafka.key").alias("key"),
        F.when(F.col("offset") % 7 == 0, at("payload")).alias("text_payload"),
        at("payload.source.lsn").cast("long").alias("lsn"),
    )


@query
def utf8_text(spark, sf_dir):
    """Document bytes as text, unchanged where they are valid and repaired where a byte is broken."""
    docs = feeds.table(spark, sf_dir, "documents")
    data = F.when(F.col("doc_id") % 3 == 0, F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF")))).otherwise(
        F.encode("text", "UTF-8")
    )
    return docs.select("doc_id", F.md5(topics.utf8_text(data)).alias("text_md5"))


# Stage and quarantine ----------------------------------------------------------------------------------------


@query
def quarantine_by_code(spark, sf_dir):
    return structure.quarantine_histogram(structure.quarantine_rows(dirty_judged(spark, sf_dir)))


@query
def quarantine_detail(spark, sf_dir):
    """Every rejected event with the columns its kind of error fills."""
    bad = structure.quarantine_rows(dirty_judged(spark, sf_dir), extra=["event_id"])
    return bad.select(
        "event_id",
        "error",
        F.col("raw_json").isNotNull().alias("has_raw"),
        "expected_table",
        "actual_table",
        "table",
        "op",
        "ts_ms",
        "lsn",
    )


@query
def stage_summary(spark, sf_dir):
    return structure.stage_summary(dirty_judged(spark, sf_dir))


@query
def stage_rows_per_date(spark, sf_dir):
    return structure.rows_per_date(structure.stage_rows(dirty_judged(spark, sf_dir), EVENTS))


@query
def stage_rows(spark, sf_dir):
    """All stage rows of the dirty feed with every column."""
    stage = structure.stage_rows(dirty_judged(spark, sf_dir), EVENTS)
    return stage.drop("ingest_ts", "src_offset", "src_file", "src_row")


@query
def unknown_op_staged(spark, sf_dir):
    """An operation of another kind takes its columns from ``before`` and is staged; strictly, it is rejected."""
    changes = feeds.events_changes(spark, sf_dir).withColumn("op", F.when(F.col("op") == "u", "t").otherwise(F.col("op")))
    raw = envelope.envelope(
        table="events", op=F.col("op"), ts_ms=F.col("ts_ms"), lsn=F.col("lsn"),
        before=F.when(F.col("op").isin("t", "d"), F.col("image")),
        after=F.when(~F.col("op").isin("t", "d"), F.col("image")),
    )
    feed = changes.select(raw.alias("raw_json"))
    loose = structure.stage_rows(structure.judge(feed, [EVENTS]), EVENTS)
    strict = structure.quarantine_rows(structure.judge(feed, [EVENTS], strict_ops=True))
    a = loose.groupBy(F.lit("staged").alias("outcome"), "op", "is_delete").agg(F.count("*").alias("n_rows"))
    b = strict.groupBy(F.col("error").alias("outcome"), "op").agg(F.count("*").alias("n_rows"))
    return a.unionByName(b.withColumn("is_delete", F.lit(None).cast("boolean")))


@query
def entity_users(spark, sf_dir):
    stages, _ = structure.structure(feeds.users_feed(spark, sf_dir), [USERS], expected_table="users")
    return stages["users"].select(
        "table", "op", "ts_ms", "lsn", "event_date", "is_delete", "user_id", "email", "country_code", "created_at"
    )


@query
def entity_orders(spark, sf_dir):
    stages, _ = structure.structure(feeds.orders_feed(spark, sf_dir), [ORDERS], expected_table="orders")
    return stages["orders"].drop("ingest_ts", "src_offset", "src_file", "src_row")


@query
def many_entities(spark, sf_dir):
    """Users and orders in one feed, parsed once and split."""
    feed = feeds.users_feed(spark, sf_dir).union(feeds.orders_feed(spark, sf_dir))
    feed = feed.union(feeds.events_feed(spark, sf_dir).select("raw_json"))
    stages, bad = structure.structure(feed, [USERS, ORDERS])
    u = stages["users"].agg(F.count("*").alias("n_rows"), F.sum("user_id").alias("key_sum"))
    o = stages["orders"].agg(F.count("*").alias("n_rows"), F.sum("order_id").alias("key_sum"))
    b = bad.groupBy(F.col("error").alias("part")).agg(F.count("*").alias("n_rows"), F.sum("lsn").alias("key_sum"))
    named = [d.select(F.lit(n).alias("part"), "n_rows", "key_sum") for n, d in (("users", u), ("orders", o))]
    return union.promote_union([*named, b])


@query
def entity_required_fail(spark, sf_dir):
    """Orders and users with one required column missing per class; the first missing one names the code."""
    def without(image: DataFrame, columns: list[str], key: str) -> DataFrame:
        hidden = {
            c: F.when(F.col(key) % 8 == i, F.lit("") if c in ("status", "email") else None).otherwise(F.col(c))
            for i, c in enumerate(columns, 1)
        }
        return image.withColumn("_key", F.col(key)).withColumns(hidden)

    def feed(image: DataFrame, spec) -> DataFrame:
        raw = envelope.envelope(
            table=spec.table, op="u", ts_ms=F.lit(feeds.SNAPSHOT_TS_MS), lsn=F.col("_key"),
            after=F.struct(*[F.col(f.name) for f in spec.fields]),
        )
        return image.select(raw.alias("raw_json"))

    required = ["order_id", "user_id", "status", "total_amount", "currency", "ordered_at"]
    orders = feed(without(feeds.orders_image(spark, sf_dir), required, "order_id"), ORDERS)
    users = feed(without(feeds.users_image(spark, sf_dir), ["user_id", "email", "country_code"], "user_id"), USERS)
    _, bad = structure.structure(orders.union(users), [USERS, ORDERS])
    return bad.select("table", "error", "op", "lsn")


@query
def coerce_values(spark, sf_dir):
    """Numbers, booleans, amounts and times in many JSON spellings, read into the orders entity."""
    orders = feeds.table(spark, sf_dir, "orders")
    kind = F.col("o_orderkey") % 8
    key = F.col("o_orderkey").cast("string")

    def pick(*texts: str):
        chosen = F.lit(texts[-1]) if isinstance(texts[-1], str) else texts[-1]
        for i, text in reversed(list(enumerate(texts[:-1]))):
            chosen = F.when(kind == i, F.lit(text) if isinstance(text, str) else text).otherwise(chosen)
        return chosen

    raw = F.concat(
        F.lit('{"payload":{"op":"c","ts_ms":"1704067200000","source":{"table":"orders","lsn":'), key,
        F.lit('.9},"after":{"order_id":'),
        pick(key, F.concat(F.lit('"'), key, F.lit('"')), F.concat(F.lit('" '), key, F.lit(' "')), F.concat(key, F.lit(".9")), key),
        F.lit(',"user_id":'), pick("true", "false", '"12"', "-3.9", "7"),
        F.lit(',"status":'), pick("1.50", "1e2", '"x"', "7", '"yes"'),
        F.lit(',"total_amount":'), pick("120.5", '"120.50"', "80.0", '""', "5"),
        F.lit(',"currency":"EUR","ordered_at":"2024-01-01T00:00:00Z","updated_at":'),
        pick('"2024-01-02"', "1768254609953", '"NOT A DATE"', "null", '"2024-01-02T10:00:00.5Z"'),
        F.lit(',"is_deleted":'), pick("true", '"T"', '"no"', "2", "0.5", '"y"', "[]", "0"),
        F.lit("}}}"),
    )
    feed = orders.select("o_orderkey", raw.alias("raw_json"))
    judged = structure.judge(feed, [ORDERS])
    return structure.stage_rows(judged, ORDERS, extra=["o_orderkey"]).select(
        "o_orderkey", "ts_ms", "lsn", "event_date", "order_id", "user_id", "status", "total_amount", "updated_at", "is_deleted"
    )


@query
def snapshot_load(spark, sf_dir):
    """Initial contents of a table as ``r`` events, merged into an empty current table."""
    events = envelope.snapshot_to_events(
        feeds.users_image(spark, sf_dir), USERS, ts_ms=F.lit(feeds.SNAPSHOT_TS_MS) + F.col("user_id")
    )
    stage = structure.stage_rows(structure.judge(events, [USERS], expected_table="users"), USERS)
    current = merge.merge_current(None, stage, USERS.pk)
    return current.select("user_id", "email", "country_code", "op", "ts_ms", "lsn")


# Merge -------------------------------------------------------------------------------------------------------


@query
def replay_dedupe(spark, sf_dir):
    stage = structure.stage_rows(dirty_judged(spark, sf_dir), EVENTS)
    kept = dedupe.dedupe_replays(stage, EVENTS.pk)
    return kept.select("user_id", "event_id", "op", "lsn", "ts_ms", "event_date")


@query
def current_state(spark, sf_dir):
    return merge.merge_current(None, events_stage(spark, sf_dir), EVENTS.pk).select(*STATE)


@query
def current_null_lsn(spark, sf_dir):
    """Log positions that contradict the dates, some missing: the date decides, then a missing position wins."""
    return merge.merge_current(None, events_stage(spark, sf_dir, permuted=True), EVENTS.pk).select(*STATE)


@query
def current_incremental(spark, sf_dir):
    """The first half of the month, then the rest on top."""
    stage = events_stage(spark, sf_dir)
    first = merge.merge_current(None, stage.where("event_date <= '2024-01-15'"), EVENTS.pk)
    return merge.merge_current(first, stage.where("event_date > '2024-01-15'"), EVENTS.pk).select(*STATE)


@query
def current_one_date_replay(spark, sf_dir):
    """An old date applied again on a newer current state: its keys fall back."""
    stage = events_stage(spark, sf_dir)
    whole = merge.merge_current(None, stage, EVENTS.pk)
    return merge.merge_current(whole, stage.where("event_date = '2024-01-10'"), EVENTS.pk).select(*STATE)


@query
def current_guarded(spark, sf_dir):
    """The log position decides whatever the date."""
    ordered = merge.merge_current(None, events_stage(spark, sf_dir, permuted=True), EVENTS.pk, "ordered")
    return merge.live(ordered).select(*STATE)


@query
def current_guarded_late(spark, sf_dir):
    """Dates applied newest first; late events and tombstones end in the same state."""
    stage = events_stage(spark, sf_dir, permuted=True)
    late = merge.merge_current(None, stage.where("event_date > '2024-01-15'"), EVENTS.pk, "ordered")
    whole = merge.merge_current(late, stage.where("event_date <= '2024-01-15'"), EVENTS.pk, "ordered")
    return merge.live(whole).select(*STATE)


@query
def merge_stats(spark, sf_dir):
    return merge.merge_stats(None, structure.stage_rows(dirty_judged(spark, sf_dir), EVENTS), EVENTS.pk)


@query
def merge_stats_incremental(spark, sf_dir):
    stage = events_stage(spark, sf_dir)
    first = merge.merge_current(None, stage.where("event_date <= '2024-01-15'"), EVENTS.pk)
    return merge.merge_stats(first, stage.where("event_date > '2024-01-15'"), EVENTS.pk)


# Selection and ledger ------------------------------------------------------------------------------------------


@query
def pending_dates(spark, sf_dir):
    """Dates to merge with nothing asked for, with one date asked for, and forced."""
    events = feeds.table(spark, sf_dir, "events")
    dates = events.select(F.date_format("ts", "yyyy-MM-dd").alias("event_date"), F.dayofmonth("ts").alias("day"))
    processed = dates.where("day % 3 = 0")
    plain = selection.pending_dates(dates, processed)
    one = selection.pending_dates(dates, processed, only_date="2024-01-06")
    forced = selection.pending_dates(dates, processed, force=True)
    named = [d.withColumn("asked", F.lit(n)) for n, d in (("new", plain), ("date", one), ("force", forced))]
    return union.promote_union(named)


def _runs(spark, sf_dir):
    """Run folders, run outcomes and compacted runs, spelled out from the events."""
    events = feeds.table(spark, sf_dir, "events")
    runs = events.select(
        F.lit("source_db").alias("source"),
        F.col("event_type").alias("table"),
        F.date_format("ts", "yyyy-MM-dd").alias("ingestion_date"),
        F.concat(F.lit("run-"), F.col("user_id")).alias("run_id"),
    ).distinct()
    number = F.substring_index("run_id", "-", -1).cast("int")
    outcomes = runs.select("run_id").distinct().select(
        "run_id", F.when(number % 5 == 0, "FAILED").when(number % 7 == 0, "STARTED").otherwise("SUCCESS").alias("status")
    )
    return runs, outcomes, runs.where((number % 2 == 0) & (F.col("table") == "click"))


@query
def compaction_eligibility(spark, sf_dir):
    return selection.eligible_runs(*_runs(spark, sf_dir))


@query
def compaction_one_date(spark, sf_dir):
    return selection.eligible_runs(*_runs(spark, sf_dir), only_date="2024-01-05", statuses=("SUCCESS", "FAILED"))


@query
def bronze_offsets(spark, sf_dir):
    return selection.last_offsets(feeds.kafka_records(spark, sf_dir))


@query
def resume_from_checkpoint(spark, sf_dir):
    """Records behind the committed offset; one stream partition has none yet."""
    records = feeds.kafka_records(spark, sf_dir)
    early = records.where("timestamp < '2024-01-20' and partition <> 3")
    left = selection.resume_after(records, selection.last_offsets(early))
    return left.groupBy("topic", "partition").agg(
        F.count("*").alias("n_records"), F.min("offset").alias("first_offset"), F.max("offset").alias("last_offset")
    )


@query
def starting_offsets(spark, sf_dir):
    """The source option that resumes a stream, opened again with JSON paths."""
    text = selection.starting_offsets(selection.last_offsets(feeds.kafka_records(spark, sf_dir)))
    parts = F.from_json("starting_offsets", "map<string,map<string,bigint>>")
    return text.select(F.explode(parts).alias("topic", "next")).select(
        "topic", F.explode("next").alias("partition", "next_offset")
    )


@query
def run_manifest(spark, sf_dir):
    """Touched tables of a run and the offsets it reached."""
    events = feeds.kafka_records(spark, sf_dir).join(
        feeds.table(spark, sf_dir, "events").select(F.col("event_id").alias("offset"), "event_type"), "offset"
    )
    topic = F.concat(F.lit("source_db.public."), F.col("event_type"))
    rows = events.select(
        topics.topic_source(topic).alias("source"),
        topics.topic_table(topic).alias("table"),
        topic.alias("topic"),
        "partition",
        "offset",
        F.col("key").cast("string").alias("src_file"),
    )
    manifest = selection.run_manifest(
        rows, run_id="run-1", ingestion_date="2024-01-31", status="SUCCESS", group_id="bronze", topics=["a", "b"]
    )
    last = F.col("last_offsets")[F.concat_ws(".", F.col("source"), F.lit("public"), F.col("table"))]
    return manifest.select(
        "source", "table", "run_id", "ingestion_date", "status", "kafka_group_id", F.size("topics").alias("n_topics"),
        "n_files", "rows", F.size("last_offsets").alias("offset_topics"), last["0"].alias("last_of_0"),
        last["3"].alias("last_of_3"), "error",
    )


@query
def touched_tables(spark, sf_dir):
    runs, _, _ = _runs(spark, sf_dir)
    return selection.touched_tables(runs)


@query
def compaction_stats(spark, sf_dir):
    """Files and rows per run: every user is a file here."""
    events = feeds.table(spark, sf_dir, "events")
    rows = events.select(
        F.lit("source_db").alias("source"),
        F.col("event_type").alias("table"),
        F.date_format("ts", "yyyy-MM-dd").alias("ingestion_date"),
        F.lit("run-1").alias("run_id"),
        F.concat(F.lit("events_"), F.col("user_id")).alias("src_file"),
    )
    return selection.compaction_stats(rows)


@query
def promote_union(spark, sf_dir):
    """Parts with fewer columns are filled up with nulls; together they are all events."""
    events = feeds.table(spark, sf_dir, "events")
    old = events.where("event_type = 'click'").select("event_id", "user_id")
    mid = events.where("event_type = 'view'").select("user_id", "event_id", "event_type")
    new = events.where("event_type not in ('click', 'view')").select("event_id", "event_type", "props", "user_id")
    return union.promote_union([old, mid, new])


@query
def ledger_latest(spark, sf_dir):
    """Last write per stream partition wins, also when its offset is lower."""
    log = feeds.table(spark, sf_dir, "events").select(
        F.concat(F.lit("db.public."), F.col("event_type")).alias("topic"),
        F.col("user_id").alias("partition"),
        ((F.col("event_id") * 7919) % 1000003).alias("last_committed_offset"),
        F.col("event_id").alias("seq"),
    )
    return dedupe.latest(log, ["topic", "partition"], [F.col("seq").desc()])


# Typed views and checks ------------------------------------------------------------------------------------------


@query
def typed_orders(spark, sf_dir):
    stages, _ = structure.structure(feeds.orders_feed(spark, sf_dir), [ORDERS], expected_table="orders")
    typed = quality.typed_view(merge.merge_current(None, stages["orders"], ORDERS.pk), ORDERS)
    return typed.select("order_id", "user_id", "total_amount", F.unix_micros("ordered_at").alias("ordered_us"), "is_deleted")


@query
def typed_encoded_amounts(spark, sf_dir):
    """Amounts sent as base64 integers of 1 to 15 bytes, negative ones included, back to decimals."""
    cents = (F.col("o_totalprice").cast("decimal(12,2)") * 100).cast("long")
    cents = F.when(F.col("o_orderkey") % 3 == 0, -cents).otherwise(cents)
    digits = F.lpad(F.hex(cents), 16, "0")
    # zero bytes behind the integer multiply it by 256 each
    data = F.base64(F.unhex(F.concat(digits, F.repeat(F.lit("00"), (F.col("o_orderkey") % 8).cast("int")))))
    few = F.when(cents >= 0, F.regexp_replace(digits, "^(00(?=[0-7]))+", "")).otherwise(F.regexp_replace(digits, "^(FF(?=[89A-F]))+", ""))
    orders = feeds.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        # as few bytes as the value needs, as connectors send it
        F.base64(F.unhex(F.regexp_replace(few, "^(00(?=[0-7]))+|^(FF(?=[89A-F]))+", ""))).alias("total_amount"),
        data.alias("large_amount"),
        F.base64(F.unhex(F.right(digits, F.lit(2)))).alias("one_byte"),
    )
    view = quality.typed_view(orders, ORDERS, encoded_decimals=True)
    large = quality.typed(FieldSpec("large_amount", "decimal", precision=38, scale=0), True)
    one = quality.typed(FieldSpec("one_byte", "decimal", precision=3, scale=0), True)
    return view.withColumns({"large_amount": large, "one_byte": one})


@query
def orphans(spark, sf_dir):
    orders = feeds.orders_image(spark, sf_dir)
    users = feeds.users_image(spark, sf_dir).where("user_id % 50 <> 0")
    return quality.orphans(orders, users, "user_id").select("order_id", "user_id")


# Jobs that write and read back ------------------------------------------------------------------------------------


def _records_folder(spark, sf_dir, base):
    """The event feed as files of stream records, the input of the streaming queries."""
    folder = f"{base}/records"
    feeds.kafka_records(spark, sf_dir).write.parquet(folder)
    return bronze.file_stream(spark, folder)


@query
def stream_landing(spark, sf_dir):
    """Records through the streaming writer into bronze files."""
    base = work_folder(spark, "landing")
    ledger = Ledger(spark, f"{base}/ledger")
    stream = _records_folder(spark, sf_dir, base)
    run = ingest(stream, f"{base}/bronze", ledger, checkpoint=f"{base}/checkpoint", available_now=True)
    if run.finish() != "SUCCESS":
        raise RuntimeError(ledger.get_run(run.run_id).details)
    rows = batch_rows(spark, f"{base}/bronze", run.ingestion_date, run.run_id)
    payload = F.get_json_object("raw_json", "$.payload.source.lsn").cast("long")
    return rows.select("source", "table", "partition", "offset", payload.alias("lsn"))


@query
def compacted_rows(spark, sf_dir):
    """Rows of many runs brought together for compaction; nothing lost or added."""
    events = feeds.events_feed(spark, sf_dir).join(
        feeds.table(spark, sf_dir, "events").select("event_id", "event_type"), "event_id"
    )
    rows = events.select(
        F.lit("source_db").alias("source"),
        F.col("event_type").alias("table"),
        F.lit("2024-01-31").alias("ingestion_date"),
        F.lit("run-1").alias("run_id"),
        F.get_json_object("raw_json", "$.payload.source.lsn").cast("long").alias("lsn"),
        "raw_json",
    )
    return compact_rows(rows).select("source", "table", "ingestion_date", "run_id", "lsn")


def _structured(spark, sf_dir, base):
    feed = feeds.dirty_events_feed(spark, sf_dir).select(F.lit("2024-01-31T00:00:00Z").alias("ingest_ts"), "raw_json")
    feed.write.parquet(f"{base}/events")
    return structure_file(spark, f"{base}/events", EVENTS, f"{base}/silver", run_id="run-1")


@query
def stage_files(spark, sf_dir):
    """Stage written by date and read back."""
    base = work_folder(spark, "stage")
    _structured(spark, sf_dir, base)
    stage = silver.read_stage(spark, f"{base}/silver", EVENTS)
    return stage.select("event_date", "user_id", "event_id", "op", "lsn", "ingest_ts", "is_delete", "run_id")


@query
def quarantine_files(spark, sf_dir):
    """Quarantine written as JSON lines and read back."""
    base = work_folder(spark, "quarantine")
    _structured(spark, sf_dir, base)
    return structure.quarantine_histogram(silver.read_quarantine(spark, f"{base}/silver", "events"))


@query
def merge_job(spark, sf_dir):
    """The merge job over written stage dates: fifteen dates, then the rest, then nothing left to do."""
    base = work_folder(spark, "merge")
    ledger = Ledger(spark, f"{base}/ledger")
    stage = events_stage(spark, sf_dir).withColumn("run_id", F.lit("run-1"))
    silver.write_stage(stage.where("event_date <= '2024-01-15'"), f"{base}/silver")
    run_merge(spark, f"{base}/silver", ledger, EVENTS, buckets=8)
    silver.write_stage(stage.where("event_date > '2024-01-15'"), f"{base}/silver")
    run_merge(spark, f"{base}/silver", ledger, EVENTS)
    if run_merge(spark, f"{base}/silver", ledger, EVENTS).status != "nothing_to_process":
        raise RuntimeError("dates were left pending")
    return current_table(spark, f"{base}/silver", ledger, EVENTS).select(*STATE)


@query
def compact_job(spark, sf_dir):
    """Runs of three shapes, one of another writer that has compacted it already, compacted and pruned: no row is lost
    or doubled, and all columns stay."""
    base = work_folder(spark, "c/cdc/compact")
    ledger = Ledger(spark, f"{base}/ledger")
    feed = feeds.events_feed(spark, sf_dir, spread=True)
    feed = feed.select(F.lit("2024-01-31T00:00:00Z").alias("ingest_ts"), "raw_json", "event_id")
    runs = ["run:0", "run 1", "run=2"]
    for i, run in enumerate(runs):
        part = feed.where(F.col("event_id") % 3 == i)
        part = part.drop("event_id") if i == 0 else part.withColumn("note", F.concat(F.lit("n"), F.col("event_id"))).drop("event_id")
        folder = bronze.run_path(f"{base}/bronze", "db", "events", "2024-01-31", run)
        if i < 2:
            part.write.parquet(folder)
            ledger.start_run(run, "2024-01-31")
            ledger.end_run(run, "SUCCESS")
            continue
        # another writer: parts, what it made of them, and its two marks
        for name in ("events", "events_compacted"):
            part.write.parquet(f"{folder}/_{name}")
            for k, written in enumerate(fs.glob(spark, f"{folder}/_{name}/part-*")):
                fs.rename(spark, written, f"{folder}/{name}_{k:05d}.parquet")
            fs.remove(spark, f"{folder}/_{name}")
        for mark in ("_SUCCESS", "_COMPACTED"):
            fs.write_text(spark, folder, mark, "")
    compact(spark, f"{base}/bronze", ledger, prune=True)
    if compact(spark, f"{base}/bronze", ledger).count() or bronze.discover_runs(spark, f"{base}/bronze").count():
        raise RuntimeError("runs were left")
    folders = [bronze.run_path(f"{base}/bronze", "db", "events", "2024-01-31", r, root=bronze.COMPACTED) for r in runs]
    rows = bronze.read_runs(spark, f"{base}/bronze", folders, bronze.COMPACTED)
    lsn = F.get_json_object("raw_json", "$.payload.source.lsn").cast("long")
    return rows.select("source", "table", "run_id", "ingest_ts", "note", lsn.alias("lsn"))


@query
def landed_files(spark, sf_dir):
    """The files a run names in its manifest, opened by those paths: every record once, with date and stamp."""
    base = work_folder(spark, "landed")
    ledger = Ledger(spark, f"{base}/ledger")
    stream = _records_folder(spark, sf_dir, base)
    run = ingest(
        stream, f"{base}/bronze", ledger, checkpoint=f"{base}/checkpoint", available_now=True, ingestion_date="2024-01-31",
        run_id="nightly 2024-01-31T00:00", max_records_per_file=1000,
    )
    if run.finish() != "SUCCESS":
        raise RuntimeError(ledger.get_run(run.run_id).details)
    listed = spark.read.json(fs.glob(spark, f"{base}/bronze/manifests/run_id=*/files"))
    paths = [r["path"] for r in listed.select("path").toLocalIterator()]
    rows = spark.read.option("basePath", f"{base}/bronze/cdc").parquet(*paths)
    stamp = F.col("ingest_ts").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$")
    return rows.select("source", "table", "ingestion_date", "run_id", "partition", "offset", stamp.alias("stamped"))


@query
def ledger_runs(spark, sf_dir):
    """Runs that started, ended and failed: the newest row of each. A run per user."""
    base = work_folder(spark, "runs")
    ledger = Ledger(spark, f"{base}/ledger")
    users = feeds.table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    run = F.concat(F.lit("run-"), F.col("user_id"))
    none = F.lit(None).cast("map<string, string>")
    rows = users.select(
        "user_id", "n", run.alias("run_id"), F.lit("a").alias("start_time"), F.lit(None).cast("string").alias("end_time"),
        F.lit("STARTED").alias("status"), none.alias("details"), F.lit("2024-01-31").alias("ingestion_date"),
    )
    ledger.append_rows("pipeline_runs", rows)
    status = F.when(F.col("n") % 2 == 0, "SUCCESS").otherwise("FAILED")
    details = F.when(F.col("n") % 2 == 1, F.create_map(F.lit("error"), F.col("n").cast("string")))
    ended = rows.where("user_id % 3 <> 0").withColumns({"status": status, "end_time": F.lit("b"), "details": details})
    ledger.append_rows("pipeline_runs", ended)
    view = ledger.view("pipeline_runs")
    return view.select("run_id", "start_time", "end_time", "status", F.col("details")["error"].alias("error"), "ingestion_date")


@query
def null_keys(spark, sf_dir):
    """Events without a key have no state; those of a key decide as if the others weren't there."""
    key = F.when(F.col("lsn") % 10 != 0, F.col("user_id"))
    return merge.merge_current(None, events_stage(spark, sf_dir).withColumn("user_id", key), EVENTS.pk).select(*STATE)


@query
def merge_bare_dates(spark, sf_dir):
    """Stage folders of another tool, without a run level, give the same state in both modes."""
    base = work_folder(spark, "bare")
    stage = events_stage(spark, sf_dir).withColumn("table", F.lit("events"))
    stage.write.partitionBy("table", "event_date").parquet(f"{base}/silver/{silver.STAGE}")
    states = []
    for mode in ("replay", "ordered"):
        ledger = Ledger(spark, f"{base}/{mode}/ledger")
        # each mode has current tables of its own
        run_merge(spark, f"{base}/silver", ledger, EVENTS, mode=mode, buckets=8)
        states.append(current_table(spark, f"{base}/silver", ledger, EVENTS).select(F.lit(mode).alias("mode"), *STATE))
    return states[0].unionByName(states[1])


@query
def merge_concurrent(spark, sf_dir):
    """Merges at the same time: one of them finds that it was overtaken and starts over."""
    base = work_folder(spark, "concurrent")
    ledger = Ledger(spark, f"{base}/ledger")
    stage = events_stage(spark, sf_dir).withColumn("run_id", F.lit("run-1"))
    silver.write_stage(stage, f"{base}/silver")
    dates = [r["event_date"] for r in silver.stage_partitions(spark, f"{base}/silver", "events").collect()]
    run_merge(spark, f"{base}/silver", ledger, EVENTS, only_date=dates[0], buckets=8)

    def merge_all(_):
        return run_merge(spark, f"{base}/silver", Ledger(spark, f"{base}/ledger"), EVENTS)

    with ThreadPoolExecutor(2) as pool:
        list(pool.map(merge_all, range(2)))
    return current_table(spark, f"{base}/silver", ledger, EVENTS).select(*STATE)


@query
def pipeline_current(spark, sf_dir):
    """Stream records to the current table through all four jobs."""
    base = work_folder(spark, "pipeline")
    stream = _records_folder(spark, sf_dir, base)
    return run_pipeline(stream, base, [EVENTS], buckets=8)["events"].select(*STATE)


@query
def stream_current(spark, sf_dir):
    """The current table maintained from the stream, a few files per batch."""
    base = work_folder(spark, "follow")
    ledger = Ledger(spark, f"{base}/ledger")
    folder = f"{base}/records"
    feeds.kafka_records(spark, sf_dir).repartition(4).write.parquet(folder)
    stream = bronze.file_stream(spark, folder, maxFilesPerTrigger="2")
    follow(
        stream, f"{base}/silver", ledger, EVENTS, checkpoint=f"{base}/checkpoint", name=f"follow-{uuid.uuid4().hex}", buckets=8
    ).awaitTermination()
    return current_table(spark, f"{base}/silver", ledger, EVENTS).select(*STATE)


# Runs that break, overlap or come late ----------------------------------------------------------------------------


def _lsn(column: str = "raw_json"):
    return F.get_json_object(column, "$.payload.source.lsn").cast("long")


@query
def log_landing(spark, sf_dir):
    """Records from a folder log in two halves, each landed with a checkpoint of its own: the second starts where the ledger
    says the first ended. A restart after that finds nothing more."""
    base = work_folder(spark, "log")
    ledger = Ledger(spark, f"{base}/ledger")
    records = feeds.kafka_records(spark, sf_dir)
    half = records.agg(F.expr("(min(offset) + max(offset)) div 2")).first()[0]
    landed = []
    for i, part in enumerate((records.where(F.col("offset") <= half), records.where(F.col("offset") > half))):
        change_log.append(part, f"{base}/log")
        position = {"startingOffsets": selection.starting_offsets(ledger.view("cdc_checkpoints")).first()[0]} if i else {}
        for _ in range(1 + i):
            stream = change_log.stream(spark, f"{base}/log", **position)
            run = ingest(stream, f"{base}/bronze", ledger, checkpoint=f"{base}/checkpoint-{i}", available_now=True)
            if run.finish() != "SUCCESS":
                raise RuntimeError(ledger.get_run(run.run_id).details)
            rows = batch_rows(spark, f"{base}/bronze", run.ingestion_date, run.run_id)
            landed += [] if rows is None else [rows]
    rows = union.promote_union(landed)
    return rows.select("source", "table", "partition", "offset", _lsn().alias("lsn"))


@query
def rescued_run(spark, sf_dir):
    """A run breaks in its second batch, is rescued, and its stream goes on in another run: compacted, every record is
    there once."""
    base = work_folder(spark, "rescued")
    ledger = Ledger(spark, f"{base}/ledger")
    records = feeds.kafka_records(spark, sf_dir)
    half = records.agg(F.expr("(min(offset) + max(offset)) div 2")).first()[0]

    def land(run_id: str, broken: bool):
        stream = bronze.file_stream(spark, f"{base}/records")
        if broken:
            # a value the writer can't take
            bad = F.when(F.col("offset") > half, F.raise_error(F.lit("broken record")).cast("binary")).otherwise(F.col("value"))
            stream = stream.withColumn("value", bad)
        return ingest(stream, f"{base}/bronze", ledger, checkpoint=f"{base}/checkpoint", available_now=True, run_id=run_id)

    records.where(F.col("offset") <= half).write.parquet(f"{base}/records")
    first = land("first", False)
    first.query.awaitTermination()
    # the writer is lost before the run is closed; the next one takes it up and fails
    records.where(F.col("offset") > half).write.mode("append").parquet(f"{base}/records")
    if land("first", True).finish() != "FAILED":
        raise RuntimeError("the run did not break")
    compact(spark, f"{base}/bronze", ledger, statuses=("SUCCESS", "FAILED"))
    try:
        land("first", False)
    except ValueError:
        if land("second", False).finish() != "SUCCESS":
            raise RuntimeError(ledger.get_run("second").details) from None
    compact(spark, f"{base}/bronze", ledger)
    runs = bronze.discover_runs(spark, f"{base}/bronze", bronze.COMPACTED).collect()
    folders = [bronze.run_path(f"{base}/bronze", *r, root=bronze.COMPACTED) for r in runs]
    rows = bronze.read_runs(spark, f"{base}/bronze", folders, bronze.COMPACTED)
    return rows.select("source", "table", "run_id", "partition", "offset", _lsn().alias("lsn"))


@query
def restructured_run(spark, sf_dir):
    """A run is structured and merged, then structured again with more events under the same name, and merged again."""
    base = work_folder(spark, "restructured")
    ledger = Ledger(spark, f"{base}/ledger")
    feed = feeds.events_feed(spark, sf_dir).withColumn("run_id", F.lit("run-1"))
    for part in (feed.where("event_id % 2 = 0"), feed):
        structure_events(part.drop("event_id"), EVENTS, f"{base}/silver")
        run_merge(spark, f"{base}/silver", ledger, EVENTS, mode="ordered", buckets=8)
    if run_merge(spark, f"{base}/silver", ledger, EVENTS, mode="ordered").status != "nothing_to_process":
        raise RuntimeError("dates were left pending")
    return current_table(spark, f"{base}/silver", ledger, EVENTS).select(*STATE)


def _overlapping_runs(spark, sf_dir, base):
    """Bronze rows of three runs: the first lands 60 % of each stream partition, the second goes on from 50 % and misses
    70 to 72 %, the third lands 55 to 58 % again."""
    records = feeds.kafka_records(spark, sf_dir)
    dense = records.withColumns(
        {"partition": F.pmod("offset", F.lit(4)).cast("int"), "offset": F.expr("offset div 4"), "lsn": F.col("offset")}
    )
    top = dense.agg(F.max("offset")).first()[0]
    at = {k: top * k // 100 for k in (50, 55, 58, 60, 70, 72)}
    o = F.col("offset")
    runs = {
        "run-1": o < at[60],
        "run-2": (o >= at[50]) & ~((o >= at[70]) & (o < at[72])),
        "run-3": (o >= at[55]) & (o < at[58]),
    }
    for run_id, mine in runs.items():
        land_batch(
            dense.where(mine), f"{base}/bronze", run_id=run_id, ingestion_date="2024-01-31", batch_id=0, max_records_per_file=100_000
        )
    folders = [p for r in runs for p in fs.glob(spark, bronze.run_path(f"{base}/bronze", "*", "*", "2024-01-31", r))]
    return bronze.read_runs(spark, f"{base}/bronze", folders)


@query
def landed_intervals(spark, sf_dir):
    """What overlapping runs landed: the interval of each, stretches landed more than once, and holes."""
    rows = _overlapping_runs(spark, sf_dir, work_folder(spark, "intervals"))
    found = offsets.intervals(rows, ["run_id"])
    none = F.lit(None).cast("string")
    parts = [
        found.select(F.lit("landed").alias("kind"), "run_id", "partition", "first", "last", F.lit(1).cast("long").alias("times")),
        offsets.duplicates(found).select(F.lit("duplicate").alias("kind"), none.alias("run_id"), "partition", "first", "last", "times"),
        offsets.holes(found).select(
            F.lit("hole").alias("kind"), none.alias("run_id"), "partition", "first", "last", F.lit(0).cast("long").alias("times")
        ),
    ]
    return union.promote_union(parts)


@query
def landed_once(spark, sf_dir):
    """The rows of overlapping runs with each offset once, from the first run that has it."""
    rows = _overlapping_runs(spark, sf_dir, work_folder(spark, "once"))
    once = offsets.each_once(rows, ["run_id"])
    return once.select("run_id", "partition", "offset", _lsn().alias("lsn"))


@query
def closed_dates(spark, sf_dir):
    """Dates that a watermark of a day has closed, those still open, and one to which rows came late, after three calls;
    and how many events of each the merges have applied."""
    base = work_folder(spark, "dates")
    ledger, silver_base = Ledger(spark, f"{base}/ledger"), f"{base}/silver"
    # made and parsed once, not once per wave
    events_stage(spark, sf_dir, spread=True).write.parquet(f"{base}/events")
    stage = spark.read.parquet(f"{base}/events")
    late = (F.col("event_date") == "2024-01-05") & (F.col("event_id") % 2 == 0)
    waves = {
        "run-1": (F.col("event_date") <= "2024-01-15") & ~late,
        "run-2": (F.col("event_date") > "2024-01-15") & (F.col("event_date") <= "2024-01-20"),
        "run-3": (F.col("event_date") > "2024-01-20") | late,
    }
    for run_id, mine in waves.items():
        silver.write_stage(stage.where(mine).withColumn("run_id", F.lit(run_id)), silver_base)
        track_dates(spark, silver_base, ledger, EVENTS, checkpoint=f"{base}/checkpoint")
        run_merge(spark, silver_base, ledger, EVENTS, buckets=8, closed_only=True)
    states = date_states(spark, silver_base, ledger, EVENTS)
    merged = ledger.processed_partitions("merge_current", EVENTS.table).select("event_date", F.col("rows_in").alias("merged_rows"))
    return states.join(merged, "event_date", "left").select("event_date", "state", "rows", "merged_rows")


@query
def stream_keyed(spark, sf_dir):
    """The last event per user kept in the state of a stream, in the order of log positions that contradict the dates."""
    base = work_folder(spark, "keyed")
    records = feeds.kafka_records(spark, sf_dir, permuted=True, spread=True).repartition(4)
    # row groups by which a few files can be parsed on all cores
    records.write.option("parquet.block.size", 4 << 20).parquet(f"{base}/records")
    stream = bronze.file_stream(spark, f"{base}/records", maxFilesPerTrigger="2")
    keep_current(stream, f"{base}/changes", EVENTS, checkpoint=f"{base}/checkpoint").awaitTermination()
    return kept_current(spark, f"{base}/checkpoint").select(*STATE)
