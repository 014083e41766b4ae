"""SQL twins of the queries, computed straight from the tables: no JSON, no encoding, no parsing."""

from __future__ import annotations

# The event feed as plain rows.
_E1 = """
feed AS (
  SELECT event_id, user_id, event_type, value, props, event_id AS lsn,
         CASE event_type WHEN 'signup' THEN 'c' WHEN 'purchase' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END AS op,
         epoch_us(ts) // 1000 AS ts_ms, strftime(ts, '%Y-%m-%d') AS event_date, event_id % 40 AS defect
  FROM events)
"""

_E2 = _E1.replace(
    "event_id AS lsn", "CASE WHEN event_id % 11 <> 0 THEN (event_id * 7919) % 1000003 END AS lsn"
)

# The dirty feed with the code of each event.
_E3 = (
    _E1
    + """,
dirty AS (
  SELECT event_id, user_id, lsn, ts_ms, event_date, value, props, defect, event_type,
         CASE defect WHEN 6 THEN 'u' WHEN 7 THEN 'd' WHEN 9 THEN 'r' ELSE op END AS op,
         CASE defect WHEN 0 THEN 'JSON_PARSE' WHEN 1 THEN 'MISSING_PAYLOAD' WHEN 2 THEN 'MISSING_OP'
           WHEN 3 THEN 'MISSING_SOURCE' WHEN 4 THEN 'MISSING_SOURCE_TABLE' WHEN 5 THEN 'MISSING_TS_MS'
           WHEN 6 THEN 'AFTER_NULL_FOR_CU' WHEN 7 THEN 'BEFORE_NULL_FOR_D' WHEN 8 THEN 'TABLE_MISMATCH'
           WHEN 9 THEN 'ROW_NULL' WHEN 10 THEN 'USER_ID_NULL' WHEN 11 THEN 'EVENT_TYPE_NULL' END AS error
  FROM feed),
good AS (
  SELECT * FROM dirty WHERE error IS NULL
  UNION ALL SELECT * FROM dirty WHERE defect = 12)
"""
)

_STATE = "user_id, event_id, event_type, op, ts_ms, lsn, event_date"


def _current(ctes: str, source: str, order: str) -> str:
    return f"""
WITH {ctes},
last AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {order}) AS rn FROM {source})
SELECT {_STATE} FROM last WHERE rn = 1 AND op <> 'd'
"""


_DATE_FIRST = "event_date DESC, (lsn IS NULL) DESC, lsn DESC, ts_ms DESC"
_LSN_FIRST = "(lsn IS NULL) DESC, lsn DESC, ts_ms DESC"

_CODES = f"""
WITH {_E3}
SELECT CASE WHEN defect = 8 THEN 'other' WHEN defect >= 9 THEN 'events' END AS "table", error, count(*) AS n_rows
FROM dirty WHERE error IS NOT NULL GROUP BY ALL
"""

# Live keys after each date, from the last event per key and date.
_DAILY = """
per_key AS (
  SELECT event_date, user_id, count(*) AS n,
         arg_max(CASE WHEN op = 'd' THEN 0 ELSE 1 END, lsn) AS live
  FROM {source} GROUP BY event_date, user_id),
steps AS (
  SELECT event_date, n, live - coalesce(lag(live) OVER (PARTITION BY user_id ORDER BY event_date), 0) AS delta
  FROM per_key),
daily AS (SELECT event_date, sum(n) AS n, sum(delta) AS delta FROM steps GROUP BY event_date),
running AS (SELECT event_date, n, sum(delta) OVER (ORDER BY event_date) AS total FROM daily)
SELECT event_date, CAST(n AS BIGINT) AS rows_in, CAST(total AS BIGINT) AS rows_out, CAST(0 AS BIGINT) AS bad_rows
FROM running
"""

_RUNS = """
runs AS (SELECT DISTINCT 'source_db' AS source, event_type AS "table", strftime(ts, '%Y-%m-%d') AS ingestion_date,
                'run-' || user_id AS run_id, user_id AS n FROM events)
"""

_USERS = """
users AS (SELECT c_custkey AS user_id, c_name || '@example.com' AS email, n_name AS country_code
          FROM customer JOIN nation ON c_nationkey = n_nationkey)
"""

# Three runs over dense offsets that overlap and miss some.
_LANDED = """
dense AS (SELECT CAST(event_id % 4 AS INTEGER) AS p, event_id // 4 AS o FROM events),
tops AS (SELECT max(o) AS t FROM dense),
landed AS (
  SELECT 'run-1' AS run_id, p, o FROM dense, tops WHERE o < t * 60 // 100
  UNION ALL SELECT 'run-2', p, o FROM dense, tops WHERE o >= t * 50 // 100 AND NOT (o >= t * 70 // 100 AND o < t * 72 // 100)
  UNION ALL SELECT 'run-3', p, o FROM dense, tops WHERE o >= t * 55 // 100 AND o < t * 58 // 100)
"""

_CURRENT_STATE = _current(_E1, "feed", _DATE_FIRST)

ORACLE: dict[str, str] = {
    "envelope_encode": f"""
WITH {_E1}
SELECT event_id, 'source_db.public.events.Envelope' AS schema_name, op, ts_ms, 'events' AS source_table, lsn,
       CASE WHEN op = 'd' THEN user_id END AS before_user, CASE WHEN op <> 'd' THEN user_id END AS after_user
FROM feed""",
    "envelope_parse": f"""
WITH {_E1}
SELECT event_id, op, 'events' AS src_table, ts_ms, lsn, event_date, op <> 'd' AS no_before, op = 'd' AS no_after,
       CAST(NULL AS VARCHAR) AS error
FROM feed""",
    "iso_times": """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || '000Z' AS iso, strftime(ts, '%Y-%m-%d') AS event_date
FROM events""",
    "topic_route": """
SELECT CASE event_type WHEN 'signup' THEN 'shop' WHEN 'click' THEN 'a' WHEN 'view' THEN 'a.t' || user_id
         ELSE 't' || user_id END AS source,
       CASE WHEN event_type IN ('signup', 'click') THEN 't' || user_id ELSE 'unknown' END AS "table",
       count(*) AS n_records
FROM events GROUP BY ALL""",
    "table_include_list": """
SELECT 'db.public.' || event_type AS topic, count(*) AS n_records
FROM events WHERE value > 20 AND event_type IN ('click', 'view') GROUP BY ALL""",
    "record_envelope": f"""
WITH {_E1}
SELECT 'source_db' AS source, 'events' AS "table", CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset",
       ts_ms AS timestamp_ms, CAST(user_id AS VARCHAR) AS key,
       CASE WHEN event_id % 7 = 0 THEN 'not "json" ' || event_id END AS text_payload,
       CASE WHEN event_id % 7 <> 0 THEN lsn END AS lsn
FROM feed WHERE event_id % 11 <> 0""",
    "utf8_text": """
SELECT doc_id, md5(text || CASE WHEN doc_id % 3 = 0 THEN chr(65533) ELSE '' END) AS text_md5 FROM documents""",
    "quarantine_by_code": _CODES,
    "quarantine_files": _CODES,
    "quarantine_detail": f"""
WITH {_E3}
SELECT event_id, error, defect <= 7 AS has_raw,
       CASE WHEN defect = 8 THEN 'events' END AS expected_table, CASE WHEN defect = 8 THEN 'other' END AS actual_table,
       CASE WHEN defect >= 9 THEN 'events' END AS "table", CASE WHEN defect >= 9 THEN op END AS op,
       CASE WHEN defect >= 9 THEN ts_ms END AS ts_ms, CASE WHEN defect >= 9 THEN lsn END AS lsn
FROM dirty WHERE error IS NOT NULL""",
    "stage_summary": f"""
WITH {_E3}
SELECT (SELECT count(*) FROM good) + (SELECT count(*) FROM dirty WHERE error IS NOT NULL) AS total,
       (SELECT count(*) FROM good) AS stage_rows, (SELECT count(*) FROM dirty WHERE error IS NOT NULL) AS bad_rows""",
    "stage_rows_per_date": f"WITH {_E3} SELECT event_date, count(*) AS n_rows FROM good GROUP BY event_date",
    "stage_rows": f"""
WITH {_E3}
SELECT 'events' AS "table", op, ts_ms, lsn, event_date, op = 'd' AS is_delete, user_id, event_id, event_type, value, props
FROM good""",
    "unknown_op_staged": f"""
WITH {_E1}, shown AS (SELECT CASE WHEN op = 'u' THEN 't' ELSE op END AS op FROM feed)
SELECT 'staged' AS outcome, op, op = 'd' AS is_delete, count(*) AS n_rows FROM shown GROUP BY ALL
UNION ALL
SELECT 'UNSUPPORTED_OP', op, NULL, count(*) FROM shown WHERE op = 't' GROUP BY ALL""",
    "entity_users": f"""
WITH {_USERS}
SELECT 'users' AS "table", 'c' AS op, 1704067200000 + user_id AS ts_ms, user_id AS lsn,
       strftime(TIMESTAMP '2024-01-01' + to_milliseconds(user_id), '%Y-%m-%d') AS event_date,
       false AS is_delete, user_id, email, country_code, CAST(NULL AS VARCHAR) AS created_at
FROM users""",
    "entity_orders": """
SELECT 'orders' AS "table", 'c' AS op, 1704067200000 + o_orderkey AS ts_ms, o_orderkey AS lsn,
       strftime(TIMESTAMP '2024-01-01' + to_milliseconds(o_orderkey), '%Y-%m-%d') AS event_date,
       false AS is_delete, o_orderkey AS order_id, o_custkey AS user_id, o_orderstatus AS status,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS total_amount, 'EUR' AS currency,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') || '000Z' AS ordered_at,
       CAST(NULL AS VARCHAR) AS updated_at, o_orderkey % 20 = 0 AS is_deleted
FROM orders""",
    "many_entities": """
SELECT 'users' AS part, count(*) AS n_rows, CAST(sum(c_custkey) AS BIGINT) AS key_sum
FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'orders', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders
UNION ALL SELECT 'UNSUPPORTED_TABLE', count(*), CAST(sum(event_id) AS BIGINT) FROM events""",
    "entity_required_fail": f"""
WITH {_USERS}
SELECT 'orders' AS "table", CASE o_orderkey % 8 WHEN 1 THEN 'ORDER_ID_NULL' WHEN 2 THEN 'USER_ID_NULL'
         WHEN 3 THEN 'STATUS_NULL' WHEN 4 THEN 'TOTAL_AMOUNT_NULL' WHEN 5 THEN 'CURRENCY_NULL'
         ELSE 'ORDERED_AT_NULL' END AS error, 'u' AS op, o_orderkey AS lsn
FROM orders WHERE o_orderkey % 8 BETWEEN 1 AND 6
UNION ALL
SELECT 'users', CASE user_id % 8 WHEN 1 THEN 'USER_ID_NULL' WHEN 2 THEN 'EMAIL_NULL' ELSE 'COUNTRY_CODE_NULL' END,
       'u', user_id
FROM users WHERE user_id % 8 BETWEEN 1 AND 3""",
    "coerce_values": """
WITH kinds AS (SELECT o_orderkey, o_orderkey % 8 AS k FROM orders)
SELECT o_orderkey, CAST(1704067200000 AS BIGINT) AS ts_ms, o_orderkey AS lsn, '2024-01-01' AS event_date,
       o_orderkey AS order_id,
       CAST(CASE k WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN 12 WHEN 3 THEN -3 ELSE 7 END AS BIGINT) AS user_id,
       CASE k WHEN 0 THEN '1.5' WHEN 1 THEN '100.0' WHEN 2 THEN 'x' WHEN 3 THEN '7' ELSE 'yes' END AS status,
       CASE k WHEN 0 THEN '120.5' WHEN 1 THEN '120.50' WHEN 2 THEN '80.0' WHEN 3 THEN '' ELSE '5' END AS total_amount,
       CASE k WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 'NOT A DATE' WHEN 3 THEN NULL
         ELSE '2024-01-02T10:00:00.5Z' END AS updated_at,
       CASE WHEN k IN (0, 1, 3, 4) THEN true WHEN k IN (2, 7) THEN false END AS is_deleted
FROM kinds""",
    "snapshot_load": f"""
WITH {_USERS}
SELECT user_id, email, country_code, 'r' AS op, 1704067200000 + user_id AS ts_ms, CAST(NULL AS BIGINT) AS lsn
FROM users""",
    "replay_dedupe": f"""
WITH {_E3} SELECT DISTINCT user_id, event_id, op, lsn, ts_ms, event_date FROM good""",
    "current_state": _CURRENT_STATE,
    "current_incremental": _CURRENT_STATE,
    "merge_job": _CURRENT_STATE,
    "merge_concurrent": _CURRENT_STATE,
    "null_keys": f"""
WITH {_E1},
last AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {_DATE_FIRST}) AS rn FROM feed WHERE lsn % 10 <> 0)
SELECT {_STATE} FROM last WHERE rn = 1 AND op <> 'd'""",
    "landed_files": """
SELECT 'source_db' AS source, 'events' AS "table", '2024-01-31' AS ingestion_date, 'nightly 2024-01-31T00:00' AS run_id,
       CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset", TRUE AS stamped
FROM events""",
    "ledger_runs": """
WITH users AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)
SELECT 'run-' || user_id AS run_id, 'a' AS start_time, CASE WHEN user_id % 3 <> 0 THEN 'b' END AS end_time,
       CASE WHEN user_id % 3 = 0 THEN 'STARTED' WHEN n % 2 = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
       CASE WHEN user_id % 3 <> 0 AND n % 2 = 1 THEN CAST(n AS VARCHAR) END AS error, '2024-01-31' AS ingestion_date
FROM users""",
    "merge_bare_dates": f"SELECT mode, s.* FROM ({_CURRENT_STATE}) s, (VALUES ('replay'), ('ordered')) m(mode)",
    "compact_job": """
SELECT 'db' AS source, 'events' AS "table", CASE event_id % 3 WHEN 0 THEN 'run:0' WHEN 1 THEN 'run 1' ELSE 'run=2' END AS run_id,
       '2024-01-31T00:00:00Z' AS ingest_ts, CASE WHEN event_id % 3 <> 0 THEN 'n' || event_id END AS note, event_id AS lsn
FROM events""",
    "pipeline_current": _CURRENT_STATE,
    # Log positions follow time in this feed, so both merge modes end in the same state.
    "stream_current": _CURRENT_STATE,
    "current_null_lsn": _current(_E2, "feed", _DATE_FIRST),
    "current_guarded": _current(_E2, "feed", _LSN_FIRST),
    "current_guarded_late": _current(_E2, "feed", _LSN_FIRST),
    "current_one_date_replay": f"""
WITH {_E1},
whole AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {_DATE_FIRST}) AS rn FROM feed),
day AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {_DATE_FIRST}) AS rn
        FROM feed WHERE event_date = '2024-01-10')
SELECT {_STATE} FROM day WHERE rn = 1 AND op <> 'd'
UNION ALL
SELECT {_STATE} FROM whole WHERE rn = 1 AND op <> 'd' AND user_id NOT IN (SELECT user_id FROM day)""",
    "merge_stats": f"WITH {_E3}, distinct_events AS (SELECT DISTINCT * FROM good),"
    + _DAILY.format(source="distinct_events"),
    "merge_stats_incremental": f"SELECT * FROM (WITH {_E1}," + _DAILY.format(source="feed") + ") WHERE event_date > '2024-01-15'",
    "pending_dates": """
WITH dates AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS event_date, day(ts) AS d FROM events)
SELECT event_date, 'new' AS asked FROM dates WHERE d % 3 <> 0
UNION ALL SELECT event_date, 'date' FROM dates WHERE event_date = '2024-01-06'
UNION ALL SELECT event_date, 'force' FROM dates""",
    "compaction_eligibility": f"""
WITH {_RUNS}
SELECT source, "table", ingestion_date, run_id FROM runs
WHERE n % 5 <> 0 AND n % 7 <> 0 AND NOT (n % 2 = 0 AND "table" = 'click')""",
    "compaction_one_date": f"""
WITH {_RUNS}
SELECT source, "table", ingestion_date, run_id FROM runs
WHERE (n % 5 = 0 OR n % 7 <> 0) AND NOT (n % 2 = 0 AND "table" = 'click') AND ingestion_date = '2024-01-05'""",
    "bronze_offsets": """
SELECT 'source_db.public.events' AS topic, CAST(user_id % 4 AS INTEGER) AS partition,
       max(event_id) AS last_committed_offset
FROM events GROUP BY ALL""",
    "resume_from_checkpoint": """
WITH r AS (SELECT CAST(user_id % 4 AS INTEGER) AS partition, event_id, ts FROM events),
ck AS (SELECT partition, max(event_id) AS last FROM r WHERE ts < TIMESTAMP '2024-01-20' AND partition <> 3 GROUP BY 1)
SELECT 'source_db.public.events' AS topic, r.partition, count(*) AS n_records, min(event_id) AS first_offset,
       max(event_id) AS last_offset
FROM r LEFT JOIN ck ON r.partition = ck.partition
WHERE event_id > coalesce(last, -1) GROUP BY r.partition""",
    "starting_offsets": """
SELECT 'source_db.public.events' AS topic, CAST(user_id % 4 AS VARCHAR) AS partition,
       max(event_id) + 1 AS next_offset
FROM events GROUP BY ALL""",
    "run_manifest": """
SELECT 'source_db' AS source, event_type AS "table", 'run-1' AS run_id, '2024-01-31' AS ingestion_date,
       'SUCCESS' AS status, 'bronze' AS kafka_group_id, 2 AS n_topics, count(DISTINCT user_id) AS n_files,
       count(*) AS rows, 5 AS offset_topics, max(event_id) FILTER (user_id % 4 = 0) AS last_of_0,
       max(event_id) FILTER (user_id % 4 = 3) AS last_of_3, CAST(NULL AS VARCHAR) AS error
FROM events GROUP BY event_type""",
    "touched_tables": """SELECT DISTINCT 'source_db' AS source, event_type AS "table" FROM events""",
    "compaction_stats": """
SELECT 'source_db' AS source, event_type AS "table", strftime(ts, '%Y-%m-%d') AS ingestion_date, 'run-1' AS run_id,
       count(DISTINCT user_id) AS parts, count(*) AS rows
FROM events GROUP BY ALL""",
    "promote_union": """
SELECT event_id, user_id, NULL AS event_type, NULL AS props FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, user_id, event_type, NULL FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, user_id, event_type, props FROM events WHERE event_type NOT IN ('click', 'view')""",
    "ledger_latest": """
SELECT 'db.public.' || event_type AS topic, user_id AS partition,
       (max(event_id) * 7919) % 1000003 AS last_committed_offset, max(event_id) AS seq
FROM events GROUP BY event_type, user_id""",
    "typed_orders": """
SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
       epoch_us(o_orderdate) AS ordered_us, o_orderkey % 20 = 0 AS is_deleted
FROM orders""",
    "typed_encoded_amounts": """
WITH cents AS (
  SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 END * CAST(o_totalprice AS DECIMAL(12,2)) * 100 AS BIGINT) AS c
  FROM orders)
SELECT o_orderkey AS order_id, CAST(c / 100.0 AS DECIMAL(12,2)) AS total_amount,
       CAST(CAST(c AS HUGEINT) * (CAST(1 AS HUGEINT) << CAST(8 * (o_orderkey % 8) AS INTEGER)) AS DECIMAL(38,0)) AS large_amount,
       CAST(((c & 255) + 128) % 256 - 128 AS DECIMAL(3,0)) AS one_byte
FROM cents""",
    "orphans": f"""
WITH {_USERS}
SELECT o_orderkey AS order_id, o_custkey AS user_id FROM orders
WHERE o_custkey NOT IN (SELECT user_id FROM users WHERE user_id % 50 <> 0)""",
    "stream_landing": """
SELECT 'source_db' AS source, 'events' AS "table", CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset",
       event_id AS lsn
FROM events""",
    "compacted_rows": """
SELECT 'source_db' AS source, event_type AS "table", '2024-01-31' AS ingestion_date, 'run-1' AS run_id, event_id AS lsn
FROM events""",
    "stage_files": f"""
WITH {_E3}
SELECT event_date, user_id, event_id, op, lsn, '2024-01-31T00:00:00Z' AS ingest_ts, op = 'd' AS is_delete, 'run-1' AS run_id
FROM good""",
    "log_landing": """
SELECT 'source_db' AS source, 'events' AS "table", CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset",
       event_id AS lsn
FROM events""",
    "rescued_run": """
SELECT 'source_db' AS source, 'events' AS "table",
       CASE WHEN event_id <= (SELECT (min(event_id) + max(event_id)) // 2 FROM events) THEN 'first' ELSE 'second' END AS run_id,
       CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset", event_id AS lsn
FROM events""",
    "restructured_run": _CURRENT_STATE,
    "landed_intervals": f"""
WITH {_LANDED},
islands AS (SELECT *, o - row_number() OVER (PARTITION BY run_id, p ORDER BY o) AS island FROM landed),
depths AS (SELECT p, o, count(*) AS times FROM landed GROUP BY p, o),
repeated AS (SELECT *, o - row_number() OVER (PARTITION BY p, times ORDER BY o) AS island FROM depths WHERE times > 1),
steps AS (SELECT p, o, lead(o) OVER (PARTITION BY p ORDER BY o) AS next FROM depths)
SELECT 'landed' AS kind, run_id, p AS partition, min(o) AS first, max(o) AS last, CAST(1 AS BIGINT) AS times
FROM islands GROUP BY run_id, p, island
UNION ALL SELECT 'duplicate', NULL, p, min(o), max(o), times FROM repeated GROUP BY p, times, island
UNION ALL SELECT 'hole', NULL, p, o + 1, next - 1, 0 FROM steps WHERE next > o + 1""",
    "landed_once": f"""
WITH {_LANDED}
SELECT min(run_id) AS run_id, p AS partition, o AS "offset", 4 * o + p AS lsn FROM landed GROUP BY p, o""",
    # a date is closed once an event a day behind its end is there; merges apply a closed date once
    "closed_dates": f"""
WITH {_E1},
waves AS (
  SELECT event_date, ts_ms, event_date = '2024-01-05' AND event_id % 2 = 0 AS is_late,
         CASE WHEN event_date <= '2024-01-15' AND NOT (event_date = '2024-01-05' AND event_id % 2 = 0) THEN 1
              WHEN event_date > '2024-01-15' AND event_date <= '2024-01-20' THEN 2 ELSE 3 END AS wave
  FROM feed),
marks AS (SELECT wave, max(max(ts_ms)) OVER (ORDER BY wave) - 86400000 AS mark FROM waves GROUP BY wave),
counts AS (SELECT event_date, count(*) AS n, count(*) FILTER (is_late) AS n_late FROM waves GROUP BY event_date),
ends AS (SELECT *, epoch_ms(CAST(event_date AS TIMESTAMP)) + 86400000 AS past FROM counts)
SELECT event_date,
       CASE WHEN past > (SELECT max(mark) FROM marks) THEN 'open' WHEN n_late > 0 THEN 'late' ELSE 'closed' END AS state,
       CASE WHEN past > (SELECT max(mark) FROM marks) THEN NULL WHEN n_late > 0 THEN n_late ELSE n END AS "rows",
       CASE WHEN past > (SELECT max(mark) FROM marks) THEN NULL ELSE n - n_late END AS merged_rows
FROM ends""",
    "stream_keyed": _current(_E2, "feed", _LSN_FIRST),
}
