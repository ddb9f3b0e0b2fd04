"""The expected result of each registered query, as SQL over the same tables.

The SQL states the rules of the test binding and of each operator directly on
``events``, ``customer`` and ``nation``; it never sees an envelope.
"""

from __future__ import annotations

# One row per event with the values its payload will hold once decoded.
_BOUND = """
WITH coded AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE event_type WHEN 'purchase' THEN 'order' WHEN 'view' THEN 'page_view'
              ELSE event_type END AS kind,
         CAST(event_id AS VARCHAR) AS id,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso,
         CAST(value AS DECIMAL(12,2)) AS price,
         CAST(json_extract_string(props, '$.k') AS INTEGER) // 25 + 1 AS quantity
  FROM events),
users AS (
  SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_mktsegment AS segment, n_name AS country,
         CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS DECIMAL(14,2)) END AS lifetime_value
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
b AS (
  SELECT *,
    CASE WHEN k NOT IN (1, 21) THEN 'seq-' || lpad(id, 12, '0') END AS seq,
    coalesce(CASE WHEN k NOT IN (1, 21) THEN 'seq-' || lpad(id, 12, '0') END, '') AS seq0,
    k > 8 AS ok,
    CASE WHEN k < 2 THEN 'missing kinesis.data' WHEN k < 4 THEN 'base64 error'
         WHEN k IN (4, 5, 8) THEN 'json error'
         WHEN k IN (6, 7) THEN 'payload is not a JSON object' END AS reason,
    CASE k WHEN 0 THEN '' WHEN 1 THEN ''
           WHEN 2 THEN lpad(id, 12, '0') || 'Q'
           WHEN 3 THEN lpad(id, 12, '0') || 'é'
           WHEN 4 THEN 'not json ' || id
           WHEN 5 THEN '{"event_id":"' || id || '"} x'
           WHEN 6 THEN '[' || id || ']'
           WHEN 7 THEN id
           WHEN 8 THEN '��' || id END AS raw,
    epoch_us(ts) / 1000000 + 90 AS arrival,
    ts + INTERVAL 90 SECOND AS arrived,
    CASE WHEN k NOT IN (11, 12) THEN id END AS ev_id,
    CASE WHEN k NOT IN (13, 14) THEN kind END AS ev_type,
    CASE WHEN k = 9 THEN 'not-a-time' WHEN k = 28 THEN iso || '+02:00'
         WHEN k <> 29 THEN iso || '+00:00' END AS ev_time,
    CASE WHEN k NOT IN (9, 29) THEN ts END AS ev_ts,
    CASE WHEN k = 16 THEN '' WHEN kind = 'signup' THEN 'new-' || user_id
         ELSE CAST(user_id AS VARCHAR) END AS uid,
    'S-' || id AS session,
    CASE WHEN k IN (18, 19, 26) THEN NULL
         WHEN kind = 'order'
         THEN CAST(quantity * price + (CASE WHEN k BETWEEN 33 AND 38 THEN 1 ELSE 0 END)
                   AS DECIMAL(14,2))
         WHEN k = 27 THEN CAST(99999 AS DECIMAL(14,2)) END AS amount
  FROM coded),
d AS (
  SELECT b.*, u.user_id IS NOT NULL AS hit,
         CASE WHEN u.user_id IS NOT NULL THEN u.segment WHEN k = 17 THEN 'own' END AS user_segment,
         u.country AS user_country, u.lifetime_value AS user_ltv,
         CASE WHEN k = 23 THEN 'backfill' ELSE 'kinesis-lambda-firehose' END AS tag,
         kind = 'order' AND k NOT IN (13, 14)
           AND CASE WHEN k = 18 THEN true WHEN k IN (19, 26) THEN false
                    ELSE amount >= 100 END AS high_value,
         k IN (10, 20, 30) AS fraud,
         CASE WHEN k IN (13, 14) THEN 'missing-partition-key'
              WHEN k = 32 THEN 'keys-differ-by-case' END AS landing_error,
         CASE WHEN k IN (11, 12) THEN 'event_id missing'
              WHEN k IN (9, 29) THEN 'event_time unreadable'
              WHEN k = 15 THEN 'is_high_value not boolean' END AS reject_rule
  FROM b LEFT JOIN users u ON u.user_id = b.uid AND b.uid <> ''
  WHERE ok),
landed AS (
  SELECT *, CAST(arrived AS DATE) AS dt, CAST(hour(arrived) AS INTEGER) AS hh
  FROM d WHERE landing_error IS NULL),
curated AS (
  SELECT ev_id AS event_id, ev_type AS event_type, ev_ts AS event_time,
    CAST(ev_ts AS DATE) AS event_date, uid AS user_id, session AS session_id, 'web' AS source,
    CASE WHEN kind = 'order' THEN 'O-' || id END AS order_id,
    CASE WHEN kind = 'order' THEN 'P-' || k END AS product_id,
    CASE WHEN kind = 'order' THEN 'Article "A", größe 1' END AS product_name,
    CASE WHEN kind = 'order' THEN 'home' END AS category,
    CAST(CASE WHEN kind = 'order' THEN CASE WHEN k = 25 THEN 3 ELSE quantity END END
         AS DECIMAL(10,0)) AS quantity,
    CASE WHEN kind = 'order' THEN price END AS unit_price,
    amount,
    CASE WHEN kind = 'order' THEN 'USD' END AS currency,
    CASE WHEN kind = 'order'
         THEN (CAST(quantity * price + (CASE WHEN k BETWEEN 33 AND 38 THEN 1 ELSE 0 END)
                    AS DECIMAL(14,2)) >= 100) <> (k = 39) END AS is_high_value,
    CASE WHEN kind = 'order' THEN 'credit_card' END AS payment_method,
    CASE WHEN kind = 'page_view' THEN '/p/' || k END AS page,
    CASE WHEN kind = 'page_view' THEN 'https://example.org/' END AS referrer,
    CASE WHEN kind = 'page_view' THEN 'Mozilla/5.0' END AS user_agent,
    CASE WHEN kind = 'signup' THEN 'u' || id || '@example.org' END AS email,
    CASE WHEN kind = 'signup' THEN 'DE' END AS country,
    CASE WHEN kind = 'signup' THEN 'organic' END AS referral_source,
    user_segment, user_country, user_ltv,
    TIMESTAMP '2024-02-01 06:00:00' AS ingested_at,
    TIMESTAMP '2024-02-01 06:00:00' AS curated_at,
    k, dt
  FROM landed WHERE reject_rule IS NULL)
"""

_FIRST_COPIES = "SELECT event_id, event_type, amount, ingested_at FROM curated"

_REPAIRED = """
SELECT event_id, event_type, event_date, amount,
       TIMESTAMP '2024-02-02 06:00:00' AS ingested_at,
       TIMESTAMP '2024-02-02 12:00:00' AS curated_at
FROM curated WHERE k BETWEEN 60 AND 74 AND dt = DATE '2024-01-15'
"""

_ENRICHED = """
SELECT seq0 AS sequence_number, ev_id AS event_id, uid AS user_id, session AS session_id, hit,
       user_segment, user_country, CAST(user_ltv AS DOUBLE) AS user_ltv, tag
FROM d
"""

_LETTERS = """
SELECT sha256('m-' || event_id || '|' || body) AS dlq_record_id,
       '2024-02-02T12:00:00.000000+00:00' AS received_at,
       'm-' || event_id AS source_message_id,
       CAST(k // 25 + 1 AS VARCHAR) AS approximate_receive_count,
       CAST(epoch_us(ts) // 1000 AS VARCHAR) AS sent_timestamp,
       'arn:example:dead-letters' AS event_source_arn,
       CASE WHEN k < 50 THEN CAST(k AS VARCHAR) END AS body_k,
       CASE WHEN k >= 50 THEN body END AS body_text
FROM (SELECT *, CASE WHEN k < 50 THEN props ELSE 'event ' || event_id || ' broken' END AS body
      FROM coded)
"""

_LANDED = """ev_id AS event_id, session AS session_id, 'web' AS source,
    CASE WHEN kind = 'order' THEN 'O-' || id END AS order_id,
    CASE WHEN kind = 'order' THEN 'P-' || k END AS product_id,
    CASE WHEN kind = 'page_view' THEN '/p/' || k END AS page,
    CASE WHEN kind = 'signup' THEN 'u' || id || '@example.org' END AS email,
    user_segment, user_country, tag AS ingestion_pipeline"""

# What was sent for each code that does not decode.
_RECEIVED = """CASE k WHEN 0 THEN NULL WHEN 1 THEN ''
    WHEN 2 THEN lpad(id, 12, '0') || 'Q' WHEN 3 THEN lpad(id, 12, '0') || 'é'
    WHEN 4 THEN base64(encode('not json ' || id))
    WHEN 5 THEN base64(encode('{"event_id":"' || id || '"} x'))
    WHEN 6 THEN base64(encode('[' || id || ']')) WHEN 7 THEN base64(encode('"' || id || '"'))
    WHEN 8 THEN base64(unhex('FFFE') || encode(id)) END"""

_CURATED_COLUMNS = "SELECT * EXCLUDE (k, dt) FROM curated"

_CONTRACT_RULES = {
    "missing event_id": "k = 11",
    "missing event_type": "k = 14",
    "missing event_time": "k = 29",
    "missing user_id": "false",
    "missing session_id": "false",
    "missing source": "false",
    "unknown type": "k IN (13, 14) OR kind NOT IN ('page_view', 'order', 'signup')",
    "incomplete page_view": "false",
    "incomplete order": "false",
    "incomplete signup": "false",
}

_EXPECTED = {
    "decode_records": """
        SELECT seq0 AS sequence_number, CAST(user_id AS VARCHAR) AS partition_key, arrival,
               ev_id AS event_id, ev_type AS event_type, ev_time AS event_time, uid AS user_id,
               session AS session_id, 'web' AS source,
               CASE WHEN kind = 'order' THEN 'Article "A", größe 1' END AS product_name,
               CASE WHEN k IN (20, 40) THEN 'geo_mismatch' END AS risk_flag
        FROM b WHERE ok""",
    "decode_failures": "SELECT seq AS sequence_number, raw, reason FROM b WHERE NOT ok",
    "partition_key": """
        SELECT seq0 AS sequence_number, session AS session_id,
               coalesce(nullif(uid, ''), ev_id, 'unknown') AS key FROM b WHERE ok""",
    "enrich_users": _ENRICHED,
    "enrich_salted": _ENRICHED,
    "enrich_hit_rate": """
        SELECT ev_type AS event_type, count(*) AS events, count(*) FILTER (hit) AS hits
        FROM d GROUP BY ev_type""",
    "high_value_orders": """
        SELECT seq0 AS sequence_number, ev_id AS event_id, session AS session_id,
               CASE WHEN k = 18 THEN 1500.0 ELSE CAST(amount AS DOUBLE) END AS amount
        FROM d WHERE high_value""",
    "fraud_signals": """
        SELECT seq0 AS sequence_number, ev_id AS event_id,
               CASE k WHEN 10 THEN 'fraud_suspected' WHEN 20 THEN ''
                      WHEN 30 THEN 'card_velocity_high' END AS fraud_signal,
               CASE WHEN k = 20 THEN 'geo_mismatch' END AS risk_flag
        FROM d WHERE fraud""",
    "alerts": """
        SELECT ev_id AS event_id, coalesce(ev_type, 'unknown') AS event_type,
               'Streaming alert: ' || coalesce(ev_type, 'unknown') AS subject,
               user_segment, user_country, session AS session_id, tag
        FROM d WHERE high_value OR fraud""",
    "route_counts": """
        SELECT ev_type AS event_type, count(*) AS delivered,
               count(*) FILTER (high_value) AS high_value, count(*) FILTER (fraud) AS fraud,
               count(*) FILTER (high_value OR fraud) AS alerts
        FROM d GROUP BY ev_type""",
    "batch_metrics": """
        SELECT (SELECT count(*) FROM d) AS processed,
               (SELECT count(*) FROM d WHERE k <> 22) AS delivered,
               (SELECT count(*) FROM d WHERE high_value OR fraud) AS alerts,
               (SELECT count(DISTINCT seq) FROM b WHERE NOT ok OR k = 22) AS failed,
               (SELECT count(*) FROM d WHERE k = 22) AS firehose_failed""",
    "batch_failures": """
        SELECT seq AS sequence_number, coalesce(reason, 'not delivered') AS reason
        FROM b WHERE seq IS NOT NULL AND (NOT ok OR k = 22)""",
    "ndjson_encode": """
        SELECT seq0 AS sequence_number, ev_id AS event_id, ev_type AS event_type,
               session AS session_id,
               CASE WHEN kind = 'order' THEN 'Article "A", größe 1' END AS product_name,
               user_segment, CAST(user_ltv AS DOUBLE) AS user_ltv, tag, false AS broken_line
        FROM d""",
    "landing_partitions": f"""
        SELECT {_LANDED}, ev_time AS event_time, uid AS user_id, ev_type AS event_type, dt, hh
        FROM landed""",
    "landing_errors": """
        SELECT seq0 AS sequence_number, session AS session_id, landing_error AS error_type,
               CAST(arrived AS DATE) AS dt, CAST(hour(arrived) AS INTEGER) AS hh
        FROM d WHERE landing_error IS NOT NULL""",
    "external_scan": """
        SELECT session AS session_id,
               CASE WHEN kind = 'order' AND k = 33 THEN ev_type || ' a=b:c' ELSE ev_type END AS event_type,
               dt, CASE WHEN hh < 12 OR dt >= DATE '2024-01-16' THEN hh END AS hh,
               CASE WHEN hh < 12 THEN 'hourly' WHEN dt < DATE '2024-01-16' THEN 'daily'
                    ELSE 'stream' END AS layout,
               true AS has_lineage
        FROM landed""",
    "raw_ingest": f"""
        SELECT {_LANDED}, ev_type AS event_type,
               ev_ts AS event_time, uid AS user_id,
               TIMESTAMP '2024-02-01 06:00:00' AS ingested_at,
               'snowpipe-firehose' AS pipeline, true AS has_lineage
        FROM landed""",
    "raw_clustered": """
        SELECT ev_id AS event_id, session AS session_id, ev_type AS event_type,
               CAST(ev_ts AS DATE) AS event_date, ev_ts AS event_time, uid AS user_id,
               TIMESTAMP '2024-02-01 06:00:00' AS ingested_at, 'snowpipe-firehose' AS pipeline
        FROM landed""",
    "file_error_gate": """
        SELECT event_type, dt, CASE WHEN broken THEN NULL ELSE n END AS rows,
               CASE WHEN broken THEN NULL ELSE n_bad END AS bad_rows,
               CASE WHEN broken THEN 'unreadable' WHEN n_bad * 10 > n THEN 'skipped' ELSE 'loaded' END AS outcome,
               CASE WHEN broken OR n_bad * 10 > n THEN 0 ELSE n - n_bad END AS loaded
        FROM (SELECT ev_type AS event_type, dt, ev_type = 'order' AND dt = DATE '2024-01-10' AS broken,
                     count(*) AS n,
                     count(*) FILTER (isodow(dt) >= 6 AND kind = 'page_view' AND '/p/' || k < '/p/45') AS n_bad
              FROM landed GROUP BY ALL)""",
    "curated_projection": _CURATED_COLUMNS,
    "curated_rejects": """
        SELECT ev_id AS event_id, session AS session_id, reject_rule
        FROM landed WHERE reject_rule IS NOT NULL""",
    "dedup_first_write": _FIRST_COPIES,
    "merge_idempotent": """
        SELECT event_id, amount, ingested_at, CAST(1 AS BIGINT) AS batch_id FROM curated""",
    "replay_merge": f"{_FIRST_COPIES} WHERE k NOT BETWEEN 50 AND 59",
    "incremental_merge": _CURATED_COLUMNS,
    "replay_equals_incremental": """
        SELECT event_type, count(*) AS incremental, count(*) AS replayed,
               CAST(0 AS BIGINT) AS differing
        FROM curated GROUP BY event_type""",
    "compact_curated": _CURATED_COLUMNS,
    "merge_after_compact": """
        SELECT event_type, count(*) AS events, count(DISTINCT event_id) AS ids,
               (SELECT count(*) FROM curated WHERE k BETWEEN 50 AND 59) AS added_0,
               (SELECT count(*) FROM curated WHERE k NOT BETWEEN 50 AND 59) AS added_1,
               CAST(0 AS BIGINT) AS added_2, CAST(0 AS BIGINT) AS added_3, CAST(0 AS BIGINT) AS added_4
        FROM curated GROUP BY event_type""",
    "late_repair": _REPAIRED,
    "late_repair_summary": f"""
        SELECT DATE '2024-01-15' AS event_date, CAST(NULL AS VARCHAR) AS event_type,
               CAST(6 AS BIGINT) AS lookback_h, count(*) AS rows_merged,
               TIMESTAMP '2024-02-02 12:00:00' AS run_at
        FROM ({_REPAIRED})""",
    "reconcile_counts": """
        SELECT ev_type AS event_type, dt, count(*) AS landed,
               count(*) FILTER (k NOT BETWEEN 60 AND 74) AS raw
        FROM landed GROUP BY ALL HAVING count(*) FILTER (k BETWEEN 60 AND 74) > 0""",
    "digest_audit": """
        SELECT ev_type AS event_type, dt, count(*) AS left_events, count(*) AS right_events
        FROM landed GROUP BY ALL HAVING count(*) FILTER (k BETWEEN 60 AND 74) > 0""",
    "retry_split": """
        SELECT seq AS sequence_number, CAST(CASE WHEN k BETWEEN 4 AND 8 THEN 2 ELSE 1 END AS BIGINT) AS attempts,
               CASE WHEN k BETWEEN 4 AND 8 THEN 'dead-letter' ELSE 'retry' END AS outcome
        FROM b WHERE NOT ok AND seq IS NOT NULL""",
    "dlq_envelope": _LETTERS,
    "dlq_archive": f"""
        SELECT *, DATE '2024-02-02' AS dt, 12 AS hh, (SELECT count(*) FROM events) AS archived
        FROM ({_LETTERS})""",
    "order_amount_audit": """
        SELECT event_id, quantity, unit_price, amount, is_high_value, wrong_amount, wrong_flag
        FROM (SELECT *, coalesce(round(quantity * unit_price, 2) <> amount, false) AS wrong_amount,
                     coalesce(is_high_value <> (amount >= 100), false) AS wrong_flag
              FROM curated WHERE event_type = 'order')
        WHERE wrong_amount OR wrong_flag""",
    "contract_audit": " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, count(*) FILTER ({test}) AS violations, count(*) AS events FROM d"
        for rule, test in _CONTRACT_RULES.items()
    ),
    "per_key_order": """
        SELECT CAST(user_id AS VARCHAR) AS partition_key, session AS session_id,
               row_number() OVER (PARTITION BY user_id ORDER BY ts, seq0, session) AS position
        FROM b WHERE ok""",
    "stream_decode": """
        SELECT seq AS sequence_number, CASE WHEN ok THEN ev_id END AS event_id,
               CASE WHEN ok THEN session END AS session_id, reason
        FROM b""",
    "stream_process": """
        SELECT count(*) FILTER (ok) AS processed, count(*) FILTER (ok) AS delivered,
               (SELECT count(*) FROM d WHERE high_value OR fraud) AS alerts,
               count(*) FILTER (NOT ok AND seq IS NOT NULL) AS failed,
               CAST(0 AS BIGINT) AS firehose_failed,
               (SELECT count(*) FROM landed) AS landed,
               (SELECT count(*) FROM d WHERE landing_error IS NOT NULL) AS unlandable,
               (SELECT count(*) FROM d WHERE high_value OR fraud) AS alert_rows,
               count(*) FILTER (NOT ok AND seq IS NOT NULL) AS failure_rows
        FROM b""",
    "stream_alerts": """
        SELECT seq AS sequence_number, CAST(CASE WHEN seq IS NULL THEN 64 ELSE 16 END AS INTEGER) AS key_length,
               ev_id AS event_id, coalesce(ev_type, 'unknown') AS event_type,
               'Streaming alert: ' || coalesce(ev_type, 'unknown') AS subject, user_segment,
               session AS session_id,
               CASE WHEN kind = 'order' THEN 'Article "A", größe 1' END AS product_name
        FROM d WHERE high_value OR fraud""",
    "stream_failures": f"""
        SELECT seq AS sequence_number, CAST(user_id AS VARCHAR) AS partition_key, arrival, raw, reason,
               {_RECEIVED} AS data
        FROM b WHERE NOT ok""",
    "stream_dead_letters": f"""
        SELECT seq AS sequence_number, coalesce({_RECEIVED}, '') AS body,
               CAST(CAST(trunc(arrival * 1000) AS BIGINT) AS VARCHAR) AS sent_timestamp,
               '2024-02-02T12:00:00.000000+00:00' AS received_at, DATE '2024-02-02' AS dt, 12 AS hh
        FROM b WHERE NOT ok""",
    "chain": """
        SELECT * EXCLUDE (k, dt) REPLACE (
            CASE WHEN dt = DATE '2024-01-15' THEN TIMESTAMP '2024-02-02 06:00:00'
                 ELSE ingested_at END AS ingested_at,
            CASE WHEN dt = DATE '2024-01-15' THEN TIMESTAMP '2024-02-02 12:00:00'
                 ELSE TIMESTAMP '2024-02-01 07:00:00' END AS curated_at)
        FROM curated""",
    "stream_restart": _CURATED_COLUMNS,
    "repair_after_compact": """
        SELECT count(*) FILTER (on_time OR dt IN (DATE '2024-01-15', DATE '2024-01-16')) AS events,
               count(DISTINCT event_id) FILTER (on_time OR dt IN (DATE '2024-01-15', DATE '2024-01-16')) AS ids,
               count(*) FILTER (NOT on_time AND dt = DATE '2024-01-15') AS repaired_1,
               count(*) FILTER (NOT on_time AND dt = DATE '2024-01-16') AS repaired_2
        FROM (SELECT *, k NOT BETWEEN 60 AND 74 AS on_time FROM curated)""",
    "levelled_compaction": """
        SELECT event_type, count(*) AS events, count(DISTINCT event_id) AS ids, CAST(1 AS BIGINT) AS batches,
               CAST(1 AS BIGINT) AS parts, CAST(2 AS BIGINT) AS level
        FROM curated GROUP BY event_type""",
    "bounded_retry": f"""
        SELECT seq AS sequence_number, coalesce({_RECEIVED}, '') AS body,
               CAST(CAST(trunc(arrival * 1000) AS BIGINT) AS VARCHAR) AS sent_timestamp,
               CASE WHEN seq IS NULL THEN '1' ELSE '4' END AS approximate_receive_count
        FROM b WHERE NOT ok""",
    "key_index": """
        SELECT event_type, count(*) AS events, count(*) AS indexed FROM curated GROUP BY event_type""",
}


# Decimals are compared as doubles and dates as text.
_AS_DOUBLE = ("quantity", "unit_price", "amount", "user_ltv")
_MONEY = ("amount",)
_COLUMNS = {
    "landing_partitions": ("dt",),
    "landing_errors": ("dt",),
    "external_scan": ("dt",),
    "raw_clustered": ("event_date",),
    "file_error_gate": ("dt",),
    "curated_projection": (*_AS_DOUBLE, "event_date"),
    "dedup_first_write": _MONEY,
    "merge_idempotent": _MONEY,
    "replay_merge": _MONEY,
    "incremental_merge": (*_AS_DOUBLE, "event_date"),
    "compact_curated": (*_AS_DOUBLE, "event_date"),
    "chain": (*_AS_DOUBLE, "event_date"),
    "stream_restart": (*_AS_DOUBLE, "event_date"),
    "stream_dead_letters": ("dt",),
    "late_repair": (*_MONEY, "event_date"),
    "late_repair_summary": ("event_date",),
    "reconcile_counts": ("dt",),
    "digest_audit": ("dt",),
    "dlq_archive": ("dt",),
    "order_amount_audit": ("quantity", "unit_price", "amount"),
}


def _portable(name: str, sql: str) -> str:
    if name not in _COLUMNS:
        return sql
    casts = ", ".join(
        f"CAST({c} AS {'DOUBLE' if c in _AS_DOUBLE else 'VARCHAR'}) AS {c}" for c in _COLUMNS[name]
    )
    return f"SELECT * REPLACE ({casts}) FROM ({sql})"


def all_oracles() -> dict[str, str]:
    return {name: _BOUND + _portable(name, sql.strip()) for name, sql in _EXPECTED.items()}
