"""Envelopes and dimension rows derived from the test tables.

Every row of ``events`` becomes one envelope and every row of ``customer`` one
user. The code ``k`` carried in ``events.props`` picks the faults of a record, so
that each failure class and null rule meets real rows at every scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headrace.operators.skew import ROWS_PER_TASK, spread

ARRIVAL_LAG_SECONDS = 90

_TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def user_rows(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the user dimension, read from the file footers."""
    return table(spark, sf_dir, "customer").count()


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user dimension; a negative balance leaves the lifetime value open."""
    customer = spread(table(spark, sf_dir, "customer"), "c_custkey")
    nation = table(spark, sf_dir, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").selectExpr(
        "CAST(c_custkey AS STRING) AS user_id",
        "c_mktsegment AS segment",
        "n_name AS country",
        "CASE WHEN c_acctbal >= 0 THEN CAST(c_acctbal AS DECIMAL(14,2)) END AS lifetime_value",
    )


def _object(**members: str) -> str:
    """A JSON object text; members that are NULL are left out."""
    return "to_json(named_struct(" + ", ".join(f"'{k}', {v}" for k, v in members.items()) + "))"


def _when(test: str, **members: str) -> dict[str, str]:
    return {k: f"CASE WHEN {test} THEN {v} END" for k, v in members.items()}


def _event_json(amount_shift: int) -> str:
    body = _object(
        event_id="CASE WHEN k NOT IN (11, 12) THEN id END",
        event_type="CASE WHEN k NOT IN (13, 14) THEN kind END",
        event_time="""CASE WHEN k = 9 THEN 'not-a-time' WHEN k = 28 THEN iso || '+02:00'
            WHEN k <> 29 THEN iso || '+00:00' END""",
        user_id="CASE WHEN k = 16 THEN '' WHEN kind = 'signup' THEN 'new-' || user_id "
        "ELSE CAST(user_id AS STRING) END",
        session_id="'S-' || id",
        source="'web'",
        **_when(
            "kind = 'page_view'",
            page="'/p/' || k",
            referrer="'https://example.org/'",
            user_agent="'Mozilla/5.0'",
            ip="'192.0.2.1'",
        ),
        **_when(
            "kind = 'order'",
            order_id="'O-' || id",
            product_id="'P-' || k",
            product_name="""'Article "A", größe 1'""",
            category="'home'",
            quantity="CASE WHEN k = 25 THEN '2.5' ELSE CAST(quantity AS STRING) END",
            unit_price="price",
            amount=f"CASE WHEN k NOT IN (18, 19, 26) THEN amount + {amount_shift} END",
            currency="'USD'",
            is_high_value="CASE WHEN k = 39 THEN amount < 100 WHEN k <> 15 THEN amount >= 100 END",
            payment_method="'credit_card'",
        ),
        **_when(
            "kind = 'signup'",
            email="'u' || id || '@example.org'",
            country="'DE'",
            referral_source="'organic'",
        ),
        fraud_signal="CASE k WHEN 10 THEN 'fraud_suspected' WHEN 20 THEN '' "
        "WHEN 30 THEN 'card_velocity_high' WHEN 40 THEN 'other' END",
        risk_flag="CASE WHEN k IN (20, 40) THEN 'geo_mismatch' END",
        user_segment="CASE WHEN k = 17 THEN 'own' END",
        ingestion_pipeline="CASE WHEN k = 23 THEN 'backfill' END",
    )
    # Fields whose written form matters come first in the text. Under code 27 keys
    # are repeated, and the later, real values count.
    extra = """CASE k
        WHEN 12 THEN '"event_id":null'
        WHEN 13 THEN '"event_type":null'
        WHEN 15 THEN '"is_high_value":"zzz"'
        WHEN 18 THEN '"amount":" 1_500 "'
        WHEN 19 THEN '"amount":"1500d"'
        WHEN 26 THEN '"amount":[1500]'
        WHEN 27 THEN '"amount":99999,"session_id":"x"'
        WHEN 31 THEN '"Channel":"app"'
        WHEN 32 THEN '"SOURCE":"app"' END"""
    return f"'{{' || concat_ws(',', {extra}, substr({body}, 2))"


def _coded(text: str) -> str:
    return f"base64(encode({text}, 'UTF-8'))"


def envelopes(
    spark: SparkSession, sf_dir: str, rows: str = "true", amount_shift: int = 0, task_rows: int = ROWS_PER_TASK
) -> DataFrame:
    """One envelope per event; ``k`` and ``ts`` ride along for later steps.

    ``rows`` picks a delivery of its own, such as the re-sent events, and
    ``amount_shift`` tells its copies from the first ones. Written out, ``task_rows`` of the
    table make a file.
    """
    events = (
        spread(table(spark, sf_dir, "events"), "event_id", task_rows=task_rows)
        .selectExpr(
            "CAST(event_id AS STRING) AS id",
            "ts",
            "user_id",
            "CASE event_type WHEN 'purchase' THEN 'order' WHEN 'view' THEN 'page_view' "
            "ELSE event_type END AS kind",
            "CAST(value AS DECIMAL(12,2)) AS price",
            "CAST(get_json_object(props, '$.k') AS INT) AS k",
        )
        .where(rows)
        .selectExpr(
            "*",
            "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") AS iso",
            "CAST(floor(k / 25) AS INT) + 1 AS quantity",
        )
        .selectExpr(
            "*",
            "CAST(quantity * price + IF(k BETWEEN 33 AND 38, 1, 0) AS DECIMAL(14,2)) AS amount",
        )
    )
    plain = events.selectExpr(
        "id", "user_id", "ts", "k", f"{_coded(_event_json(amount_shift))} AS plain"
    )
    data = f"""CASE k
        WHEN 0 THEN NULL
        WHEN 1 THEN ''
        WHEN 2 THEN lpad(id, 12, '0') || 'Q'
        WHEN 3 THEN lpad(id, 12, '0') || 'é'
        WHEN 4 THEN {_coded("'not json ' || id")}
        WHEN 5 THEN {_coded("'{' || '\"event_id\":\"' || id || '\"} x'")}
        WHEN 6 THEN {_coded("'[' || id || ']'")}
        WHEN 7 THEN {_coded("'\"' || id || '\"'")}
        WHEN 8 THEN base64(X'FFFE' || encode(id, 'UTF-8'))
        WHEN 24 THEN ' \\n' || plain || '\\n!'
        ELSE plain END"""
    return plain.selectExpr(
        "CASE WHEN k NOT IN (1, 21) THEN 'seq-' || lpad(id, 12, '0') END AS sequence_number",
        "CAST(user_id AS STRING) AS partition_key",
        f"{data} AS data",
        "timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) / 1000000 "
        f"+ {ARRIVAL_LAG_SECONDS} AS approximate_arrival_timestamp",
        "k",
        "ts",
    )


def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dead-letter message per event; the upper half of the codes is not JSON."""
    return (
        spread(table(spark, sf_dir, "events"), "event_id")
        .selectExpr("*", "CAST(get_json_object(props, '$.k') AS INT) AS k")
        .selectExpr(
            "'m-' || event_id AS message_id",
            "CASE WHEN k < 50 THEN props ELSE 'event ' || event_id || ' broken' END AS body",
            "map('ApproximateReceiveCount', CAST(floor(k / 25) + 1 AS STRING), 'SentTimestamp', "
            "CAST(timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS STRING)) "
            "AS attributes",
            "CAST(NULL AS VARIANT) AS message_attributes",
            "'arn:example:dead-letters' AS event_source_arn",
        )
    )
