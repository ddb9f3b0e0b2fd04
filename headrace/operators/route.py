"""Alert predicates, routing, and the batch report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace import schemas as S
from headrace.functions import fields
from headrace.operators.decode import reason_class
from headrace.operators.enrich import with_event_json


def is_high_value_order(payload: str, threshold: float) -> str:
    """An order whose amount reaches the threshold; NaN and non-numbers never do."""
    # An IF keeps the amount from being read for events that are no order.
    amount = fields.number(payload, "amount")
    return (
        f"IF({fields.text(payload, 'event_type')} = 'order', "
        f"coalesce(nanvl({amount}, DOUBLE('-Infinity')) >= {float(threshold)}D, false), false)"
    )


def is_fraud_signal(payload: str) -> str:
    """The first truthy of two risk fields is a known signal.

    An unknown truthy first field hides a known second one.
    """
    signals = ", ".join(f"'{s}'" for s in S.FRAUD_SIGNALS)
    first = fields.truthy_text(payload, "fraud_signal")
    second = fields.truthy_text(payload, "risk_flag")
    return f"coalesce(coalesce({first}, {second}) IN ({signals}), false)"


def route(records: DataFrame, threshold: float = S.DEFAULT_HIGH_VALUE_THRESHOLD) -> DataFrame:
    """Flag every record; all are delivered, those with ``is_alert`` also alert."""
    return records.selectExpr(
        "*",
        f"{is_high_value_order('payload', threshold)} AS is_high_value",
        f"{is_fraud_signal('payload')} AS is_fraud",
    ).selectExpr("*", "is_high_value OR is_fraud AS is_alert")


# What an alert says of its event, besides the event itself.
ALERT_COLUMNS = (
    "is_alert",
    "partition_key",
    "approximate_arrival_timestamp",
    f"{fields.text('payload', 'event_id')} AS alert_event_id",
    f"{fields.text('payload', 'event_type')} AS alert_event_type",
)


def alerts(routed: DataFrame) -> DataFrame:
    """One message per alerting record."""
    told = with_event_json(routed.where("is_alert"), "body")
    return alert_messages(told.selectExpr("sequence_number", "body", *ALERT_COLUMNS))


def alert_messages(told: DataFrame) -> DataFrame:
    """Alerts out of records that carry ``ALERT_COLUMNS`` and the event as ``body``.

    Every delivered record that alerts gives one. ``alert_key`` names the delivery: its
    sequence number, or a hash of the record where it has none.
    """
    record = "sha2(concat_ws('|', partition_key, approximate_arrival_timestamp, body), 256)"
    return told.where("is_alert").selectExpr(
        f"coalesce(nullif(sequence_number, ''), {record}) AS alert_key",
        "alert_event_id AS event_id",
        f"coalesce(alert_event_type, '{S.UNKNOWN}') AS event_type",
        f"'{S.ALERT_SUBJECT}' || coalesce(alert_event_type, '{S.UNKNOWN}') AS subject",
        "body AS message",
    )


def route_counts(routed: DataFrame) -> DataFrame:
    """Delivered and alerting events, by event type."""
    return routed.selectExpr(
        f"{fields.text('payload', 'event_type')} AS event_type",
        "is_high_value",
        "is_fraud",
        "is_alert",
    ).groupBy("event_type").agg(
        *_counts(
            delivered="true", high_value="is_high_value", fraud="is_fraud", alerts="is_alert"
        )
    )


def _counts(**tests: str):
    return [F.expr(f"count_if({test})").alias(name) for name, test in tests.items()]


def ndjson(records: DataFrame) -> DataFrame:
    """The delivery outlet: each enriched event as one compact JSON line."""
    return with_event_json(records, "line").select("sequence_number", "line")


def partition_key(payload: str) -> str:
    """The first truthy of user id and event id, else a fixed word."""
    return (
        f"coalesce({fields.truthy_text(payload, 'user_id')}, "
        f"{fields.truthy_text(payload, 'event_id')}, '{S.UNKNOWN}')"
    )


def batch_metrics(classified: DataFrame, alert: str, undelivered: str = "false") -> DataFrame:
    """The five counters of a batch, as one row from one pass.

    ``alert`` flags alerting records and ``undelivered`` records the delivery sink
    refused; both are expressions over the classified records.
    """
    marked = classified.selectExpr(
        "sequence_number",
        "reason IS NULL AS good",
        f"{alert} AS alerting",
        f"reason IS NULL AND coalesce({undelivered}, false) AS refused",
    )
    return marked.selectExpr(
        "count_if(good) AS processed",
        "count_if(good AND NOT refused) AS delivered",
        "count_if(good AND alerting) AS alerts",
        "count(DISTINCT CASE WHEN refused OR NOT good THEN nullif(sequence_number, '') END) AS failed",
        "count_if(refused) AS firehose_failed",
    )


def delivery_metrics(classified: DataFrame, delivered: int, alerts: int) -> DataFrame:
    """The counters of a batch whose deliveries and alerts were counted as they were written."""
    return classified.selectExpr(
        "count_if(reason IS NULL) AS processed",
        f"{delivered}L AS delivered",
        f"{alerts}L AS alerts",
        "count(DISTINCT CASE WHEN reason IS NOT NULL THEN nullif(sequence_number, '') END) AS failed",
        f"count_if(reason IS NULL) - {delivered}L AS firehose_failed",
    )


def batch_failures(classified: DataFrame, undelivered: str = "false") -> DataFrame:
    """The distinct sequence numbers to retry, each with one reason class."""
    return (
        classified.where(f"reason IS NOT NULL OR coalesce({undelivered}, false)")
        .where("sequence_number <> ''")
        .selectExpr(
            "sequence_number", f"coalesce({reason_class('reason')}, 'not delivered') AS reason"
        )
        .groupBy("sequence_number")
        .agg({"reason": "min"})
        .toDF("sequence_number", "reason")
    )
