"""Table schemas and the fixed values of the data model."""

from __future__ import annotations

import re

# --- fixed values -----------------------------------------------------------
# They appear in stored data or in results and must stay exactly as they are.

DEFAULT_HIGH_VALUE_THRESHOLD = 1000.0
FRAUD_SIGNALS = ("fraud_suspected", "card_velocity_high", "geo_mismatch")
INGESTION_PIPELINE = "kinesis-lambda-firehose"
RAW_PIPELINE = "snowpipe-firehose"
EVENT_TYPES = ("page_view", "order", "signup")
ALERT_SUBJECT = "Streaming alert: "
UNKNOWN = "unknown"
DEAD_LETTER_PREFIX = "streaming-dlq"
DEFAULT_LOOKBACK_HOURS = 6
MAX_RETRIES = 3
FILE_ERROR_RATIO_PERCENT = 10
RAW_PREVIEW = 1024

REASON_MISSING = "missing kinesis.data"
REASON_BASE64 = "base64 error"
REASON_JSON = "json error"
REASON_NOT_OBJECT = "payload is not a JSON object"

BASE_FIELDS = ("event_id", "event_type", "event_time", "user_id", "session_id", "source")
TYPE_FIELDS = {
    "page_view": ("page", "referrer", "user_agent", "ip"),
    "order": (
        "order_id",
        "product_id",
        "product_name",
        "category",
        "quantity",
        "unit_price",
        "amount",
        "currency",
        "is_high_value",
        "payment_method",
    ),
    "signup": ("email", "country", "referral_source"),
}

# --- schemas ----------------------------------------------------------------


def columns(ddl: str) -> list[str]:
    """Column names of a schema text."""
    flat = re.sub(r"<.*?>+|\(.*?\)", "", ddl)
    return [part.split()[0] for part in flat.split(",")]


ENVELOPE = (
    "sequence_number string, partition_key string, data string, "
    "approximate_arrival_timestamp double"
)

# One delivered batch as JSON: the nested form envelopes arrive in.
ENVELOPE_BATCH = (
    "Records array<struct<kinesis: struct<sequenceNumber: string, partitionKey: string, "
    "data: string, approximateArrivalTimestamp: double>, eventSource: string>>"
)

DECODED = (
    "sequence_number string, partition_key string, approximate_arrival_timestamp double, "
    "payload variant"
)

FAILED = "sequence_number string, raw string, reason string"

# A failure as it is stored: with everything that was received.
FAILURES = (
    "sequence_number string, partition_key string, approximate_arrival_timestamp double, "
    "raw string, reason string, data string"
)

USERS = "user_id string, segment string, country string, lifetime_value decimal(14,2)"

LANDING = "payload variant, event_type string, dt date, hh int"

LANDING_ERRORS = "sequence_number string, body string, error_type string, dt date, hh int"

RAW = (
    "payload variant, event_type string, event_time timestamp_ntz, user_id string, "
    "source_file string, source_row bigint, ingested_at timestamp_ntz, pipeline string"
)

CURATED = (
    "event_id string, event_type string, event_time timestamp_ntz, event_date date, "
    "user_id string, session_id string, source string, "
    "order_id string, product_id string, product_name string, category string, "
    "quantity decimal(10,0), unit_price decimal(12,2), amount decimal(14,2), "
    "currency string, is_high_value boolean, payment_method string, "
    "page string, referrer string, user_agent string, "
    "email string, country string, referral_source string, "
    "user_segment string, user_country string, user_ltv decimal(14,2), "
    "source_file string, source_row bigint, ingested_at timestamp_ntz, "
    "curated_at timestamp_ntz"
)

ALERTS = "alert_key string, event_id string, event_type string, subject string, message string"

# What became of a landed file.
LEDGER = "source_file string, rows bigint, bad_rows bigint, outcome string"

# One batch of dead-letter messages as JSON, nested as it arrives.
DEAD_LETTER_BATCH = (
    "Records array<struct<messageId: string, body: string, attributes: map<string,string>, "
    "messageAttributes: variant, eventSourceARN: string>>"
)

DEAD_LETTERS = (
    "message_id string, body string, attributes map<string,string>, "
    "message_attributes variant, event_source_arn string"
)

DEAD_LETTER_ARCHIVE = (
    "dlq_record_id string, received_at string, source_message_id string, "
    "approximate_receive_count string, sent_timestamp string, event_source_arn string, "
    "body variant, message_attributes variant, dt date, hh int"
)
