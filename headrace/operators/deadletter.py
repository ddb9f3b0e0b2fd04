"""Dead letters: bounded retry, archive envelope and archive files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from headrace import schemas as S
from headrace.functions import codec, fields
from headrace.functions.once import rows_seen


def retry_split(attempts: DataFrame, max_retries: int = S.MAX_RETRIES) -> DataFrame:
    """Attempts per record and whether it is tried again or given up.

    ``attempts`` has one row per failed attempt. A record is tried once and then at
    most ``max_retries`` more times.
    """
    return (
        attempts.where(F.col("sequence_number") != "")
        .groupBy("sequence_number")
        .agg(F.count("*").alias("attempts"))
        .withColumn(
            "outcome", F.when(F.col("attempts") > max_retries, "dead-letter").otherwise("retry")
        )
    )


def envelope(letters: DataFrame, received_at) -> DataFrame:
    """Each message with its failure metadata; the body is JSON where it parses.

    The record id is a hash of the message, so a repeated task gives the same one.
    """
    message = letters.selectExpr("* EXCEPT (body)", "coalesce(body, '') AS _text").selectExpr(
        "*", f"{codec.framed_json('_text')} AS _framed"
    )
    body = f"""CASE WHEN {codec.frame_is_whole('_framed', '_text')}
        THEN {codec.framed_document('_framed')} ELSE CAST(_text AS VARIANT) END"""
    stamp = f"date_format({fields.ntz(received_at)}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") || '+00:00'"
    return message.selectExpr(
        "sha2(concat_ws('|', message_id, _text), 256) AS dlq_record_id",
        f"{stamp} AS received_at",
        "message_id AS source_message_id",
        "attributes['ApproximateReceiveCount'] AS approximate_receive_count",
        "attributes['SentTimestamp'] AS sent_timestamp",
        "event_source_arn",
        f"{body} AS body",
        "coalesce(message_attributes, parse_json('{}')) AS message_attributes",
    )


def archive_path(root: str, prefix: str = S.DEAD_LETTER_PREFIX) -> str:
    return f"{root.rstrip('/')}/{prefix.rstrip('/')}"


def letters(failures: DataFrame) -> DataFrame:
    """Stored failures as dead-letter messages: the body is all that was received.

    A record without a sequence number is named by a hash of what it holds. A column
    ``attempts`` tells how often a record was received, otherwise it was once.
    """
    received = "CAST(attempts AS STRING)" if "attempts" in failures.columns else "'1'"
    name = "sha2(concat_ws('|', partition_key, approximate_arrival_timestamp, data), 256)"
    sent = "CAST(CAST(approximate_arrival_timestamp * 1000 AS BIGINT) AS STRING)"
    return failures.selectExpr(
        f"coalesce(nullif(sequence_number, ''), {name}) AS message_id",
        "coalesce(data, '') AS body",
        f"map('ApproximateReceiveCount', {received}, 'SentTimestamp', {sent}, 'Reason', reason) AS attributes",
        "CAST(NULL AS VARIANT) AS message_attributes",
        "CAST(NULL AS STRING) AS event_source_arn",
    )


def archive(
    letters: DataFrame, root: str, run_at: datetime, prefix: str = S.DEAD_LETTER_PREFIX,
    batch: str | None = None,
) -> dict[str, int]:
    """Write the envelopes as JSON lines below ``prefix/dt=…/hh=…/batch=…``.

    The folders come from the processing time, given by the caller, and from the batch, by
    default that time: archiving a batch again replaces its own files. Many records share
    a file. Returns the number archived and, of the letters read, the number that was not;
    a failed write fails the job and is retried whole. No letters give ``archived`` alone.
    """
    received, archived = Observation(), Observation()
    (
        envelope(letters.observe(received, F.count(F.lit(1)).alias("rows")), run_at)
        .withColumns(
            {
                "dt": F.lit(f"{run_at:%Y-%m-%d}"),
                "hh": F.lit(f"{run_at:%H}"),
                "batch": F.lit(batch or f"{run_at:%Y%m%dT%H%M%S%f}"),
            }
        )
        .observe(archived, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt", "hh", "batch")
        .json(archive_path(root, prefix))
    )
    n, stored = rows_seen(received), rows_seen(archived)
    return {"archived": stored, "failed": n - stored} if n else {"archived": 0}
