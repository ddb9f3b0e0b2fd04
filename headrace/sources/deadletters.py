"""Dead-letter messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headrace import schemas as S


def flatten(batches: DataFrame) -> DataFrame:
    """Messages out of nested batches; a batch without records gives no rows."""
    return batches.selectExpr("explode(Records) AS record").selectExpr(
        "record.messageId AS message_id",
        "record.body AS body",
        "record.attributes AS attributes",
        "record.messageAttributes AS message_attributes",
        "record.eventSourceARN AS event_source_arn",
    )


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Messages from JSON files holding one nested batch per line."""
    return flatten(spark.read.schema(S.DEAD_LETTER_BATCH).json(path))
