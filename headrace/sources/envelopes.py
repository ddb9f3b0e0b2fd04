"""Envelope sources, batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headrace import schemas as S

# A file is taken whatever its age: Spark would leave out those a week older than the newest.
ANY_AGE = {"maxFileAge": "36500d"}


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.ENVELOPE).parquet(path)


def read_stream(
    spark: SparkSession, path: str, files_per_trigger: int = 1000, bytes_per_trigger: int | None = None
) -> DataFrame:
    """Envelope files as they arrive; the trigger bound, of files or bytes, keeps a batch finite."""
    if bytes_per_trigger is None:
        bound = {"maxFilesPerTrigger": files_per_trigger}
    else:
        bound = {"maxBytesPerTrigger": bytes_per_trigger}
    return spark.readStream.schema(S.ENVELOPE).options(**bound, **ANY_AGE).parquet(path)


def flatten(batches: DataFrame) -> DataFrame:
    """Envelopes out of nested batches; a batch without records gives no rows."""
    return batches.selectExpr("explode(Records) AS record").selectExpr(
        "record.kinesis.sequenceNumber AS sequence_number",
        "record.kinesis.partitionKey AS partition_key",
        "record.kinesis.data AS data",
        "record.kinesis.approximateArrivalTimestamp AS approximate_arrival_timestamp",
    )


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Envelopes from JSON files holding one nested batch per line."""
    return flatten(spark.read.schema(S.ENVELOPE_BATCH).json(path))
