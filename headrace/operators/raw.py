"""Raw landing table: typed lookups, lineage, and the per-file error gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headrace import schemas as S
from headrace.functions import fields
from headrace.operators.skew import keys_join


def to_raw(landed: DataFrame, ingested_at) -> DataFrame:
    """Raw rows from landed rows that carry ``source_file`` and ``source_row``.

    File and row are the natural key; no counter is shared between tasks.
    """
    read = fields.members("payload", texts=("event_type", "event_time", "user_id"))
    return landed.selectExpr("payload", "source_file", "source_row", f"{read} AS _read").selectExpr(
        "payload",
        "_read.event_type AS event_type",
        f"{fields.iso_timestamp('_read.event_time')} AS event_time",
        "_read.user_id AS user_id",
        "source_file",
        "source_row",
        f"{fields.ntz(ingested_at)} AS ingested_at",
        f"'{S.RAW_PIPELINE}' AS pipeline",
    )


def raw_id(raw: DataFrame) -> DataFrame:
    """Add the surrogate id, derived from the natural key."""
    return raw.withColumn("raw_id", F.concat_ws("#", "source_file", "source_row"))


def write_clustered(raw: DataFrame, path: str) -> None:
    """Lay raw rows out by day, sorted by type within each file.

    The rebalance splits a day that outgrows the advisory size.
    """
    (
        raw.withColumn("event_date", F.to_date("event_time"))
        .hint("rebalance", "event_date")
        .sortWithinPartitions("event_date", "event_type")
        .write.option("compression", "snappy")
        .partitionBy("event_date")
        .parquet(path)
    )


def read_clustered(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{S.RAW}, event_date date").parquet(path)


def bad_row() -> str:
    """A landed row without an object payload cannot be loaded."""
    return "NOT startswith(coalesce(to_json(payload), ''), '{')"


def file_verdicts(
    rows: DataFrame, bad: str, file: str, percent: int = S.FILE_ERROR_RATIO_PERCENT
) -> DataFrame:
    """Per file: rows, bad rows, and whether the bad share exceeds the limit.

    Counts are combined before the shuffle, so a file holding a third of all rows
    costs one partial row per task.
    """
    return (
        rows.selectExpr(file, f"{bad} AS _bad")
        .groupBy(file)
        .agg(F.count("*").alias("rows"), F.count_if("_bad").alias("bad_rows"))
        .selectExpr("*", f"bad_rows * 100 > rows * {percent} AS skipped")
    )


def gate_files(
    rows: DataFrame, bad: str, file: str, skipped: DataFrame, skipped_rows: int
) -> DataFrame:
    """The good rows of files that passed.

    ``skipped`` holds the names of skipped files and ``skipped_rows`` their count;
    see ``keys_join`` for how the count picks the join.
    """
    return keys_join(rows.where(f"NOT ({bad})"), skipped, file, "left_anti", skipped_rows)
