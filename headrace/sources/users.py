"""The user dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headrace import schemas as S


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per user id. Read it anew for each batch, so that changes are seen."""
    return spark.read.schema(S.USERS).parquet(path)


def rows(spark: SparkSession, path: str) -> int:
    """The size of the dimension from its file footers, to decide on a broadcast."""
    return read(spark, path).count()
