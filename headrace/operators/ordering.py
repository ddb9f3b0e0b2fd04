"""Per-key order without a task that holds a whole key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ordered(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows sorted by key and order across partitions, to be written that way.

    The order columns are part of the range key, so a hot key spans several
    consecutive partitions and its order is kept from one to the next.
    """
    return df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)


def positions(df: DataFrame, key: str, order: list[str], stage: str) -> DataFrame:
    """The position of each row within its key, from 1, as ``position``.

    The rows are sorted over all partitions and stored in ``stage``, numbered from the
    start of their partition; they are computed and ranged once, and a hot key spans as
    many partitions as its rows fill. A table with a row for each key and partition tells
    where a key begins in a partition and how many of its rows come before; it is joined
    back by both, so no task of the join holds more than a partition had.
    """
    spark = df.sparkSession
    numbered = ordered(df, key, order).selectExpr(
        "*", "spark_partition_id() AS _part", "monotonically_increasing_id() AS _at"
    )
    numbered.write.parquet(stage)
    stored = spark.read.schema(numbered.schema).parquet(stage)
    before = (
        Window.partitionBy("_key").orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = (
        stored.groupBy(F.col(key).alias("_key"), F.col("_part").alias("_in"))
        .agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
        .select(
            "_key", "_in",
            (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
        )
    )
    return (
        stored.join(shifts, (F.col("_part") == F.col("_in")) & F.col(key).eqNullSafe(F.col("_key")))
        .withColumn("position", F.col("_at") + F.col("_shift"))
        .select(*df.columns, "position")
    )
