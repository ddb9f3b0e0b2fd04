"""Joins that stay within bounds when one side is big or one key is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A join side of at most this many measured rows, and bytes where its values have no
# bound of their own, is broadcast.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


# An event is costly to decode and project: some 25 s of a core for as many as these.
ROWS_PER_TASK = 250_000


def spread(df: DataFrame, *keys, task_rows: int = ROWS_PER_TASK) -> DataFrame:
    """Give each task about as many rows of a frame of files, whatever the files and row groups.

    The splits of a file tell nothing about its rows: a row group is read by one task, however
    large it is, and the others get none. The rows are counted in the footers. Tasks come in
    whole rounds of all cores and grow in number with the rows. For rows that are short beside
    the work that follows; ``keys`` should be as good as unique.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    rounds = max(1, -(-df.count() // (cores * task_rows)))
    return df.repartition(cores * rounds, *keys)


def task_conf(spark: SparkSession, rows: int) -> dict[str, str]:
    """Settings under which shuffles of so many rows have tasks of a bounded size.

    The session's number of partitions is the least; adaptive execution merges small ones.
    """
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(least, -(-rows // ROWS_PER_TASK))
    return {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(wanted)}


def salted_join(
    left: DataFrame, right: DataFrame, on: str, how: str, salts: int, spread: list[str]
) -> DataFrame:
    """Join with each key of ``left`` spread over ``salts`` tasks.

    The salt is a hash of the ``spread`` columns, so a retried task computes the
    same one. ``right`` is repeated once per salt; ``left`` is shuffled once.
    """
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    wide = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.withColumn("_salt", salt).join(wide, [on, "_salt"], how).drop("_salt")


def keys_join(left: DataFrame, keys: DataFrame, on: str, how: str, key_rows: int) -> DataFrame:
    """Semi or anti join against ``keys`` whose row count has been measured.

    Up to ``BROADCAST_ROWS`` keys are broadcast, so ``left`` is not shuffled.
    Beyond that the join is left to shuffle both sides.
    """
    side = F.broadcast(keys) if key_rows <= BROADCAST_ROWS else keys
    return left.join(side, on, how)
