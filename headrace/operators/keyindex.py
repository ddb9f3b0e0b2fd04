"""An index of the ids of compacted parts: which files may hold an id.

A part's index has one row per row of the part: a 64-bit hash of the id and the name of the
data file. It lies in folders by a slice of the hash, as many as keep ``SLOT_ROWS`` rows in
each, and sorted by the hash within them. A batch of n ids opens at most n folders of it, in
these the pages around its hashes, and then the data files named, whose ids are compared as a
whole: two ids of one hash cost a file opened in vain and change no result. What a lookup reads
is bounded by the batch, whatever the size of the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headrace import session

SLOT_ROWS = 4_000_000  # rows of an index folder, some 40 MB
MAX_SLOTS = 1 << 16
LOOKUP_IDS = 10_000  # ids of a batch that are looked up; a larger one reads the ids of its buckets
# Up to this number of hashes each one is compared with the pages' smallest and largest value,
# beyond it only the smallest and largest hash are.
PAGED_IDS = 1_000
_COLUMNS = "hash bigint, bucket int, file string"


def slots(rows: int) -> int:
    """Folders for an index of so many rows, a power of two."""
    return min(MAX_SLOTS, 1 << max(0, (rows - 1) // SLOT_ROWS).bit_length())


def path(table: str, part: str) -> str:
    """The index of a part, found by the part's own name."""
    return f"{table}.keys/{part.rpartition('=')[2]}"


def build(spark: SparkSession, rows: DataFrame, key: str, to: str, count: int) -> int:
    """Write the index of a part's rows; returns the number of folders.

    ``rows`` are read from the part's files and have their ``bucket``.
    """
    made = slots(count)
    (
        rows.select(
            F.xxhash64(key).alias("hash"), "bucket", F.col("_metadata.file_name").alias("file")
        )
        .withColumn("slot", F.expr(f"CAST(pmod(hash, {made}) AS INT)"))
        .repartitionByRange("slot", "hash")
        .sortWithinPartitions("slot", "hash")
        .write.partitionBy("slot")
        .parquet(to)
    )
    return made


def read(spark: SparkSession, index: str) -> DataFrame:
    return spark.read.schema(f"{_COLUMNS}, slot int").parquet(index)


def hashes(batch: DataFrame, key: str) -> list[int]:
    """The distinct hashes of the ids of a batch of at most ``LOOKUP_IDS`` rows."""
    return [r[0] for r in batch.select(F.xxhash64(key)).distinct().collect()]


def holding(spark: SparkSession, indexes: list[tuple[str, str, int]], asked: list[int]) -> list[str]:
    """Data files that may hold one of the ids asked for, at most one for each id and part.

    ``indexes`` has the folder of a part, that of its index and the number of slots.
    """
    if not indexes or not asked:
        return []
    found = []
    for part, index, made in indexes:
        wanted = sorted({h % made for h in asked})
        rows = read(spark, index)
        named = F.concat(F.lit(f"{part}/bucket="), F.col("bucket"), F.lit("/"), F.col("file"))
        found.append(
            rows.where(F.col("slot").isin(wanted) & F.col("hash").isin(asked)).select(named.alias("file"))
        )
    paged = {"spark.sql.parquet.pushdown.inFilterThreshold": str(PAGED_IDS)}
    with session.settings(spark, paged if len(asked) <= PAGED_IDS else {}):
        return [r[0] for r in reduce(DataFrame.unionByName, found).distinct().collect()]
