"""The work on the test tables is spread over tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from headrace import session
from headrace.sources import bindings

PART = F.spark_partition_id


def test_a_row_group_is_no_task(spark):
    """The events lie in one row group of a file that has more splits than there are cores."""
    with session.settings(spark, {"spark.sql.files.maxPartitionBytes": "65536"}):
        sent = bindings.envelopes(spark, "/root/testdata/sf0.1")
        rows = [r["count"] for r in sent.groupBy(PART().alias("part")).count().collect()]
    cores = spark.sparkContext.defaultParallelism
    assert sum(rows) == 100_000
    assert len(rows) == cores and max(rows) < 1.5 * sum(rows) / cores


def test_tasks_grow_with_the_table(spark):
    """In whole rounds of the cores, eight here."""
    sent = bindings.envelopes(spark, "/root/testdata/sf0.1", task_rows=5_000)
    rows = [r["count"] for r in sent.groupBy(PART().alias("part")).count().collect()]
    assert len(rows) == 24 and max(rows) < 7_500
