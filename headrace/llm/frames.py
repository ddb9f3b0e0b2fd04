"""Tables, settings and stored steps, in DataFrame terms only."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headrace import session

# Batches are bounded by bytes as well as rows, so that long texts do not pile up.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20),
}

ROOT = str(Path(__file__).resolve().parents[2])


def tune(spark: SparkSession) -> SparkSession:
    """The settings the operators of this package rely on, and its folder for the workers."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        path = os.pathsep.join([ROOT, *filter(None, known)])
        spark.sparkContext.environment["PYTHONPATH"] = path
    for key, value in BATCH_CONF.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """The two columns that most operators need, in fixed types."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def release(spark: SparkSession) -> None:
    """Let the shuffle files of finished steps go that no frame refers to any more.

    Spark deletes them when the driver's collector finds their plans unused, which it may not
    look for until much later: a job of several steps would hold the files of all of them.
    """
    gc.collect()
    spark._jvm.System.gc()


def _store(frame: DataFrame, name: str) -> tuple[str, DataFrame]:
    spark = frame.sparkSession
    release(spark)
    path = session.fresh_dir(spark, f"llm-{name}")
    frame.write.parquet(path)
    return path, tune(spark).read.schema(frame.schema).parquet(path)


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: computed once, lineage cut."""
    return _store(frame, name)[1]


# Stores a step that is only needed until the result of its operator is stored.
Store = Callable[[DataFrame, str], DataFrame]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Store]:
    """Steps stored with what is given are removed at the end."""
    paths: list[str] = []

    def store(frame: DataFrame, name: str) -> DataFrame:
        path, step = _store(frame, name)
        paths.append(path)
        return step

    try:
        yield store
    finally:
        for path in paths:
            session.remove(spark, path)
