"""Scans over landed files."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headrace import schemas as S
from headrace.operators.land import decoded_path, path_columns
from headrace.sources.envelopes import ANY_AGE

_SOURCE = (
    f"{decoded_path('_metadata.file_path')} AS source_file",
    "_metadata.row_index + 1 AS source_row",
)


def scan(
    spark: SparkSession, path: str, landing_date=None, event_type: str | None = None
) -> DataFrame:
    """Landed events with partition columns and file lineage.

    The arguments filter partition columns, so other folders are not opened.
    """
    df = spark.read.schema(S.LANDING).parquet(path)
    if landing_date is not None:
        df = df.where(F.col("dt") == F.lit(str(landing_date)).cast("date"))
    if event_type is not None:
        df = df.where(F.col("event_type") == event_type)
    return df.selectExpr("*", *_SOURCE)


def scan_paths(spark: SparkSession, path: str) -> DataFrame:
    """Landed events of a foreign layout, partition columns parsed from the path."""
    files = spark.read.schema("payload variant").option("recursiveFileLookup", "true")
    lineage = files.parquet(path).selectExpr("payload", *_SOURCE)
    return lineage.selectExpr("*", *path_columns("source_file"))


def new_files(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Paths of landed files as they appear, each once per checkpoint; none is opened."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .options(maxFilesPerTrigger=files_per_trigger, recursiveFileLookup="true", **ANY_AGE)
        .load(path)
        .select("path")
    )


def read_files(spark: SparkSession, root: str, files: list[str]) -> DataFrame:
    """Landed rows of some files below a landing folder, with their lineage."""
    reader = spark.read.schema(S.LANDING).option("basePath", root)
    return reader.parquet(*files).selectExpr("*", *_SOURCE)


# What readers of the format say about a file that is broken, in classes and messages.
_BROKEN_CLASSES = ("org.apache.parquet.", "java.io.EOFException", "org.apache.hadoop.fs.ChecksumException")
_BROKEN_TEXTS = ("is not a Parquet file", "can not read class org.apache.parquet.format")


def is_broken(error: Exception) -> bool:
    """Whether an error is about the content of a file, not about the store or the job.

    The classes and messages of the error's causes decide. A stack trace doesn't: a timeout in
    the middle of a file has passed through the same readers.
    """
    cause = error.java_exception if isinstance(error, Py4JJavaError) else getattr(error, "_origin", None)
    for _ in range(20):
        if cause is None:
            break
        name, text = cause.getClass().getName(), (cause.getMessage() or "").partition("\n")[0]
        if name.startswith(_BROKEN_CLASSES) or any(t in text for t in _BROKEN_TEXTS):
            return True
        cause = cause.getCause()
    return False


def same_file(path: str) -> str:
    """A decoded path in one spelling: ``file:/x`` and ``file:///x`` name the same file."""
    return f"regexp_replace({path}, '^([A-Za-z][A-Za-z0-9+.-]*):/+', '$1:/')"


def readable(spark: SparkSession, root: str, files: list[str]) -> tuple[list[str], list[str]]:
    """Files that can be read to their end, and those whose content is broken.

    All are tried together; only if that fails is the list halved, again and again, so
    one bad file among many costs a few reads. Any other error, as of the store, is raised.
    """
    if not files:
        return [], []
    try:
        read_files(spark, root, files).write.format("noop").mode("overwrite").save()
        return files, []
    except (Py4JJavaError, PySparkException) as error:
        if not is_broken(error):
            raise
        if len(files) == 1:
            return [], files
    half = len(files) // 2
    parts = [readable(spark, root, files[:half]), readable(spark, root, files[half:])]
    return parts[0][0] + parts[1][0], parts[0][1] + parts[1][1]
