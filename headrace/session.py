"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Runtime settings every operator relies on.
REQUIRED_CONF = {
    # Base64 without line breaks, which the fast path of decoding compares with.
    "spark.sql.chunkBase64String.enabled": "false",
    # A JSON object may repeat a key; the last value wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Runtime settings for speed; a value the session already carries is kept.
PREFERRED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Parsing and partitioned writes are work for every core even on small inputs;
    # at scale partitions are far above this.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.parquet.compression.codec": "snappy",
    # The JVM does not compile methods of more than 8,000 bytes of code: a stage fused into one
    # such method would be interpreted row by row, which is slower than not fusing it.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session and return it."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, value in PREFERRED_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


# Files are cut at the advisory size, however many cores there are; without this, adaptive
# execution prefers as many small files as cores.
FULL_FILES = {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}


# Rows brought together by partition columns give a file for each of their values, in few tasks
# or in many: the write then takes all cores. Large partitions are cut at the advisory size.
ALL_CORES = {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "true"}


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Run with other settings, then put the earlier ones back."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def build(master: str = "local[*]", app: str = "headrace", **conf: str) -> SparkSession:
    """A session for tests and for the bench."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master, whose tasks all run on this machine, may go without the
    setting; it then gets a fresh temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="headrace-")
    return _LOCAL_ROOTS[app]


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unused folder name below the shared root."""
    return f"{shared_root(spark)}/headrace/{name}-{uuid.uuid4().hex}"


def _located(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    store, found = _located(spark, path)
    return store.exists(found)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that is no longer read."""
    store, found = _located(spark, path)
    store.delete(found, True)


def remove_empty(spark: SparkSession, path: str) -> None:
    """Delete a folder if nothing is in it."""
    store, found = _located(spark, path)
    if store.exists(found) and not store.listStatus(found):
        store.delete(found, False)


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, in order; none if it is not there."""
    store, found = _located(spark, folder)
    if not store.exists(found):
        return []
    return sorted(entry.getPath().getName() for entry in store.listStatus(found))


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    store, found = _located(spark, path)
    stream = store.open(found)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small text file unless it is there already; whether it was written.

    The text is complete under another name before it gets this one, and the store does not
    rename onto a file that exists, so of several writers one succeeds.
    """
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    store, source = _located(spark, draft)
    stream = store.create(source, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    context = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(store.makeQualified(source), store.makeQualified(target), plain)
        return True
    except Py4JJavaError as error:
        if not store.exists(target):
            raise
        store.delete(source, False)
        return False
