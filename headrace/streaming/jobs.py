"""Structured Streaming wiring around the operators.

A batch has one run time, stored before its first try, and each of its outputs is written
once: a replay reads that time, leaves alone what was committed and writes the rest anew.

Each function starts a query and returns it. ``trigger`` is passed to the writer:
``EVERY_MINUTE`` in service, ``DRAIN`` to take what is there and stop. Several streams may
write to one place: each takes a number there, kept with its checkpoint, and its batches are
named by it and their epoch. Those of the first stream count from 1. A stream that starts over
with a new checkpoint is another one: it sees all files again and replaces nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headrace import schemas as S
from headrace import session as stores
from headrace.functions import fields
from headrace.functions.once import rows_seen
from headrace.operators import curate, deadletter, decode, enrich, land, raw, route, skew, versions
from headrace.sources import envelopes, landing
from headrace.streaming import retries

DRAIN = {"availableNow": True}
# The service intervals: landed files are cut every minute, or at the advisory
# partition size of 64 MB, whichever comes first, and merges run every minute.
EVERY_MINUTE = {"processingTime": "60 seconds"}


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _adaptive(batch: DataFrame) -> SparkSession:
    """The micro-batch session, with adaptive execution and full files for the work in it."""
    spark = batch.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    for key, value in stores.FULL_FILES.items():
        spark.conf.set(key, value)
    return spark


def _kept(spark: SparkSession, path: str, schema: str) -> list:
    """The rows of a one-row table, or none if it was not written to the end."""
    return spark.read.schema(schema).parquet(path).collect() if stores.exists(spark, path) else []


def run_time(spark: SparkSession, state: str, batch_id: int, clock) -> datetime:
    """The time of a batch, taken at its first try and the same in every later one."""
    path, schema = f"{state}/times/batch_id={batch_id}", "run_at timestamp_ntz"
    if not (known := _kept(spark, path, schema)):
        now = spark.range(1, numPartitions=1).selectExpr(f"{fields.ntz(clock())} AS run_at")
        now.write.mode("overwrite").parquet(path)
        known = _kept(spark, path, schema)
    return known[0]["run_at"]


def once(spark: SparkSession, state: str, output: str, batch_id: int, write: Callable[[], int]) -> int:
    """Write an output of a batch unless it was committed before; returns its rows.

    Files that are committed stay as they are, so a stream that reads them never loses one.
    """
    path, schema = f"{state}/{output}/batch_id={batch_id}", "rows bigint"
    if not (known := _kept(spark, path, schema)):
        rows = spark.range(1, numPartitions=1).selectExpr(f"{write()}L AS rows")
        rows.write.mode("overwrite").parquet(path)
        known = _kept(spark, path, schema)
    return known[0]["rows"]


def _counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write a frame and return its rows, counted on the way."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return rows_seen(seen)


def _replace(path: str) -> Callable[[DataFrame], None]:
    return lambda df: df.write.mode("overwrite").parquet(path)


def decode_stream(
    spark: SparkSession, source: str, out: str, checkpoint: str, files_per_trigger: int = 1000,
    trigger: dict = DRAIN,
) -> StreamingQuery:
    """Decode envelopes into a classified table, each record exactly once."""
    classified = decode.decode(envelopes.read_stream(spark, source, files_per_trigger))
    return (
        classified.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def process_stream(
    spark: SparkSession,
    source: str,
    root: str,
    checkpoint: str,
    users=None,
    user_rows=None,
    threshold: float = S.DEFAULT_HIGH_VALUE_THRESHOLD,
    files_per_trigger: int = 1000,
    partitions: tuple[str, ...] = land.PARTITIONS,
    clock=_utc_now,
    trigger: dict = DRAIN,
    salts: int = 1,
    bytes_per_trigger: int | None = None,
) -> StreamingQuery:
    """Decode, enrich and route each micro-batch into its tables below ``root``.

    ``events`` and ``errors`` are landed; ``alerts`` has a row for each alerting record,
    ``failures`` each record that did not decode with all that was received, ``reports``
    the numbers to retry and ``metrics`` the counters of the batch, its ``delivered`` and
    ``alerts`` counted from what was written. ``users`` and ``user_rows`` are callables,
    so that the dimension is read anew for each batch; ``salts`` is for dimensions too
    large to broadcast. ``bytes_per_trigger`` bounds a batch by its size instead of its
    files.
    """

    writer = versions.writer_number(spark, f"{root}/state/writers", checkpoint)

    def handle(batch: DataFrame, epoch: int) -> None:
        session = _adaptive(batch)
        batch_id, state = versions.batch_number(writer, epoch), f"{root}/state"
        if _kept(session, f"{state}/metrics/batch_id={batch_id}", "rows bigint"):
            return
        run_at = run_time(session, state, batch_id, clock)
        # Several sinks hang off one decode and one lookup; a lost copy is rebuilt from the files.
        # A trigger's few files keep few cores busy, so their records are spread first.
        records = skew.spread(batch, F.xxhash64(*S.columns(S.ENVELOPE)))
        classified = decode.decode(records, keep_data=True).persist(StorageLevel.MEMORY_AND_DISK)
        dimension = users(session) if users else None
        size = user_rows(session) if users and user_rows else None
        joined = enrich.enrich(decode.decoded(classified), dimension, salts=salts, user_rows=size)
        routed = route.route(joined, threshold)
        landed = land.prepare(routed, run_at, keep=route.ALERT_COLUMNS).persist(
            StorageLevel.MEMORY_AND_DISK
        )

        def land_part(part: DataFrame, name: str, levels: tuple[str, ...]) -> int:
            def write(df: DataFrame) -> None:
                _land_batch(df, f"{root}/{name}", levels, batch_id)

            return once(session, state, name, batch_id, lambda: _counted(part, write))

        def keep(part: DataFrame, name: str) -> int:
            path = f"{root}/{name}/batch_id={batch_id}"
            return once(session, state, name, batch_id, lambda: _counted(part, _replace(path)))

        try:
            delivered = land_part(land.landable(landed), "events", partitions)
            delivered += land_part(
                land.unlandable(landed), "errors", ("error_type", *partitions[1:])
            )
            alerting = keep(route.alert_messages(landed), "alerts")
            keep(decode.failures(classified, S.FAILURES), "failures")
            keep(route.batch_failures(classified), "reports")
            keep(route.delivery_metrics(classified, delivered, alerting), "metrics")
        finally:
            landed.unpersist()
            classified.unpersist()

    return (
        envelopes.read_stream(spark, source, files_per_trigger, bytes_per_trigger)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def archive_stream(
    spark: SparkSession,
    failures_path: str,
    root: str,
    checkpoint: str,
    files_per_trigger: int = 1000,
    clock=_utc_now,
    trigger: dict = DRAIN,
    prefix: str = S.DEAD_LETTER_PREFIX,
) -> StreamingQuery:
    """Archive the stored failures of ``process_stream`` as dead letters, each once."""
    source = (
        spark.readStream.schema(S.FAILURES)
        .options(maxFilesPerTrigger=files_per_trigger, recursiveFileLookup="true", **envelopes.ANY_AGE)
        .parquet(failures_path)
    )

    writer = versions.writer_number(spark, f"{deadletter.archive_path(root, prefix)}.state/writers", checkpoint)

    def handle(batch: DataFrame, epoch: int) -> None:
        session, state = _adaptive(batch), f"{checkpoint}/batches"
        batch_id = versions.batch_number(writer, epoch)
        run_at = run_time(session, state, batch_id, clock)
        deadletter.archive(deadletter.letters(batch), root, run_at, prefix, batch=str(batch_id))

    return (
        source.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def retry_stream(
    spark: SparkSession,
    failures_path: str,
    redeliver_path: str,
    root: str,
    checkpoint: str,
    max_retries: int = S.MAX_RETRIES,
    backoff_s: float = 1.0,
    forget_s: float = 86_400.0,
    files_per_trigger: int = 1000,
    clock=_utc_now,
    trigger: dict = DRAIN,
    prefix: str = S.DEAD_LETTER_PREFIX,
) -> StreamingQuery:
    """Send the failures of ``process_stream`` again, each a bounded number of times.

    Due records become envelopes below ``redeliver_path``, which another ``process_stream`` over
    ``{redeliver_path}/*`` with the same root takes up; its failures come back here. Records
    that failed once more after their last retry are archived below ``root`` with the number of
    times they were received. The state store is the session's; RocksDB suits many records in trouble.
    """
    source = (
        spark.readStream.schema(S.FAILURES)
        .options(maxFilesPerTrigger=files_per_trigger, recursiveFileLookup="true", **envelopes.ANY_AGE)
        .parquet(failures_path)
    )
    writer = versions.writer_number(spark, f"{redeliver_path}.state/writers", checkpoint)

    def handle(batch: DataFrame, epoch: int) -> None:
        session, state = _adaptive(batch), f"{checkpoint}/batches"
        batch_id = versions.batch_number(writer, epoch)
        run_at = run_time(session, state, batch_id, clock)
        # Both outputs hang off one step of the state.
        told = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            again = told.where(F.col("outcome") == retries.RETRY).select(*S.columns(S.ENVELOPE))
            write = _replace(f"{redeliver_path}/batch_id={batch_id}")
            once(session, state, "redelivered", batch_id, lambda: _counted(again, write))
            given_up = told.where(F.col("outcome") == retries.DEAD)
            deadletter.archive(deadletter.letters(given_up), root, run_at, prefix, batch=str(batch_id))
        finally:
            told.unpersist()

    decided = retries.outcomes(source, max_retries, backoff_s, forget_s)
    with stores.settings(spark, retries.DRAINING if trigger == DRAIN else {}):
        return (
            decided.writeStream.foreachBatch(handle)
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )


def _land_batch(part: DataFrame, path: str, partitions: tuple[str, ...], batch_id: int) -> None:
    """Write one batch under its own last folder level, replacing an earlier try."""
    with stores.settings(part.sparkSession, stores.ALL_CORES):
        (
            land.layout(land.without_hour(part, partitions), partitions)
            .withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "snappy")
            .partitionBy(*partitions, "batch_id")
            .parquet(path)
        )


def ingest_stream(
    spark: SparkSession,
    landing_path: str,
    raw_path: str,
    checkpoint: str,
    files_per_trigger: int = 1000,
    clock=_utc_now,
    trigger: dict = DRAIN,
) -> StreamingQuery:
    """Load landed files once each, leaving out broken ones and those with too many bad rows.

    The stream is one of file names, at most ``files_per_trigger`` at a time, so a file
    whose content is broken takes no other with it. What became of each file is written to
    ``{raw_path}.ledger``; a file that it has as loaded or skipped is not taken again, whatever
    checkpoint the stream has. Broken files stay open: each batch tries as many of them again,
    and those that were repaired are loaded. An error of the store fails the batch, which is
    then tried as a whole.
    """

    writer = versions.writer_number(spark, f"{raw_path}.state/writers", checkpoint)

    def handle(batch: DataFrame, epoch: int) -> None:
        session = _adaptive(batch)
        batch_id, state = versions.batch_number(writer, epoch), f"{raw_path}.state"
        run_at = run_time(session, state, batch_id, clock)
        folder = f"batch_id={batch_id}"
        ledger = _replace(f"{raw_path}.ledger/{folder}")

        def load(good: list[str], broken: list[str]) -> None:
            lost = session.createDataFrame([(f, None, None, "unreadable") for f in broken], S.LEDGER)
            if not good:
                once(session, state, "ledger", batch_id, lambda: _counted(lost, ledger))
                return
            rows = landing.read_files(session, landing_path, good)
            rows = rows.selectExpr("*", f"{raw.bad_row()} AS _bad").persist(StorageLevel.MEMORY_AND_DISK)
            try:
                judged = raw.file_verdicts(rows, "_bad", "source_file").selectExpr(
                    "source_file", "rows", "bad_rows", "IF(skipped, 'skipped', 'loaded') AS outcome"
                )
                told = judged.unionByName(lost)
                once(session, state, "ledger", batch_id, lambda: _counted(told, ledger))
                skipped = session.read.schema(S.LEDGER).parquet(f"{raw_path}.ledger/{folder}")
                skipped = skipped.where("outcome = 'skipped'").select("source_file")
                kept = raw.gate_files(rows, "_bad", "source_file", skipped, files_per_trigger)
                write = _replace(f"{raw_path}/{folder}")
                once(session, state, "rows", batch_id, lambda: _counted(raw.to_raw(kept, run_at), write))
            finally:
                rows.unpersist()

        told = _told(session, f"{raw_path}.ledger/{folder}")
        if told:  # an earlier try has settled what is loaded
            load([f for f, outcome in told if outcome != "unreadable"], [])
            return
        files, open_ = _to_load(session, raw_path, batch, files_per_trigger)
        files += landing.readable(session, landing_path, open_)[0]
        try:
            load(files, [])
        except (Py4JJavaError, PySparkException) as error:
            if not landing.is_broken(error):
                raise
            # Nothing of the batch was written. Find the files that are broken, if any.
            good, broken = landing.readable(session, landing_path, files)
            if not broken:
                raise
            load(good, broken)

    return (
        landing.new_files(spark, landing_path, files_per_trigger)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _told(spark: SparkSession, folder: str) -> list[tuple[str, str]]:
    """File and outcome of each row of a batch's ledger, or nothing if it has none."""
    return [(r["source_file"], r["outcome"]) for r in _kept(spark, folder, S.LEDGER)]


def _to_load(
    spark: SparkSession, raw_path: str, batch: DataFrame, most: int
) -> tuple[list[str], list[str]]:
    """Files of a batch that the ledger does not have, and up to ``most`` broken ones it has open."""
    named = batch.selectExpr("path", f"{landing.same_file('path')} AS name")
    files = {r["name"]: r["path"] for r in named.collect()}
    if not stores.exists(spark, f"{raw_path}.ledger"):
        return list(files.values()), []
    # As many names as a trigger takes; the ledger has one row per file and is not shuffled for them.
    ledger = read_ledger(spark, raw_path).selectExpr(
        f"{landing.same_file('source_file')} AS name", "source_file", "outcome <> 'unreadable' AS done"
    )
    asked = spark.createDataFrame([(n,) for n in files], "name string")
    known = ledger.where("done").join(F.broadcast(asked), "name", "left_semi").select("name").distinct()
    for row in known.collect():
        del files[row["name"]]
    waiting = ledger.groupBy("name").agg(F.max("done").alias("done"), F.max("source_file").alias("path"))
    broken = [r["path"] for r in waiting.where("NOT done").orderBy("name").limit(most).collect() if r["name"] not in files]
    return list(files.values()), [path for path in broken if stores.exists(spark, path)]


def read_ledger(spark: SparkSession, raw_path: str) -> DataFrame:
    return spark.read.schema(f"{S.LEDGER}, batch_id bigint").parquet(f"{raw_path}.ledger")


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{S.RAW}, batch_id bigint").parquet(path)


def merge_stream(
    spark: SparkSession,
    raw_path: str,
    curated_path: str,
    checkpoint: str,
    files_per_trigger: int = 1000,
    clock=_utc_now,
    trigger: dict = DRAIN,
    fan: int | None = curate.FAN,
) -> StreamingQuery:
    """Merge new raw rows into the curated table; rejects are kept per batch.

    Without new files no batch runs. After each batch levels with ``fan`` parts are compacted;
    None leaves that to another job.
    """
    curate.create_target(spark, f"{curated_path}/events")
    source = (
        spark.readStream.schema(S.RAW)
        .options(maxFilesPerTrigger=files_per_trigger, recursiveFileLookup="true", **envelopes.ANY_AGE)
        .parquet(raw_path)
    )

    writer = versions.writer_number(spark, f"{curated_path}/state/writers", checkpoint)

    def handle(batch: DataFrame, epoch: int) -> None:
        session = _adaptive(batch)
        batch_id = versions.batch_number(writer, epoch)
        run_at = run_time(session, f"{curated_path}/state", batch_id, clock)
        # Projected once, for rejects and merge, into files: a batch may be a whole raw table.
        stage = f"{curated_path}/stage/{batch_id}-projected"
        try:
            curate.project(batch, run_at).write.mode("overwrite").parquet(stage)
            projected = session.read.schema(f"{S.CURATED}, reject_rule string").parquet(stage)
            curate.rejects(projected).write.mode("overwrite").parquet(
                f"{curated_path}/rejects/batch_id={batch_id}"
            )
            curate.merge(
                session,
                curate.accepted(projected),
                f"{curated_path}/events",
                batch_id,
                f"{curated_path}/stage/{batch_id}",
            )
            if fan:
                curate.compact_levels(session, f"{curated_path}/events", fan)
        finally:
            stores.remove(session, stage)

    return (
        source.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
