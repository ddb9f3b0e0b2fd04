"""Typed projection, rejects, de-duplication and the insert-only merge."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from headrace import schemas as S
from headrace import session
from headrace.functions import fields
from headrace.functions.once import rows_seen, with_once
from headrace.operators import keyindex, versions
from headrace.operators.skew import BROADCAST_BYTES, BROADCAST_ROWS, task_conf

_TEXT_FIELDS = (
    "event_id", "event_type", "user_id", "session_id", "source", "order_id", "product_id",
    "product_name", "category", "currency", "payment_method", "page", "referrer", "user_agent",
    "email", "country", "referral_source", "user_segment", "user_country",
)
_TYPED_FIELDS = ("event_time", "quantity", "unit_price", "amount", "user_lifetime_value")
# Earliest first; file and row settle ties, so every run keeps the same copy.
FIRST_WRITE = ("ingested_at", "source_file", "source_row")


def project(rows: DataFrame, curated_at, payload: str = "payload") -> DataFrame:
    """Typed columns and, for rows that break a rule, its name in ``reject_rule``.

    ``rows`` holds the payload with ``source_file``, ``source_row`` and
    ``ingested_at``. Rules are the admission test (id present, time readable), the
    NOT NULL columns and strict types; a bad row is set aside, never the batch.
    """
    read = fields.members(payload, texts=(*_TEXT_FIELDS, *_TYPED_FIELDS), values=("is_high_value",))
    typed = {
        **{name: f"_read.{name}" for name in _TEXT_FIELDS},
        "event_time": fields.iso_timestamp("_read.event_time"),
        "_quantity": "try_cast(_read.quantity AS DECIMAL(38,0))",
        "unit_price": "try_cast(_read.unit_price AS DECIMAL(12,2))",
        "amount": "try_cast(_read.amount AS DECIMAL(14,2))",
        "is_high_value": fields.flag("_read.is_high_value"),
        "user_ltv": "try_cast(_read.user_lifetime_value AS DECIMAL(14,2))",
        "curated_at": fields.ntz(curated_at),
        "_flag_text": fields.value_text("_read.is_high_value"),
    }
    values = rows.selectExpr(*FIRST_WRITE, f"{read} AS _read").selectExpr(
        *FIRST_WRITE, *(f"{value} AS {name}" for name, value in typed.items())
    ).selectExpr(
        "*",
        "to_date(event_time) AS event_date",
        "try_cast(_quantity AS DECIMAL(10,0)) AS quantity",
    )
    rule = """CASE
        WHEN event_id IS NULL THEN 'event_id missing'
        WHEN event_time IS NULL THEN 'event_time unreadable'
        WHEN event_type IS NULL THEN 'event_type missing'
        WHEN _flag_text IS NOT NULL AND is_high_value IS NULL THEN 'is_high_value not boolean'
        WHEN _quantity IS NOT NULL AND quantity IS NULL THEN 'quantity out of range' END"""
    return with_once(values, {"reject_rule": rule}).select(*S.columns(S.CURATED), "reject_rule")


def accepted(projected: DataFrame) -> DataFrame:
    return projected.where("reject_rule IS NULL").drop("reject_rule")


def rejects(projected: DataFrame) -> DataFrame:
    return projected.where("reject_rule IS NOT NULL")


def first_write(rows: DataFrame, key: str = "event_id", order: tuple[str, ...] = FIRST_WRITE) -> DataFrame:
    """One row per key, the earliest by ``order``.

    ``min_by`` keeps one candidate per key in every task before the shuffle, so an id
    repeated in a third of all rows sends one row per task.
    """
    whole = F.struct(*rows.columns)
    return (
        rows.groupBy(key)
        .agg(F.min_by(whole, F.struct(*order)).alias("_row"))
        .select(*(F.col("_row")[c].alias(c) for c in rows.columns))
    )


def insert_small(
    batch: DataFrame, target: DataFrame, key: str, order: tuple[str, ...], stage: str
) -> DataFrame:
    """New rows of a batch of at most ``BROADCAST_ROWS`` rows.

    The de-duplicated batch is staged once, which fixes it for both joins. Its keys
    are broadcast against the one key column of the target, which is not shuffled,
    and the keys found, no more than the batch has, are broadcast back.
    """
    first_write(batch, key, order).write.mode("overwrite").parquet(stage)
    fixed = batch.sparkSession.read.schema(batch.schema).parquet(stage)
    seen = target.select(key).join(F.broadcast(fixed.select(key)), key, "left_semi")
    return fixed.join(F.broadcast(seen), key, "left_anti")


def insert_large(
    batch: DataFrame, target: DataFrame, key: str, order: tuple[str, ...], stage: str
) -> DataFrame:
    """New rows of a batch of any size, such as a replay of the raw table.

    Only keys are shuffled at first: their copies are counted, before the shuffle
    where they can be, and looked up in the target. Keys that occur once and are new,
    nearly all of them, need no more; the others are staged and counted. While
    those are few enough to broadcast, whole rows are shuffled only for keys that
    repeat. Otherwise the batch is shuffled once for both steps.
    """
    spark = batch.sparkSession
    counted = Observation()
    held = target.select(key).withColumn("_held", F.lit(True))
    (
        batch.groupBy(key)
        .agg(F.count("*").alias("_copies"))
        .join(held, key, "left")
        .where("_held OR _copies > 1")
        .select(key, F.coalesce("_held", F.lit(False)).alias("_held"))
        .observe(
            counted, F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length(key)).alias("bytes")
        )
        .write.mode("overwrite")
        .parquet(stage)
    )
    special = spark.read.schema(f"{key} string, _held boolean").parquet(stage)
    if rows_seen(counted) > BROADCAST_ROWS or rows_seen(counted, "bytes") > BROADCAST_BYTES:
        return first_write(batch, key, order).join(held, key, "left_anti")
    marked = batch.join(F.broadcast(special), key, "left")
    single = marked.where("_held IS NULL").select(*batch.columns)
    repeated = marked.where("NOT _held").select(*batch.columns)
    return single.unionByName(first_write(repeated, key, order))


# Compacted rows lie in buckets of their id, so that a batch is matched with its buckets only.
BUCKETS = 64
FAN = 8  # parts of one level that are compacted together


def bucket(key: str = "event_id") -> str:
    return f"CAST(pmod(xxhash64({key}), {BUCKETS}) AS INT)"


def create_target(spark: SparkSession, path: str, schema: str = S.CURATED) -> None:
    """Begin the log of an empty table, unless it has one."""
    if not versions.latest(spark, path).number:
        versions.publish(spark, path, versions.Version())


def _rows(
    spark: SparkSession, path: str, parts: list[versions.Part], schema: str,
    buckets: list[int] | None = None, files: list[str] = (),
) -> DataFrame:
    """The rows of some parts with the ``batch_id`` that wrote them, 0 if they were compacted.

    With ``buckets`` only these are read of compacted parts. They are folders, so no other
    one is opened. ``files`` of other compacted parts are read beside them.
    """
    merged = [p.path for p in parts if p.level == 0]
    compacted = [*(p.path for p in parts if p.level), *files]
    out = spark.createDataFrame([], f"{schema}, batch_id bigint")
    if merged:
        reader = spark.read.schema(f"{schema}, batch_id bigint, try string").option("basePath", path)
        out = reader.parquet(*merged).drop("try")
    if compacted:
        reader = spark.read.schema(f"{schema}, part string, bucket int").option("basePath", f"{path}.compacted")
        rows = reader.parquet(*compacted)
        if buckets is not None:
            rows = rows.where(F.col("bucket").isin(buckets))
        rows = rows.withColumn("batch_id", F.lit(0).cast("bigint")).drop("bucket", "part")
        out = rows.unionByName(out) if merged else rows
    return out


def read_target(
    spark: SparkSession, path: str, schema: str = S.CURATED, buckets: list[int] | None = None
) -> DataFrame:
    """The rows of the newest version. What is merged or compacted later changes nothing of it."""
    return _rows(spark, path, list(versions.latest(spark, path).parts), schema, buckets)


def rivals(
    spark: SparkSession, path: str, parts: list[versions.Part], fixed: DataFrame, rows: int,
    schema: str = S.CURATED, key: str = "event_id",
) -> DataFrame:
    """Rows of some parts among which are all that share an id with a batch of ``rows`` rows.

    Of parts with a key index a small batch reads only the files that may hold one of its ids,
    a larger one the buckets its ids fall in. Merged parts, which are small, are read as a whole.
    """
    files: list[str] = []
    if rows <= keyindex.LOOKUP_IDS and (indexed := [p for p in parts if p.slots]):
        indexes = [(p.path, keyindex.path(path, p.path), p.slots) for p in indexed]
        files = keyindex.holding(spark, indexes, keyindex.hashes(fixed, key))
        parts = [p for p in parts if not p.slots]
    if not any(p.level for p in parts):
        return _rows(spark, path, parts, schema, files=files)
    # As many rows as there are buckets.
    touched = [r[0] for r in fixed.selectExpr(bucket(key)).distinct().collect()]
    return _rows(spark, path, parts, schema, touched, files)


def merge(
    spark: SparkSession,
    batch: DataFrame,
    path: str,
    batch_id: int,
    stage_path: str,
    schema: str = S.CURATED,
    key: str = "event_id",
    order: tuple[str, ...] = FIRST_WRITE,
    batch_rows: int | None = None,
) -> int:
    """Insert the batch rows whose key is new; returns the number inserted.

    The first copy of a key stays for good: nothing is updated or deleted. The batch is
    computed once, into ``stage_path``, which is removed at the end. ``batch_rows``, or
    else the rows staged, picks how keys are matched. Rows become a part of the table when a
    version names it. If another merge or compaction was first, the keys are matched again with
    what it left; any number of jobs may write. A batch merged again takes the place of its
    earlier rows, if they were not compacted yet. Stream batches count from 1 and
    repairs down from -1.
    """
    if batch_id == 0:
        raise ValueError("batch_id 0 stands for compacted rows")
    staged = Observation()
    (
        batch.select(*S.columns(schema))
        .observe(
            staged, F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length(key)).alias("bytes")
        )
        .write.mode("overwrite")
        .parquet(f"{stage_path}/rows")
    )
    fixed = spark.read.schema(schema).parquet(f"{stage_path}/rows")
    size = rows_seen(staged) if batch_rows is None else batch_rows
    small = size <= BROADCAST_ROWS and rows_seen(staged, "bytes") <= BROADCAST_BYTES
    insert = insert_small if small else insert_large
    try:
        while True:
            now = versions.latest(spark, path)
            own = [p for p in now.parts if p.batch_id == batch_id]
            others = rivals(spark, path, [p for p in now.parts if p not in own], fixed, size, schema, key)
            part = f"{path}/batch_id={batch_id}/try={versions.new_name()}"
            inserted = Observation()
            # The rows of a task do not grow with the batch and the table.
            with session.settings(spark, task_conf(spark, size + sum(p.rows for p in now.parts))):
                fresh = insert(fixed, others, key, order, f"{stage_path}/keys")
                counted = fresh.observe(inserted, F.count(F.lit(1)).alias("rows"))
                clustered = [c for c in ("event_date", "event_type") if c in fresh.columns]
                if clustered:
                    counted = counted.sortWithinPartitions(*clustered)
                counted.write.parquet(part)
            rows = rows_seen(inserted)
            changed = now.dropping(own).adding(versions.Part(part, rows, 0, batch_id))
            if versions.publish(spark, path, changed):
                return rows
            session.remove(spark, part)
    finally:
        session.remove(spark, stage_path)


def _rewrite(spark: SparkSession, path: str, parts: list[versions.Part], level: int, schema: str) -> int | None:
    """Put the rows of some parts into one, by bucket and sorted by date, type and id.

    Returns the version that has it, or none if another compaction took one of the parts.
    """
    fresh = f"{path}.compacted/part={versions.new_name()}"
    order = ("bucket", "event_date", "event_type", "event_id")
    written = Observation()
    with session.settings(spark, task_conf(spark, sum(p.rows for p in parts))):
        (
            _rows(spark, path, parts, schema)
            .drop("batch_id")
            .withColumn("bucket", F.expr(bucket()))
            # The range key goes on behind the bucket, so one bucket may span many files.
            .repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .observe(written, F.count(F.lit(1)).alias("rows"))
            .write.option("compression", "snappy")
            .partitionBy("bucket")
            .parquet(fresh)
        )
        count, index = rows_seen(written), keyindex.path(path, fresh)
        kept = spark.read.schema(f"{schema}, bucket int").parquet(fresh)
        made = versions.Part(fresh, count, level, 0, keyindex.build(spark, kept, "event_id", index, count))

    def swap(now: versions.Version) -> versions.Version | None:
        if not set(parts) <= set(now.parts):
            return None
        swapped = now.dropping(parts).adding(made)
        return replace(swapped, compactions=(*now.compactions, now.number + 1)[-10:])

    if (changed := versions.update(spark, path, swap)) is None:
        session.remove(spark, fresh)
        session.remove(spark, index)
        return None
    versions.expire(spark, path)
    return changed.number + 1


def compact(spark: SparkSession, path: str, schema: str = S.CURATED) -> int | None:
    """Rewrite all live rows into one part; returns its version.

    Rows merged meanwhile stay live beside it. The parts it replaces are read on by those who
    began before, and deleted by the compaction after this one. A replay of a compacted batch
    finds its rows in the compaction and adds none.
    """
    parts = list(versions.latest(spark, path).parts)
    return _rewrite(spark, path, parts, max([1, *(p.level for p in parts)]), schema) if parts else None


def compact_levels(spark: SparkSession, path: str, fan: int = FAN, schema: str = S.CURATED) -> list[int]:
    """Merge each level that has ``fan`` parts into one part of the next level.

    A row is rewritten once a level, as often as the logarithm of the table's batches, and
    most rounds touch small parts only. Parts without rows are dropped. Returns the levels that
    were merged.
    """
    def without_empty(now: versions.Version) -> versions.Version | None:
        empty = [p for p in now.parts if not p.rows]
        return now.dropping(empty) if empty else None

    versions.update(spark, path, without_empty)
    done: list[int] = []
    while True:
        levels: dict[int, list[versions.Part]] = {}
        for part in versions.latest(spark, path).parts:
            levels.setdefault(part.level, []).append(part)
        full = min((k for k, parts in levels.items() if len(parts) >= fan), default=None)
        if full is None:
            return done
        if _rewrite(spark, path, levels[full], full + 1, schema) is not None:
            done.append(full)
