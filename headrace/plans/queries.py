"""The registered queries: each operator run over the whole test tables.

Every query takes a session and a table folder and returns a DataFrame of scalar
columns. Queries that write read their output back.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from headrace import schemas as S
from headrace.functions import fields
from headrace.operators import (
    audit,
    curate,
    deadletter,
    decode,
    enrich,
    keyindex,
    land,
    late,
    ordering,
    raw,
    route,
    versions,
)
from headrace.session import fresh_dir, tune
from headrace.sources import bindings, landing
from headrace.streaming import jobs

THRESHOLD = 100.0
FIRST_RUN = datetime(2024, 2, 1, 6, 0, 0)
SECOND_RUN = datetime(2024, 2, 1, 7, 0, 0)
REPAIR_RUN = datetime(2024, 2, 2, 12, 0, 0)
REPAIR_DATE = "2024-01-15"
NEXT_DATE = "2024-01-16"

# Codes of the events sent a second time, and of those that reach the landing
# folder but are late for the raw table.
RESENT = "k BETWEEN 50 AND 59"
ON_TIME = "k NOT BETWEEN 60 AND 74"

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


# Result types that every client holds alike: decimals here have few digits.
_PORTABLE = {"decimal": "double", "date": "string"}


def _portable(df: DataFrame) -> DataFrame:
    casts = {
        name: _PORTABLE[kind.partition("(")[0]]
        for name, kind in df.dtypes
        if kind.partition("(")[0] in _PORTABLE
    }
    return df.withColumns({name: F.col(name).cast(kind) for name, kind in casts.items()}) if casts else df


def _query(run: Query) -> Query:
    def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _portable(run(tune(spark), sf_dir))

    tuned.__doc__ = run.__doc__
    _QUERIES[run.__name__] = tuned
    return tuned


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- shared steps -----------------------------------------------------------


def _classified(spark: SparkSession, sf_dir: str, rows: str = "true", shift: int = 0) -> DataFrame:
    return decode.decode(bindings.envelopes(spark, sf_dir, rows, shift))


def _enriched(spark: SparkSession, sf_dir: str, rows: str = "true", shift: int = 0) -> DataFrame:
    return enrich.enrich(
        decode.decoded(_classified(spark, sf_dir, rows, shift)),
        bindings.users(spark, sf_dir),
        user_rows=bindings.user_rows(spark, sf_dir),
    )


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route.route(_enriched(spark, sf_dir), THRESHOLD)


def _prepared(spark: SparkSession, sf_dir: str, rows: str = "true", shift: int = 0) -> DataFrame:
    return land.prepare(_enriched(spark, sf_dir, rows, shift), FIRST_RUN)


def _loaded(spark: SparkSession, sf_dir: str, run_at, rows: str = "true", shift: int = 0) -> DataFrame:
    """Raw rows of one delivery, straight from the decoded events."""
    return _raw(land.landable(_prepared(spark, sf_dir, rows, shift)), run_at)


def _raw(landable: DataFrame, run_at) -> DataFrame:
    landed = landable.selectExpr(
        "payload",
        "concat_ws('/', event_type, dt, hh) AS source_file",
        f"try_cast({fields.text('payload', 'event_id')} AS BIGINT) AS source_row",
    )
    return raw.to_raw(landed, run_at)


def _first_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.project(_loaded(spark, sf_dir, FIRST_RUN), FIRST_RUN)


def _resent_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.project(_loaded(spark, sf_dir, SECOND_RUN, RESENT, 1), SECOND_RUN)


def _stored(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Curated rows written once, for merges that read them several times."""
    path = fresh_dir(spark, "batch")
    curate.accepted(rows).write.parquet(path)
    return spark.read.schema(S.CURATED).parquet(path)


def _merge_all(spark: SparkSession, path: str, *batches: tuple[int, DataFrame]) -> None:
    curate.create_target(spark, path)
    for batch_id, rows in batches:
        curate.merge(spark, rows, path, batch_id, fresh_dir(spark, "merge-stage"))


def _land(spark: SparkSession, sf_dir: str, partitions=land.PARTITIONS) -> str:
    path = fresh_dir(spark, "events")
    land.write(land.landable(_prepared(spark, sf_dir)), path, partitions)
    return path


def _delivered(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The folder of landed events by type and date, and the same rows with their code.

    Envelopes are decoded, enriched and prepared once for both; the raw side of a query picks its
    rows by the code.
    """
    stage, path = fresh_dir(spark, "landable"), fresh_dir(spark, "events")
    prepared = land.prepare(_enriched(spark, sf_dir), FIRST_RUN, keep=("k",))
    land.landable(prepared, keep=("k",)).write.parquet(stage)
    rows = spark.read.schema("payload variant, event_type string, dt date, hh string, k int").parquet(stage)
    land.write(rows.drop("k"), path, land.DAILY)
    return path, rows


def _texts(payload: str, *names: str) -> list[str]:
    return [f"{fields.text(payload, n)} AS {n}" for n in names]


# --- decode -----------------------------------------------------------------


@_query
def decode_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded envelopes with their payload fields."""
    return decode.decoded(_classified(spark, sf_dir)).selectExpr(
        "sequence_number",
        "partition_key",
        "approximate_arrival_timestamp AS arrival",
        *_texts("payload", "event_id", "event_type", "event_time", "user_id", "session_id"),
        *_texts("payload", "source", "product_name", "risk_flag"),
    )


@_query
def decode_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed envelopes with the class of the reason and what was received."""
    return decode.failures(_classified(spark, sf_dir)).selectExpr(
        "sequence_number", "raw", f"{decode.reason_class('reason')} AS reason"
    )


@_query
def partition_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key a producer would send each event under."""
    return decode.decoded(_classified(spark, sf_dir)).selectExpr(
        "sequence_number", *_texts("payload", "session_id"), f"{route.partition_key('payload')} AS key"
    )


# --- enrich -----------------------------------------------------------------


def _enriched_columns(enriched: DataFrame) -> DataFrame:
    return enriched.selectExpr(
        "sequence_number",
        *_texts("payload", "event_id", "user_id", "session_id"),
        "hit",
        "try_variant_get(user_segment, '$', 'string') AS user_segment",
        "try_variant_get(user_country, '$', 'string') AS user_country",
        "try_variant_get(user_lifetime_value, '$', 'double') AS user_ltv",
        "try_variant_get(ingestion_pipeline, '$', 'string') AS tag",
    )


@_query
def enrich_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left lookup of user attributes, hit and miss."""
    return _enriched_columns(_enriched(spark, sf_dir))


@_query
def enrich_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lookup as a shuffled join with every user spread over tasks."""
    records = decode.decoded(_classified(spark, sf_dir))
    return _enriched_columns(enrich.enrich(records, bindings.users(spark, sf_dir), salts=4))


@_query
def enrich_hit_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.hit_rate(_enriched(spark, sf_dir))


# --- route ------------------------------------------------------------------


@_query
def high_value_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        decode.decoded(_classified(spark, sf_dir))
        .where(route.is_high_value_order("payload", THRESHOLD))
        .selectExpr(
            "sequence_number",
            *_texts("payload", "event_id", "session_id"),
            f"{fields.number('payload', 'amount')} AS amount",
        )
    )


@_query
def fraud_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        decode.decoded(_classified(spark, sf_dir))
        .where(route.is_fraud_signal("payload"))
        .selectExpr("sequence_number", *_texts("payload", "event_id", "fraud_signal", "risk_flag"))
    )


def _json_texts(json: str, *names: str) -> list[str]:
    return [f"get_json_object({json}, '$.{n}') AS {n}" for n in names]


@_query
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert messages, the enriched event inside checked by field."""
    return route.alerts(_routed(spark, sf_dir)).selectExpr(
        "event_id",
        "event_type",
        "subject",
        *_json_texts("message", "user_segment", "user_country", "session_id"),
        "get_json_object(message, '$.ingestion_pipeline') AS tag",
    )


@_query
def route_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route.route_counts(route.route(decode.decoded(_classified(spark, sf_dir)), THRESHOLD))


# The delivery sink refuses the events of one code.
REFUSED = "k = 22"


@_query
def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = route.route(_classified(spark, sf_dir), THRESHOLD)
    return route.batch_metrics(classified, "is_alert", REFUSED)


@_query
def batch_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route.batch_failures(_classified(spark, sf_dir), REFUSED)


@_query
def ndjson_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delivery lines, read back by field."""
    return route.ndjson(_enriched(spark, sf_dir)).selectExpr(
        "sequence_number",
        *_json_texts("line", "event_id", "event_type", "session_id", "product_name"),
        *_json_texts("line", "user_segment"),
        "CAST(get_json_object(line, '$.user_lifetime_value') AS DOUBLE) AS user_ltv",
        "get_json_object(line, '$.ingestion_pipeline') AS tag",
        "instr(line, '\\n') > 0 AS broken_line",
    )


# --- land and ingest --------------------------------------------------------


_LANDED_FIELDS = (
    "event_id", "session_id", "event_time", "user_id", "source", "order_id", "product_id", "page",
    "email", "user_segment", "user_country", "ingestion_pipeline",
)


@_query
def landing_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written by type, arrival date and hour, then read back."""
    return landing.scan(spark, _land(spark, sf_dir)).selectExpr(
        *_texts("payload", *_LANDED_FIELDS), "event_type", "dt", "hh"
    )


@_query
def landing_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that cannot be partitioned, written to the error output."""
    path = fresh_dir(spark, "errors")
    land.write(land.unlandable(_prepared(spark, sf_dir)), path, land.ERROR_PARTITIONS)
    return spark.read.schema(S.LANDING_ERRORS).parquet(path).selectExpr(
        "sequence_number", *_json_texts("body", "session_id"), "error_type", "dt", "hh"
    )


@_query
def external_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the hourly, the daily and the stream's layout, their columns parsed from the path.

    Types of one code hold a space, an equals sign and a colon.
    """
    prepared = _prepared(spark, sf_dir)
    odd = f"try_cast({fields.text('payload', 'product_id')} AS STRING) = 'P-33'"
    landed = land.landable(prepared).withColumn(
        "event_type", F.expr(f"IF({odd}, event_type || ' a=b:c', event_type)")
    )
    hourly, daily, streamed = (fresh_dir(spark, n) for n in ("hourly", "daily", "streamed"))
    land.write(landed.where("hh < '12'"), hourly, land.PARTITIONS)
    land.write(landed.where("hh >= '12' AND dt < '2024-01-16'"), daily, land.DAILY)
    rest = landed.where("hh >= '12' AND dt >= '2024-01-16'")
    jobs._land_batch(rest, streamed, land.PARTITIONS, 7)
    found = [
        landing.scan_paths(spark, path).withColumn("layout", F.lit(layout))
        for layout, path in (("hourly", hourly), ("daily", daily), ("stream", streamed))
    ]
    return found[0].unionByName(found[1]).unionByName(found[2]).selectExpr(
        *_texts("payload", "session_id"), "event_type", "dt", "hh", "layout",
        "contains(source_file, '/event_type=') AND NOT contains(source_file, '%25') AS has_lineage",
    )


@_query
def raw_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files streamed into the raw table, each once; a second run adds none."""
    landed = _land(spark, sf_dir, land.DAILY)
    table, state = fresh_dir(spark, "raw"), fresh_dir(spark, "state")
    for _ in range(2):
        jobs.ingest_stream(
            spark, landed, table, state, files_per_trigger=10_000, clock=lambda: FIRST_RUN
        ).awaitTermination()
    return raw.raw_id(jobs.read_raw(spark, table)).selectExpr(
        *_texts("payload", *(f for f in _LANDED_FIELDS if f not in ("event_time", "user_id"))),
        "event_type",
        "event_time",
        "user_id",
        "ingested_at",
        "pipeline",
        "raw_id = source_file || '#' || source_row AND source_row >= 1 AS has_lineage",
    )


@_query
def raw_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows laid out by type and day; events without a time have no day."""
    path = fresh_dir(spark, "raw-clustered")
    raw.write_clustered(_loaded(spark, sf_dir, FIRST_RUN), path)
    return raw.read_clustered(spark, path).selectExpr(
        *_texts("payload", "event_id", "session_id"), "event_type", "event_date", "event_time",
        "user_id", "ingested_at", "pipeline",
    )


# Files of these types and days: one that is no Parquet, and those with bad rows.
BROKEN_FEED = "event_type = 'order' AND dt = '2024-01-10'"


@_query
def file_error_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of the loader over real files, one per type and day.

    Weekend files lost the payload of codes below 25, more than one row in ten; one file
    is text where Parquet is due. Both are left out, the latter listed as unreadable.
    """
    landed = land.landable(_prepared(spark, sf_dir)).withColumn(
        "dt", F.col("dt").cast("string")
    )
    lost = f"weekday(CAST(dt AS DATE)) >= 5 AND {fields.text('payload', 'page')} < '/p/45'"
    rows = landed.withColumn("payload", F.expr(f"IF(coalesce({lost}, false), NULL, payload)")).drop("hh")
    files, table = fresh_dir(spark, "events"), fresh_dir(spark, "raw")
    one_each = rows.where(f"NOT ({BROKEN_FEED})").repartition("event_type", "dt")
    one_each.write.partitionBy("event_type", "dt").parquet(files)
    broken = rows.where(BROKEN_FEED).selectExpr("to_json(payload) AS value", "event_type", "dt")
    broken.repartition(1).write.mode("append").partitionBy("event_type", "dt").text(files)
    jobs.ingest_stream(
        spark, files, table, fresh_dir(spark, "state"), files_per_trigger=10_000, clock=lambda: FIRST_RUN
    ).awaitTermination()
    loaded = jobs.read_raw(spark, table).groupBy("source_file").agg(F.count("*").alias("loaded"))
    return (
        jobs.read_ledger(spark, table)
        .join(loaded, "source_file", "left")
        .selectExpr(*land.path_columns("source_file"), "rows", "bad_rows", "outcome",
                    "coalesce(loaded, 0L) AS loaded")
        .drop("hh")
    )


# --- curate -----------------------------------------------------------------


def _plain(curated: DataFrame) -> DataFrame:
    """Curated rows without run-dependent lineage."""
    return curated.drop("source_file", "source_row", "batch_id")


@_query
def curated_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All typed columns of the admitted rows."""
    return _plain(curate.accepted(_first_curated(spark, sf_dir)))


@_query
def curated_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows set aside, with the rule they break."""
    return curate.rejects(_first_curated(spark, sf_dir)).select(
        "event_id", "session_id", "reject_rule"
    )


@_query
def dedup_first_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both deliveries as one batch: the first copy of an id is kept."""
    both = curate.accepted(_resent_curated(spark, sf_dir)).unionByName(
        curate.accepted(_first_curated(spark, sf_dir))
    )
    return curate.first_write(both).select("event_id", "event_type", "amount", "ingested_at")


@_query
def merge_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch merged, merged again, merged as another batch, then the re-sent events."""
    path = fresh_dir(spark, "curated")
    first = _stored(spark, _first_curated(spark, sf_dir))
    resent = _stored(spark, _resent_curated(spark, sf_dir))
    _merge_all(spark, path, (1, first), (1, first), (2, first), (3, resent))
    return curate.read_target(spark, path).select("event_id", "amount", "ingested_at", "batch_id")


@_query
def replay_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both deliveries replayed as one batch of any size onto a table that has one."""
    path = fresh_dir(spark, "curated")
    resent = _stored(spark, _resent_curated(spark, sf_dir))
    _merge_all(spark, path, (1, resent))
    both = resent.unionByName(_stored(spark, _first_curated(spark, sf_dir)))
    fresh = curate.insert_large(
        both,
        curate.read_target(spark, path),
        "event_id",
        curate.FIRST_WRITE,
        fresh_dir(spark, "replay-stage"),
    )
    return fresh.select("event_id", "event_type", "amount", "ingested_at")


def _stream_twice(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Two deliveries through the raw table into the curated one."""
    table, curated, state = (fresh_dir(spark, n) for n in ("raw", "curated", "state"))
    deliveries = (
        _loaded(spark, sf_dir, FIRST_RUN),
        _loaded(spark, sf_dir, SECOND_RUN, RESENT, 1),
    )
    for batch_id, (rows, run_at) in enumerate(zip(deliveries, (FIRST_RUN, SECOND_RUN)), 1):
        rows.write.parquet(f"{table}/batch_id={batch_id}")
        jobs.merge_stream(
            spark, table, curated, state, clock=lambda at=run_at: at
        ).awaitTermination()
    return table, f"{curated}/events"


@_query
def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated table after two raw deliveries were merged as a stream."""
    _, curated = _stream_twice(spark, sf_dir)
    return _plain(curate.read_target(spark, curated))


@_query
def replay_equals_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per type: rows merged step by step, rows of one replay, and rows that differ."""
    table, curated = _stream_twice(spark, sf_dir)
    replayed = curate.first_write(
        curate.accepted(curate.project(jobs.read_raw(spark, table), SECOND_RUN))
    )
    compared = [c for c in S.columns(S.CURATED) if c not in ("event_id", "curated_at")]
    left = curate.read_target(spark, curated).select(
        "event_id", "event_type", F.struct(*compared).alias("left")
    )
    right = replayed.select(
        "event_id", "event_type", F.struct(*compared).alias("right")
    )
    return (
        left.join(right, ["event_id", "event_type"], "full")
        .groupBy("event_type")
        .agg(
            F.count("left").alias("incremental"),
            F.count("right").alias("replayed"),
            F.count_if(~F.col("left").eqNullSafe(F.col("right"))).alias("differing"),
        )
    )


@_query
def compact_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All batches rewritten by date and type; no row is lost or doubled."""
    path = fresh_dir(spark, "curated")
    first = _stored(spark, _first_curated(spark, sf_dir))
    _merge_all(spark, path, (1, first), (2, _stored(spark, _resent_curated(spark, sf_dir))))
    curate.compact(spark, path)
    return _plain(curate.read_target(spark, path))


@_query
def merge_after_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged, compacted, merged again, sent again, compacted again: rows added by each step."""
    path = fresh_dir(spark, "curated")
    first = _stored(spark, _first_curated(spark, sf_dir))
    resent = _stored(spark, _resent_curated(spark, sf_dir))
    curate.create_target(spark, path)

    def add(batch_id: int, rows: DataFrame) -> int:
        return curate.merge(spark, rows, path, batch_id, fresh_dir(spark, "merge-stage"))

    steps = [add(1, resent)]
    curate.compact(spark, path)
    steps += [add(2, first), add(1, resent)]
    curate.compact(spark, path)
    steps += [add(3, first), add(4, resent)]
    added = [f"{n}L AS added_{k}" for k, n in enumerate(steps)]
    return curate.read_target(spark, path).groupBy("event_type").agg(
        F.count("*").alias("events"), F.countDistinct("event_id").alias("ids")
    ).selectExpr("*", *added)


# --- late events ------------------------------------------------------------


def _repaired(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    (landed, rows), path = _delivered(spark, sf_dir), fresh_dir(spark, "curated")
    _merge_all(spark, path, (1, curate.accepted(curate.project(_raw(rows.where(ON_TIME), FIRST_RUN), FIRST_RUN))))
    return late.late_repair(spark, landed, path, REPAIR_DATE, REPAIR_RUN), path


@_query
def late_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows one repair adds: landed on the date, withheld from the raw table."""
    _, path = _repaired(spark, sf_dir)
    return _plain(
        curate.read_target(spark, path).where("batch_id < 0")
    ).select("event_id", "event_type", "event_date", "amount", "ingested_at", "curated_at")


@_query
def late_repair_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary, _ = _repaired(spark, sf_dir)
    return summary


@_query
def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types and dates where the raw table lacks landed events."""
    path, rows = _delivered(spark, sf_dir)
    landed = landing.scan(spark, path).select("event_type", "dt")
    loaded = _raw(rows.where(ON_TIME), FIRST_RUN).selectExpr(
        "event_type", "to_date(split_part(source_file, '/', 2)) AS dt"
    )
    return audit.reconcile(landed, loaded)


@_query
def digest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types and dates with as many loaded as landed events but other ids.

    The raw side is the sum of two batches' digests; late events came with other ids.
    """
    path, delivered = _delivered(spark, sf_dir)
    landed = landing.scan(spark, path).select(
        "event_type", "dt", F.expr(fields.text("payload", "event_id")).alias("event_id")
    )

    def kept(rows: str, event_id: str) -> DataFrame:
        loaded = _raw(delivered.where(rows), FIRST_RUN).selectExpr(
            "event_type", "to_date(split_part(source_file, '/', 2)) AS dt", f"{event_id} AS event_id"
        )
        return audit.digests(loaded)

    plain = fields.text("payload", "event_id")
    batches = kept(ON_TIME, plain), kept(f"NOT ({ON_TIME})", f"'other-' || {plain}")
    return audit.differing(audit.digests(landed), audit.merge_digests(*batches))


# --- dead letters -----------------------------------------------------------


@_query
def retry_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts of undecodable records, from the reports of a stream that met them again.

    The source sends the records of codes 4 to 8 a second time, as a batch of its own;
    one retry is allowed.
    """
    source, root, state = (fresh_dir(spark, n) for n in ("envelopes", "processed", "state"))
    for codes in ("true", "k BETWEEN 4 AND 8"):
        sent = bindings.envelopes(spark, sf_dir, codes).select(*S.columns(S.ENVELOPE))
        sent.write.mode("append").parquet(source)
        jobs.process_stream(
            spark, source, root, state, partitions=land.DAILY, clock=lambda: FIRST_RUN
        ).awaitTermination()
    attempts = spark.read.schema("sequence_number string, reason string").parquet(f"{root}/reports")
    return deadletter.retry_split(attempts, max_retries=1)


def _letter_columns() -> list[str]:
    body_k = "try_variant_get(body, '$.k', 'int')"
    return [
        "dlq_record_id",
        "received_at",
        "source_message_id",
        "approximate_receive_count",
        "sent_timestamp",
        "event_source_arn",
        f"CAST({body_k} AS STRING) AS body_k",
        f"CASE WHEN {body_k} IS NULL THEN try_variant_get(body, '$', 'string') END AS body_text",
    ]


@_query
def dlq_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = bindings.dead_letters(spark, sf_dir)
    return deadletter.envelope(letters, REPAIR_RUN).selectExpr(*_letter_columns())


@_query
def dlq_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes archived as JSON below the run's date and hour, then read back."""
    root = fresh_dir(spark, "dead")
    counts = deadletter.archive(bindings.dead_letters(spark, sf_dir), root, REPAIR_RUN)
    stored = spark.read.schema(S.DEAD_LETTER_ARCHIVE).json(deadletter.archive_path(root))
    return stored.selectExpr(
        *_letter_columns(), "dt", "hh", f"CAST({counts['archived']} AS BIGINT) AS archived"
    )


# --- audits and order -------------------------------------------------------


@_query
def order_amount_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = curate.accepted(_first_curated(spark, sf_dir))
    return audit.order_amounts(accepted, THRESHOLD)


@_query
def contract_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.contract(decode.decoded(_classified(spark, sf_dir)))


@_query
def per_key_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The position of each record within its partition key, by arrival."""
    records = decode.decoded(_classified(spark, sf_dir)).selectExpr(
        "partition_key",
        "sequence_number",
        "approximate_arrival_timestamp AS arrival",
        *_texts("payload", "session_id"),
    )
    order = ["arrival", "sequence_number", "session_id"]
    stage = fresh_dir(spark, "ordered")
    return ordering.positions(records, "partition_key", order, stage).select(
        "partition_key", "session_id", "position"
    )


# --- streams ----------------------------------------------------------------


# Envelopes of a file. A batch of the streams takes four files and has its fixed costs.
FILE_ROWS = 1_000_000


def _staged_envelopes(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_dir(spark, "envelopes")
    sent = bindings.envelopes(spark, sf_dir, task_rows=FILE_ROWS)
    sent.select(*S.columns(S.ENVELOPE)).write.parquet(path)
    return path


@_query
def stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelope files decoded as a stream in several micro-batches."""
    source, out = _staged_envelopes(spark, sf_dir), fresh_dir(spark, "decoded")
    jobs.decode_stream(
        spark, source, out, fresh_dir(spark, "state"), files_per_trigger=4
    ).awaitTermination()
    return spark.read.parquet(out).selectExpr(
        "sequence_number",
        *_texts("payload", "event_id", "session_id"),
        f"{decode.reason_class('reason')} AS reason",
    )


def _processed(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the whole processor, run as a stream in several micro-batches."""
    source, root = _staged_envelopes(spark, sf_dir), fresh_dir(spark, "processed")
    jobs.process_stream(
        spark,
        source,
        root,
        fresh_dir(spark, "state"),
        users=lambda session: bindings.users(session, sf_dir),
        user_rows=lambda session: bindings.user_rows(session, sf_dir),
        threshold=THRESHOLD,
        files_per_trigger=4,
        partitions=land.DAILY,
        clock=lambda: FIRST_RUN,
    ).awaitTermination()
    return root


@_query
def stream_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole processor as a stream: totals of every table it writes."""
    root = _processed(spark, sf_dir)
    metrics = spark.read.parquet(f"{root}/metrics").agg(
        *(F.sum(c).alias(c) for c in ("processed", "delivered", "alerts", "failed", "firehose_failed"))
    )

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count("*").alias(name))

    events = spark.read.schema(S.LANDING).parquet(f"{root}/events")
    errors = spark.read.schema(S.LANDING_ERRORS).parquet(f"{root}/errors")
    messages = spark.read.schema(S.ALERTS).parquet(f"{root}/alerts")
    reports = spark.read.parquet(f"{root}/reports")
    counted = [
        rows(events, "landed"),
        rows(errors, "unlandable"),
        rows(messages, "alert_rows"),
        rows(reports, "failure_rows"),
    ]
    # One row each, so that a constant key joins them.
    result = metrics.withColumn("one", F.lit(1))
    for part in counted:
        result = result.join(part.withColumn("one", F.lit(1)), "one")
    return result.drop("one")


@_query
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alerts a stream stores, one for each alerting record."""
    messages = spark.read.schema(S.ALERTS).parquet(f"{_processed(spark, sf_dir)}/alerts")
    return messages.selectExpr(
        "IF(startswith(alert_key, 'seq-'), alert_key, NULL) AS sequence_number",
        "char_length(alert_key) AS key_length",
        "event_id",
        "event_type",
        "subject",
        *_json_texts("message", "user_segment", "session_id", "product_name"),
    )


@_query
def stream_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failures a stream stores, with all that was received."""
    failed = spark.read.schema(S.FAILURES).parquet(f"{_processed(spark, sf_dir)}/failures")
    return failed.selectExpr(
        "sequence_number",
        "partition_key",
        "approximate_arrival_timestamp AS arrival",
        "raw",
        f"{decode.reason_class('reason')} AS reason",
        "data",
    )


@_query
def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failures of a stream, archived by a second one."""
    root, state = _processed(spark, sf_dir), fresh_dir(spark, "state")
    dead = fresh_dir(spark, "dead")
    for _ in range(2):
        jobs.archive_stream(
            spark, f"{root}/failures", dead, state, clock=lambda: REPAIR_RUN
        ).awaitTermination()
    stored = spark.read.schema(S.DEAD_LETTER_ARCHIVE).json(deadletter.archive_path(dead))
    return stored.selectExpr(
        "IF(startswith(source_message_id, 'seq-'), source_message_id, NULL) AS sequence_number",
        "coalesce(try_variant_get(body, '$', 'string'), to_json(body)) AS body",
        "sent_timestamp",
        "received_at",
        "dt",
        "hh",
    )


@_query
def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes to curated rows through every job: process, ingest, merge, repair.

    Two days' folders of one type reach the raw table only after the repair of one of them.
    """
    root = _processed(spark, sf_dir)
    raw_table, curated = fresh_dir(spark, "raw"), fresh_dir(spark, "curated")
    jobs.ingest_stream(
        spark, f"{root}/events", raw_table, fresh_dir(spark, "state"), clock=lambda: FIRST_RUN
    ).awaitTermination()
    # The raw table lost the rows of one landing date; a repair brings them back.
    kept = fresh_dir(spark, "kept")
    day = f"contains(source_file, '/dt={REPAIR_DATE}/')"
    jobs.read_raw(spark, raw_table).where(f"NOT {day}").drop("batch_id").write.parquet(f"{kept}/batch_id=1")
    jobs.merge_stream(spark, kept, curated, fresh_dir(spark, "state"), clock=lambda: SECOND_RUN).awaitTermination()
    late.late_repair(spark, f"{root}/events", f"{curated}/events", REPAIR_DATE, REPAIR_RUN)
    return _plain(curate.read_target(spark, f"{curated}/events"))


@_query
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated table after all jobs ran twice over one place, each time with new checkpoints.

    Each run gets the envelopes of other codes; the second one sees the files of both.
    """
    root, raw_table, curated = (fresh_dir(spark, n) for n in ("processed", "raw", "curated"))
    for half in (0, 1):
        source, state = fresh_dir(spark, "envelopes"), fresh_dir(spark, "state")
        bindings.envelopes(spark, sf_dir, f"k % 2 = {half}").write.parquet(source)
        jobs.process_stream(
            spark, source, root, f"{state}/process", partitions=land.DAILY, clock=lambda: FIRST_RUN,
            users=lambda session: bindings.users(session, sf_dir),
            user_rows=lambda session: bindings.user_rows(session, sf_dir),
        ).awaitTermination()
        jobs.ingest_stream(
            spark, f"{root}/events", raw_table, f"{state}/ingest", clock=lambda: FIRST_RUN
        ).awaitTermination()
        jobs.merge_stream(
            spark, raw_table, curated, f"{state}/merge", clock=lambda: FIRST_RUN
        ).awaitTermination()
    return _plain(curate.read_target(spark, f"{curated}/events"))


@_query
def repair_after_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two repairs under one batch id with compactions between: rows reported and rows there."""
    (landed, rows), path = _delivered(spark, sf_dir), fresh_dir(spark, "curated")
    _merge_all(spark, path, (1, curate.accepted(curate.project(_raw(rows.where(ON_TIME), FIRST_RUN), FIRST_RUN))))
    added = []
    for day in (REPAIR_DATE, NEXT_DATE):
        summary = late.late_repair(spark, landed, path, day, REPAIR_RUN, batch_id=-9)
        added.append(summary.first()["rows_merged"])
        curate.compact(spark, path)
    return curate.read_target(spark, path).agg(
        F.count("*").alias("events"), F.countDistinct("event_id").alias("ids")
    ).selectExpr("*", *(f"{n}L AS repaired_{k}" for k, n in enumerate(added, 1)))


@_query
def levelled_compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine batches, three parts of a level compacted at a time: parts left, by level."""
    path = fresh_dir(spark, "curated")
    rows = _stored(spark, _first_curated(spark, sf_dir))
    curate.create_target(spark, path)
    for batch_id in range(9):
        part = rows.where(f"pmod(xxhash64(event_id), 9) = {batch_id}")
        curate.merge(spark, part, path, batch_id + 1, fresh_dir(spark, "merge-stage"))
        curate.compact_levels(spark, path, fan=3)
    parts = versions.latest(spark, path).parts
    return curate.read_target(spark, path).groupBy("event_type").agg(
        F.count("*").alias("events"), F.countDistinct("event_id").alias("ids"),
        F.countDistinct("batch_id").alias("batches"),
    ).selectExpr("*", f"{len(parts)}L AS parts", f"{max(p.level for p in parts)}L AS level")


@_query
def key_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per type: compacted rows, and those whose index row names the file that holds them."""
    path = fresh_dir(spark, "curated")
    for_merge = [(k, _stored(spark, rows)) for k, rows in enumerate(
        (_first_curated(spark, sf_dir), _resent_curated(spark, sf_dir)), 1
    )]
    _merge_all(spark, path, *for_merge)
    curate.compact(spark, path)
    (part,) = versions.latest(spark, path).parts
    rows = spark.read.schema(f"{S.CURATED}, bucket int").parquet(part.path)
    held = rows.select(
        "event_type", F.xxhash64("event_id").alias("hash"), "bucket", F.col("_metadata.file_name").alias("file")
    )
    index = keyindex.read(spark, keyindex.path(path, part.path))
    return (
        held.join(index.withColumn("named", F.lit(1)), ["hash", "bucket", "file"], "left")
        .groupBy("event_type")
        .agg(F.count("*").alias("events"), F.count("named").alias("indexed"))
    )


@_query
def bounded_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record that fails is sent again three times, then archived with its receive count."""
    source, root, dead = _staged_envelopes(spark, sf_dir), fresh_dir(spark, "processed"), fresh_dir(spark, "dead")
    again, first, later, state = (fresh_dir(spark, n) for n in ("again", "state", "state", "state"))

    def process(path: str, checkpoint: str) -> None:
        jobs.process_stream(
            spark, path, root, checkpoint, partitions=land.DAILY, clock=lambda: FIRST_RUN
        ).awaitTermination()

    process(source, first)
    for sent in range(S.MAX_RETRIES + 1):
        if sent:
            process(f"{again}/*", later)
        jobs.retry_stream(
            spark, f"{root}/failures", again, dead, state, backoff_s=0, clock=lambda: REPAIR_RUN
        ).awaitTermination()
    stored = spark.read.schema(S.DEAD_LETTER_ARCHIVE).json(deadletter.archive_path(dead))
    return stored.selectExpr(
        "IF(startswith(source_message_id, 'seq-'), source_message_id, NULL) AS sequence_number",
        "coalesce(try_variant_get(body, '$', 'string'), to_json(body)) AS body",
        "sent_timestamp",
        "approximate_receive_count",
    )
