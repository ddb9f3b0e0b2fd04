"""On-demand repair of late events, per landing date."""

from __future__ import annotations

from datetime import datetime, timedelta
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headrace import schemas as S
from headrace.functions import fields
from headrace.operators import curate
from headrace.session import fresh_dir
from headrace.sources import landing


def candidates(
    spark: SparkSession,
    landing_path: str,
    landing_date: str,
    run_at: datetime,
    event_type: str | None = None,
    lookback_h: int = S.DEFAULT_LOOKBACK_HOURS,
) -> DataFrame:
    """Typed rows of one landing date; only that date's folders are read.

    ``lookback_h`` sets the ingestion time stamped on the rows and filters nothing.
    """
    landed = landing.scan(spark, landing_path, landing_date, event_type)
    cutoff = run_at - timedelta(hours=lookback_h)
    rows = landed.selectExpr(
        "payload", "source_file", "source_row", f"{fields.ntz(cutoff)} AS ingested_at"
    )
    return curate.project(rows, run_at)


def repair_id(run_at: datetime, landing_date, event_type: str | None) -> int:
    """A negative batch id, the same for the same repair and no other."""
    name = f"{run_at.isoformat()}|{landing_date}|{event_type or ''}"
    return -1 - int.from_bytes(sha256(name.encode()).digest()[:7], "big")


def late_repair(
    spark: SparkSession,
    landing_path: str,
    curated_path: str,
    landing_date: str,
    run_at: datetime,
    event_type: str | None = None,
    lookback_h: int = S.DEFAULT_LOOKBACK_HOURS,
    batch_id: int | None = None,
    stage_path: str | None = None,
) -> DataFrame:
    """Merge what landed on a date but is not curated; returns the one-row summary.

    Lateness is unlimited. The repair has a negative batch id, by default a hash of
    its time, date and type: running it again replaces its own rows and no others. The
    landed date is read once, into ``stage_path``, by default a folder below the shared one.
    """
    if batch_id is None:
        batch_id = repair_id(run_at, landing_date, event_type)
    if batch_id >= 0:
        raise ValueError("a repair needs a negative batch_id")
    rows = candidates(spark, landing_path, landing_date, run_at, event_type, lookback_h)
    stage = stage_path or fresh_dir(spark, "repair-stage")
    merged = curate.merge(spark, curate.accepted(rows), curated_path, batch_id, stage)
    return spark.range(1).select(
        F.lit(str(landing_date)).cast("date").alias("event_date"),
        F.lit(event_type).cast("string").alias("event_type"),
        F.lit(lookback_h).cast("bigint").alias("lookback_h"),
        F.lit(merged).cast("bigint").alias("rows_merged"),
        F.expr(fields.ntz(run_at)).alias("run_at"),
    )
