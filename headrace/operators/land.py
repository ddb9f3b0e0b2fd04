"""Landing: partition columns, the error split, layout, and path columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from headrace import session
from headrace.functions import fields
from headrace.functions.once import with_once
from headrace.operators.enrich import with_event_json

PARTITIONS = ("event_type", "dt", "hh")
DAILY = ("event_type", "dt")
ERROR_PARTITIONS = ("error_type", "dt", "hh")
NO_PARTITION_KEY = "missing-partition-key"
SAME_KEY = "keys-differ-by-case"


def prepare(enriched: DataFrame, run_at, transform=None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Landing columns for every delivered record, errors marked in ``error_type``.

    The partition type comes from the payload, ``dt`` and ``hh`` from the arrival
    time, or from ``run_at`` where no arrival time was sent. Top-level keys are
    lower-cased; keys that differ only by case cannot be kept apart and are an
    error. ``transform`` is an optional DataFrame step applied before delivery; the
    columns or expressions of ``keep`` follow unchanged.
    """
    records = enriched if transform is None else enriched.transform(transform)
    # A type that is an object or a list is none.
    kind = (
        "CASE WHEN substr(to_json(_kind), 1, 1) NOT IN ('{', '[') "
        f"THEN nullif({fields.value_text('_kind')}, '') END"
    )
    arrival = (
        f"coalesce({fields.epoch_to_ntz('approximate_arrival_timestamp')}, {fields.ntz(run_at)})"
    )
    bodies = with_event_json(
        records.selectExpr("*", f"{fields.field('payload', 'event_type')} AS _kind"), "body"
    ).selectExpr(
        "sequence_number",
        "body",
        f"{kind} AS event_type",
        f"{arrival} AS _arrival",
        *keep,
    )
    kept = bodies.columns[4:]
    keyed = bodies.selectExpr(
        "*", "json_object_keys(body) AS _keys"
    ).selectExpr("*", "array_join(_keys, '\\u0001') AS _names")
    error = f"""CASE
        WHEN event_type IS NULL THEN '{NO_PARTITION_KEY}'
        WHEN _mixed AND size(array_distinct(split(lower(_names), '\\u0001'))) < size(_keys)
            THEN '{SAME_KEY}' END"""
    return with_once(
        keyed.selectExpr("*", "_names <> lower(_names) AS _mixed"), {"error_type": error}
    ).selectExpr(
        "sequence_number",
        "body",
        "_mixed",
        "error_type",
        "event_type",
        "to_date(_arrival) AS dt",
        "date_format(_arrival, 'HH') AS hh",
        *kept,
    )


def landable(prepared: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The rows that can be partitioned, with the event as a Variant.

    The columns of ``keep``, as ``prepare`` kept them, follow unchanged.
    """
    lowered = (
        "to_variant_object(transform_keys("
        "try_variant_get(parse_json(body), '$', 'map<string,variant>'), (key, _) -> lower(key)))"
    )
    # The test names the generated column, which keeps the lowering, an error on
    # doubled keys, above the split.
    payload = (
        f"CASE WHEN _mixed AND error_type IS NULL THEN {lowered} ELSE parse_json(body) END"
    )
    return prepared.where("error_type IS NULL").selectExpr(f"{payload} AS payload", *PARTITIONS, *keep)


def unlandable(prepared: DataFrame) -> DataFrame:
    """The complement: rows for the error output."""
    return prepared.where("error_type IS NOT NULL").select(
        "sequence_number", "body", *ERROR_PARTITIONS
    )


def layout(df: DataFrame, partitions: tuple[str, ...], salts: int = 1) -> DataFrame:
    """Bring each output partition together before a partitioned write.

    The rebalance hint lets adaptive execution split a partition that outgrows the
    advisory size, so one hot type and hour is written by many tasks, and merge
    small ones. Where adaptive execution is off, ``salts`` splits every partition
    by a hash of its rows.
    """
    if salts <= 1:
        return df.hint("rebalance", *partitions)
    rows = "xxhash64(sequence_number, body)" if "body" in df.columns else "xxhash64(to_json(payload))"
    salted = df.selectExpr("*", f"pmod({rows}, {salts}) AS _salt")
    return salted.repartition(*partitions, "_salt").drop("_salt")


def write(
    df: DataFrame,
    path: str,
    partitions: tuple[str, ...],
    mode: str = "append",
    salts: int = 1,
) -> None:
    """Write Snappy Parquet below ``path``, one folder level per partition column.

    A layout without hours leaves the hour out.
    """
    with session.settings(df.sparkSession, session.ALL_CORES):
        (
            layout(without_hour(df, partitions), partitions, salts)
            .write.mode(mode)
            .option("compression", "snappy")
            .partitionBy(*partitions)
            .parquet(path)
        )


def write_lines(lines: DataFrame, path: str) -> None:
    """Deliver one JSON object per line as compressed text."""
    lines.select("line").write.mode("append").option("compression", "gzip").text(path)


def without_hour(df: DataFrame, partitions: tuple[str, ...]) -> DataFrame:
    return df if "hh" in partitions else df.drop("hh")


def decoded_path(path: str) -> str:
    """A file URI as the store names the file: percent signs and what follows are resolved."""
    return f"url_decode(replace({path}, '+', '%2B'))"


def path_columns(path: str) -> list[str]:
    """Partition values read from a decoded path, by the names of its levels.

    ``dt=`` and ``hh=`` are found wherever they stand, so further levels such as
    ``batch_id=`` do no harm; a missing hour is NULL. The type is the value of
    ``event_type=``, in which special characters are escaped, or else the plain folder
    in front of ``dt=``. For folders written elsewhere; these columns do not prune a scan.
    """
    named = f"nullif(regexp_extract({path}, '/event_type=([^/]*)/', 1), '')"
    plain = f"nullif(regexp_extract({path}, '/([^/=]+)/dt=[^/]+/', 1), '')"
    return [
        f"coalesce({decoded_path(named)}, {plain}) AS event_type",
        f"to_date(nullif(regexp_extract({path}, '/dt=([^/]+)/', 1), ''), 'yyyy-MM-dd') AS dt",
        f"try_cast(nullif(regexp_extract({path}, '/hh=([^/]+)/', 1), '') AS INT) AS hh",
    ]
