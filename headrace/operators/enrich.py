"""Left lookup of user attributes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace import schemas as S
from headrace.functions import fields
from headrace.operators.skew import BROADCAST_ROWS, salted_join

_ATTRIBUTES = {
    "user_segment": "segment",
    "user_country": "country",
    "user_lifetime_value": "lifetime_value",
}
_TAG = "ingestion_pipeline"
_SIDE = ("hit", *_ATTRIBUTES, _TAG)


def enrich(
    records: DataFrame, users: DataFrame | None, salts: int = 1, user_rows: int | None = None
) -> DataFrame:
    """Add the user attributes and the processing tag as Variant side columns.

    On a hit the attributes replace the event's own, NULL included; on a miss or
    without a dimension the event's own stay. An absent field stays SQL NULL.

    ``user_rows`` is the measured size of the dimension; up to ``BROADCAST_ROWS``
    it is broadcast and the records are not shuffled. Without it Spark decides by
    ``spark.sql.autoBroadcastJoinThreshold``. In a shuffled join adaptive execution
    splits hot users; ``salts`` above one spreads every user over that many tasks
    where adaptive execution is off. Repeated user ids count once, see ``one_per_user``.
    """
    own = records.columns
    read = fields.members("payload", values=("user_id", *_ATTRIBUTES, _TAG))
    records = records.selectExpr("*", f"{read} AS _read")
    tag = f"coalesce(_read.{_TAG}, CAST('{S.INGESTION_PIPELINE}' AS VARIANT)) AS {_TAG}"
    if users is None:
        kept = (f"_read.{name} AS {name}" for name in _ATTRIBUTES)
        return records.selectExpr(*own, "false AS hit", *kept, tag)

    dimension = one_per_user(users).selectExpr(
        "user_id AS _user", *(f"{c} AS _{c}" for c in _ATTRIBUTES.values()), "true AS _hit"
    )
    user = fields.truthy_value("_read.user_id")
    if user_rows is not None and user_rows <= BROADCAST_ROWS:
        # A falsy user id is never looked up: its key is NULL and matches nothing.
        keyed = records.selectExpr("*", f"{user} AS _user")
        joined = keyed.join(F.broadcast(dimension), "_user", "left")
    else:
        # Shuffled, the records without an id would meet in one task; a hash of the record
        # spreads them, and the second key keeps them from matching a user of that name.
        record = "hex(xxhash64(sequence_number, approximate_arrival_timestamp))"
        keyed = records.selectExpr("*", f"{user} AS _id").selectExpr(
            "* EXCEPT (_id)", f"struct(_id IS NOT NULL AS known, coalesce(_id, {record}) AS id) AS _user"
        )
        dimension = dimension.withColumn("_user", F.struct(F.lit(True).alias("known"), F.col("_user").alias("id")))
        if salts > 1:
            spread = ["sequence_number", "approximate_arrival_timestamp", "_user"]
            joined = salted_join(keyed, dimension, "_user", "left", salts, spread)
        else:
            joined = keyed.join(dimension, "_user", "left")

    merged = (
        f"""CASE WHEN _hit THEN coalesce(CAST(_{source} AS VARIANT), parse_json('null'))
            ELSE _read.{name} END AS {name}"""
        for name, source in _ATTRIBUTES.items()
    )
    return joined.selectExpr(*own, "coalesce(_hit, false) AS hit", *merged, tag)


def with_event_json(enriched: DataFrame, name: str) -> DataFrame:
    """Add the whole enriched event as one compact JSON object.

    Built only where the event leaves the job; filters and joins use the payload
    and the side columns. New fields are appended to the payload's text, and only
    an object that now holds a key twice is parsed again to keep the later one.
    """
    added = [
        f"""CASE WHEN hit THEN '"{attribute}":' || to_json({attribute}) END"""
        for attribute in _ATTRIBUTES
    ]
    added.append(
        f"""CASE WHEN _read.{_TAG} IS NULL
            THEN '"{_TAG}":' || to_json({_TAG}) END"""
    )
    inner = "nullif(substr(_text, 2, char_length(_text) - 2), '')"
    own = " OR ".join(f"_read.{attribute} IS NOT NULL" for attribute in _ATTRIBUTES)
    read = fields.members("payload", values=(*_ATTRIBUTES, _TAG))
    return (
        enriched.selectExpr("*", "to_json(payload) AS _text", f"{read} AS _read")
        .selectExpr("*", f"'{{' || concat_ws(',', {inner}, {', '.join(added)}) || '}}' AS _joined")
        .selectExpr(
            *enriched.columns,
            f"CASE WHEN hit AND ({own}) THEN to_json(parse_json(_joined)) ELSE _joined END AS {name}",
        )
    )


def hit_rate(enriched: DataFrame) -> DataFrame:
    """Lookups that hit, by event type."""
    return (
        enriched.selectExpr(f"{fields.text('payload', 'event_type')} AS event_type", "hit")
        .groupBy("event_type")
        .agg(F.count("*").alias("events"), F.count_if("hit").alias("hits"))
    )


def one_per_user(users: DataFrame) -> DataFrame:
    """One row per user id, so that a lookup never multiplies an event.

    Of several rows for an id the greatest by its attributes stays, the same in every run.
    """
    attributes = F.struct(*_ATTRIBUTES.values())
    return (
        users.where("user_id IS NOT NULL")
        .groupBy("user_id")
        .agg(F.max(attributes).alias("_kept"))
        .select("user_id", "_kept.*")
    )
