"""Checks over landed, raw and curated events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headrace import schemas as S
from headrace.functions import fields


def reconcile(landed: DataFrame, raw: DataFrame) -> DataFrame:
    """Types and dates whose landed and raw counts differ.

    Both sides carry ``event_type`` and ``dt``. Counts are partial sums before the
    shuffle, and the join runs on the counts.
    """
    left = landed.groupBy("event_type", "dt").agg(F.count("*").alias("landed"))
    right = raw.groupBy("event_type", "dt").agg(F.count("*").alias("raw"))
    return (
        left.join(right, ["event_type", "dt"], "full")
        .select(
            "event_type",
            "dt",
            F.coalesce("landed", F.lit(0)).alias("landed"),
            F.coalesce("raw", F.lit(0)).alias("raw"),
        )
        .where(F.col("landed") != F.col("raw"))
    )


DIGEST = "event_type string, dt date, events bigint, id_sum decimal(38,0), id_mix decimal(38,0)"


def digests(rows: DataFrame, key: str = "event_id") -> DataFrame:
    """The set of ids of each type and date as a count and two order-free sums of hashes.

    Digests of disjoint batches add up, see ``merge_digests``, so a job may keep those of each
    batch beside its output, and two stages are compared without reading events again. Equal
    sets have equal digests. Unequal sets of one size have the same with a chance of about
    2^-128, the hashes having different seeds. Null ids are counted and share one hash; types
    and dates may be null. Sums of 64-bit hashes fit 38 digits up to 10^18 rows.
    """
    return merge_digests(
        rows.select(
            "event_type",
            F.col("dt").cast("date").alias("dt"),
            F.lit(1).cast("bigint").alias("events"),
            F.xxhash64(key).cast("decimal(38,0)").alias("id_sum"),
            F.xxhash64(F.lit("headrace"), F.col(key)).cast("decimal(38,0)").alias("id_mix"),
        )
    )


def merge_digests(*parts: DataFrame) -> DataFrame:
    """The digests of all rows of some disjoint batches, from those of the batches."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("event_type", "dt").agg(
        F.sum("events").alias("events"),
        *(F.sum(c).cast("decimal(38,0)").alias(c) for c in ("id_sum", "id_mix")),
    )


def differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Types and dates whose digests differ, with both counts: those that need a repair.

    A type and date that one side lacks has a count of 0 there. The join runs on digests, one
    row for each type and date.
    """
    same = (
        F.col("left.event_type").eqNullSafe(F.col("right.event_type"))
        & F.col("left.dt").eqNullSafe(F.col("right.dt"))
    )
    equal = F.lit(True)
    for name in ("events", "id_sum", "id_mix"):
        equal = equal & F.col(f"left.{name}").eqNullSafe(F.col(f"right.{name}"))
    return (
        left.alias("left")
        .join(right.alias("right"), same, "full")
        .where(~equal)
        .select(
            F.coalesce("left.event_type", "right.event_type").alias("event_type"),
            F.coalesce("left.dt", "right.dt").alias("dt"),
            F.coalesce("left.events", F.lit(0)).alias("left_events"),
            F.coalesce("right.events", F.lit(0)).alias("right_events"),
        )
    )


def order_amounts(
    curated: DataFrame, threshold: float = S.DEFAULT_HIGH_VALUE_THRESHOLD
) -> DataFrame:
    """Orders whose amount is not quantity times price or whose flag is wrong.

    Decimals throughout, rounded half up. Rows that lack a value are not judged on
    it.
    """
    expected = F.round(F.col("quantity") * F.col("unit_price"), 2)
    wrong_amount = F.coalesce(expected != F.col("amount"), F.lit(False))
    wrong_flag = F.coalesce(
        F.col("is_high_value") != (F.col("amount") >= F.lit(threshold).cast("decimal(14,2)")),
        F.lit(False),
    )
    return (
        curated.where(F.col("event_type") == "order")
        .select(
            "event_id",
            "quantity",
            "unit_price",
            "amount",
            "is_high_value",
            wrong_amount.alias("wrong_amount"),
            wrong_flag.alias("wrong_flag"),
        )
        .where("wrong_amount OR wrong_flag")
    )


def contract(records: DataFrame) -> DataFrame:
    """Rows per broken rule of the event contract, all rules in one pass.

    Base fields must be present, the type known, and an event of a known type must
    hold that type's fields.
    """
    kind = fields.text("payload", "event_type")
    known = ", ".join(f"'{t}'" for t in S.EVENT_TYPES)
    broken = {f"missing {f}": f"NOT {fields.has_field('payload', f)}" for f in S.BASE_FIELDS}
    broken["unknown type"] = f"NOT coalesce({kind} IN ({known}), false)"
    for name, required in S.TYPE_FIELDS.items():
        lacking = " OR ".join(f"NOT {fields.has_field('payload', f)}" for f in required)
        broken[f"incomplete {name}"] = f"{kind} = '{name}' AND ({lacking})"
    counts = records.selectExpr(
        *(f"count_if({test}) AS `{rule}`" for rule, test in broken.items()), "count(*) AS events"
    )
    rules = ", ".join(f"named_struct('rule', '{r}', 'violations', `{r}`)" for r in broken)
    return counts.selectExpr(f"inline(array({rules}))", "events")
