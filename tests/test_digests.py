"""Digests of id sets: equal sets agree however they were split, unequal ones of one size do not."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from headrace.operators import audit

ROWS = "event_id string, event_type string, dt string"


def table(spark, *rows):
    return spark.createDataFrame(list(rows), ROWS)


def found(df):
    return sorted((tuple(r)[0], str(tuple(r)[1]), *tuple(r)[2:]) for r in df.collect())


def test_equal_counts_of_different_ids(spark):
    left = audit.digests(table(spark, ("1", "a", "2024-01-01"), ("2", "a", "2024-01-01"), ("3", "b", "2024-01-01")))
    right = audit.digests(table(spark, ("2", "a", "2024-01-01"), ("9", "a", "2024-01-01"), ("3", "b", "2024-01-01")))
    assert found(audit.differing(left, right)) == [("a", "2024-01-01", 2, 2)]
    assert found(audit.differing(left, left)) == []


def test_missing_dates_nulls_and_empty_tables(spark):
    left = audit.digests(table(spark, (None, None, None), ("1", "a", "2024-01-01"), ("1", "a", "2024-01-02")))
    right = audit.digests(table(spark, (None, None, None), ("1", "a", "2024-01-01")))
    assert found(audit.differing(left, right)) == [("a", "2024-01-02", 1, 0)]
    empty = audit.digests(table(spark))
    assert found(audit.differing(empty, empty)) == []
    assert len(found(audit.differing(right, empty).na.fill("-"))) == 2


def test_a_repeated_row_is_told(spark):
    """Two copies of an id and none of another are not the set of both."""
    left = audit.digests(table(spark, ("1", "a", "2024-01-01"), ("1", "a", "2024-01-01")))
    right = audit.digests(table(spark, ("1", "a", "2024-01-01"), ("2", "a", "2024-01-01")))
    assert len(found(audit.differing(left, right))) == 1


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.text("ab1", max_size=3), st.sampled_from("xy")), min_size=1, max_size=20),
    st.randoms(use_true_random=False),
)
def test_any_split_adds_up(spark, ids, chance):
    rows = [(i, t, "2024-01-01") for i, t in ids]
    whole = audit.digests(table(spark, *rows))
    chance.shuffle(rows)
    cut = chance.randint(0, len(rows))
    parts = audit.merge_digests(audit.digests(table(spark, *rows[:cut])), audit.digests(table(spark, *rows[cut:])))
    assert found(audit.differing(whole, parts)) == []


def test_columns(spark):
    made = audit.digests(table(spark, ("1", "a", "2024-01-01")))
    assert made.schema.simpleString() == spark.createDataFrame([], audit.DIGEST).schema.simpleString()


def test_one_row_for_each_type_and_date(spark):
    rows = spark.range(1000).selectExpr("string(id) event_id", "string(id % 3) event_type", "'2024-01-01' dt")
    assert audit.digests(rows).count() == 3
