"""Evaluating costly columns once per row."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation


def with_once(df: DataFrame, values: dict[str, str]) -> DataFrame:
    """Add columns that later filters refer to instead of repeating.

    A filter on a projected column is moved below the projection with the
    column's whole expression in its place, so a parse would run once in the filter
    and again in the projection. The output of a generator is not taken apart like
    that: a one-element array of structs gives each row back with the values fixed.
    """
    pairs = ", ".join(f"'{name}', {value}" for name, value in values.items())
    return df.selectExpr("*", f"inline(array(named_struct({pairs})))")


def rows_seen(observation: Observation, name: str = "rows") -> int:
    """A number observed by an action that has ended.

    A part of a plan that turns out to be empty is taken out of it, and with it the
    counter; there is then nothing to report.
    """
    try:
        return observation.get[name] or 0
    except Py4JJavaError:
        return 0
