"""Queries with a landed and a raw side decode their envelopes once."""

from __future__ import annotations

import pytest
from conftest import SMALL

from headrace.operators import land
from headrace.plans import queries
from headrace.sources import bindings, landing


@pytest.mark.parametrize("name", ["late_repair", "late_repair_summary", "reconcile_counts", "digest_audit"])
def test_envelopes_are_built_once(spark, monkeypatch, name):
    built, read = [], bindings.envelopes

    def envelopes(*args, **kwargs):
        built.append(args)
        return read(*args, **kwargs)

    monkeypatch.setattr(bindings, "envelopes", envelopes)
    assert queries.all_queries()[name](spark, SMALL).collect()
    assert len(built) == 1


def test_both_sides_hold_all_landable_rows(spark):
    path, rows = queries._delivered(spark, SMALL)
    landed = landing.scan(spark, path).selectExpr("to_json(payload) AS payload", "event_type", "dt")
    staged = rows.selectExpr("to_json(payload) AS payload", "event_type", "dt")
    wanted = land.landable(queries._prepared(spark, SMALL)).selectExpr("to_json(payload) AS payload", "event_type", "dt")
    assert sorted(landed.collect()) == sorted(staged.collect()) == sorted(wanted.collect())
