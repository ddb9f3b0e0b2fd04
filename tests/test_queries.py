"""Every registered query against its expected SQL."""

from __future__ import annotations

import pytest
from compare import expected, expected_types, family, normal

import __spark_entry__ as entry
from headrace.plans.oracles import all_oracles
from headrace.plans.queries import all_queries

SMALL = "/root/testdata/sf0.001"

QUERIES, ORACLES = all_queries(), all_oracles()


def test_every_query_has_an_expected_result():
    assert set(QUERIES) == set(ORACLES)


def test_the_entry_registers_them():
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    result = QUERIES[name](spark, SMALL)
    assert {n: family(t) for n, t in result.dtypes} == expected_types(SMALL, ORACLES[name])
    names, rows = expected(SMALL, ORACLES[name])
    assert sorted(result.columns) == sorted(names)
    assert normal(result.columns, [tuple(r) for r in result.collect()]) == normal(names, rows)
