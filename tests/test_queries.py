"""Every registered query against its SQL, on an independent engine."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
import compare
from forktide.plans import ORACLES, QUERIES

# The text operators, where they are there, have tests of their own.


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, sf_dir, name):
    columns, rows = compare.spark_result(QUERIES[name](spark, sf_dir))
    want_columns, want = compare.duck_result(duck, ORACLES[name])
    assert columns == want_columns
    assert len(rows) == len(want)
    assert rows == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() == 5
