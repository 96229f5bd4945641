"""Every registered query returns what its SQL returns on the same tables."""

from __future__ import annotations

import pytest
from compare import connect, difference
from conftest import MEDIUM, SMALL

import __spark_entry__ as contract
from workloads import catalog, oracles

QUERIES, SQL = catalog.REGISTERED, oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert difference(QUERIES[name](spark, SMALL), duck, SQL[name]) is None


def test_entry_has_a_stable_schema(spark):
    assert contract.entry(spark).schema == contract.entry(spark).schema


def test_known_counts(spark):
    """Planted differences of the orders pair, counted independently."""
    found = QUERIES["discrepancy_report"](spark, MEDIUM).groupBy("type", "column").count()
    assert {(r["type"], r["column"]): r["count"] for r in found.collect()} == {
        ("missing_in_dest", None): 155,
        ("extra_in_dest", None): 169,
        ("mismatch", "amount"): 479,
        ("mismatch", "status"): 603,
        ("mismatch", "priority"): 316,
        ("mismatch", "order_date"): 281,
    }


def test_known_counts_of_duplicate_keys(spark):
    found = QUERIES["discrepancy_report_lines"](spark, MEDIUM).groupBy("type", "column").count()
    assert {(r["type"], r["column"]): r["count"] for r in found.collect()} == {
        ("missing_in_dest", None): 3461,
        ("mismatch", "quantity"): 5064,
    }
