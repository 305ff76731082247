"""Every registered query against its SQL twin, on the smallest given tables."""

import os

import compare
import pytest

import __spark_entry__ as entry_points
from saleswright.plans.oracle import oracle_queries
from saleswright.plans.registry import all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return compare.open_duckdb(SF_DIR)


def test_every_query_has_a_twin():
    assert set(all_queries()) == set(oracle_queries())


def test_entry_registers_every_query():
    assert set(all_queries()) <= set(entry_points.queries())
    assert set(oracle_queries()) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_its_twin(spark, duck, name):
    mine = compare.spark_rows(entry_points.queries()[name](spark, SF_DIR))
    assert mine == compare.duckdb_rows(duck, entry_points.oracle_sql()[name])
    assert mine[1], "no rows"


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
