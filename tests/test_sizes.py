"""Partitions follow the given tables, so that the memory of a task does not."""

import os
import re

import pytest

from saleswright import session
from saleswright.plans import staging
from saleswright.plans.registry import all_queries
from saleswright.storage import size_of

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture()
def small_parts(spark, monkeypatch):
    """Partition sizes at which the smallest tables count as large."""
    monkeypatch.setattr(session, "GIVEN_BYTES", staging.given_bytes(spark, SF_DIR) // 30)
    yield
    monkeypatch.undo()
    session.size_shuffles(spark, 0)


def plan_of(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("name", ["daily_category_metrics", "fact_sales", "clean_sales"])
def test_shuffles_follow_the_input(spark, small_parts, capsys, name):
    plan = plan_of(all_queries()[name](spark, SF_DIR), capsys)
    counts = [int(n) for n in re.findall(r"hashpartitioning\(.*, (\d+)\)", plan)]
    assert counts and min(counts) >= 30


def test_results_stay(spark, monkeypatch):
    plain = all_queries()["daily_category_metrics"](spark, SF_DIR).collect()
    monkeypatch.setattr(session, "GIVEN_BYTES", 10_000)
    many = all_queries()["daily_category_metrics"](spark, SF_DIR).collect()
    monkeypatch.undo()
    session.size_shuffles(spark, 0)
    assert sorted(plain, key=str) == sorted(many, key=str)


@pytest.mark.parametrize("name, key", [("clean_customers", "c_custkey"), ("clean_products", "p_partkey")])
def test_dimensions_are_dealt_before_they_are_sorted(spark, capsys, name, key):
    """A file of one row group is read by one task, which then sorted all its rows."""
    plan = plan_of(all_queries()[name](spark, SF_DIR), capsys)
    assert f"Exchange hashpartitioning({key}#" in plan


def test_sessions_settings_are_kept(spark):
    assert size_of(spark, f"{SF_DIR}/none.parquet") == 0
    initial, least = session.INITIAL_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions"))
    session.size_shuffles(spark, 0)
    assert spark.conf.get(initial, None) is None and session.first_partitions(spark) == least
    session.size_shuffles(spark, 100 * session.GIVEN_BYTES)
    assert session.first_partitions(spark) == 100
    session.size_shuffles(spark, 0)
    assert spark.conf.get(initial, None) is None
    with session.temporary_conf(spark, {initial: "50", session.ADVISORY_BYTES: "1m"}):
        session.size_shuffles(spark, 20 * session.GIVEN_BYTES)
        assert session.first_partitions(spark) == 50 and spark.conf.get(session.ADVISORY_BYTES) == "1m"
