"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_module
from checks import queries
from checks.compare import compare, connect
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="generated tables are not here")


@pytest.fixture(scope="module")
def sql():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sql, name):
    verdict = compare(spark, sql, SF, name)
    assert verdict.startswith(("equal", "rows only")), verdict


def test_neighbours_are_searched_in_a_stored_table(spark, monkeypatch):
    """The labelled vectors are read three times; the join with their labels was repeated each time."""
    seen = []
    monkeypatch.setattr(queries.similar, "nearest", lambda vectors, *_, **__: seen.append(vectors) or vectors.selectExpr("key", "key AS other", "1.0D AS score"))
    QUERIES["nearest_vote"](spark, SF)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" in plan and "Join" not in plan and "Exchange" not in plan


def test_entry(spark):
    assert entry_module.entry(spark).count() > 100
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
