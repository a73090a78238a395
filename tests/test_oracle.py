from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from tests.compare import assert_same, connect
from tests.conftest import CHECK, SMALL

QUERIES = entry_points.REGISTRY
ORACLE = entry_points.ORACLE


@pytest.fixture(scope="module")
def check_db():
    return connect(CHECK)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, check_db, name):
    assert assert_same(QUERIES[name](spark, CHECK), check_db, ORACLE[name]) > 0


@pytest.mark.parametrize("name", ["q_ranking_by_subfield", "q_recommend", "q_selection_state"])
def test_same_at_small_scale(spark, name):
    assert assert_same(QUERIES[name](spark, SMALL), connect(SMALL), ORACLE[name]) > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLE.items() <= entry_points.oracle_sql().items()


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
