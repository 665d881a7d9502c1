"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import pytest
from check_oracles import connect, difference
from conftest import SF

from __spark_entry__ import entry, oracle_sql, queries
from tradelake.plans.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert difference(queries()[name](spark, SF), duck, oracle_sql()[name]) is None
