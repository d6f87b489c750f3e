"""Every query with SQL text gives the rows of a second engine, at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import connect, differences
from strataflow.plans.oracle import ORACLE
from strataflow.plans.registry import QUERIES
from tests.conftest import SF


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    assert differences(spark, duck, name, SF) == []


def test_sql_keys_are_queries():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) - set(ORACLE) == {"data_volume"}


def test_entry(spark):
    assert entry(spark).count() == 4
