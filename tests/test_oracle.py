"""Every query of the core library against its SQL."""

import pytest

import __spark_entry__ as entry_module
from conftest import SF
from testbed.check import compare, duckdb_tables
from testbed.oracle import oracles
from testbed.queries import QUERIES

ORACLES = oracles()


@pytest.fixture(scope="module")
def con():
    return duckdb_tables(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_module.queries())
    assert ORACLES.items() <= entry_module.oracle_sql().items()
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF, name, ORACLES[name]) == ""


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
