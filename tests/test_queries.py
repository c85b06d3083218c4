"""Every registered query against its SQL twin on the same Parquet files."""

import pytest

import __spark_entry__ as contract
from compare import compare, duck

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def oracle(sf):
    connection = duck(sf)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(name, spark, sf, oracle):
    assert compare(QUERIES[name](spark, sf), oracle.execute(ORACLES[name])) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(name, spark, sf):
    assert QUERIES[name](spark, sf).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() == 3
