"""Registered queries against their DuckDB forms on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract  # noqa: E402
from compare import TABLES, canonical  # noqa: E402

ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, database, name):
    found = canonical(contract.queries()[name](spark, sf_dir).toPandas())
    wanted = canonical(database.execute(ORACLES[name]).df())
    assert list(found.columns) == list(wanted.columns)
    assert found.equals(wanted)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert rows and {"Resultado", "n"} == set(rows[0].asDict())
