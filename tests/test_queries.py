"""Every registered query against its SQL on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as contract
import catalog
import oracles
from verify_queries import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_sql_and_the_other_way_round():
    assert set(catalog.queries()) == set(oracles.oracle_sql())
    assert set(catalog.queries()) <= set(contract.queries())


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, duck, name):
    verdict = compare(spark, duck, name, SF)
    assert verdict.endswith(" ok"), verdict


def test_flagship(spark):
    assert contract.entry(spark).count() > 0
