"""Every registered query equals its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from claimloom.plans.catalog import TABLES

FOLDER = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return connection


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, database, name):
    result = contract.queries()[name](spark, FOLDER)
    got = result.collect()
    assert got
    if name in SQL:
        cursor = database.execute(SQL[name])
        columns = [d[0] for d in cursor.description]
        assert sorted(columns) == sorted(result.columns)
        assert canonical(got, result.columns) == canonical(cursor.fetchall(), columns)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
