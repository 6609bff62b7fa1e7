"""Every query against independent SQL on the same tables."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from workload import oracle, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, Decimal):
        return f"{value:f}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return repr(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(queries.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_same_as_sql(spark, database, name):
    result = contract.queries()[name](spark, SF)
    expected = database.sql(contract.oracle_sql()[name])
    assert sorted(result.columns) == sorted(expected.columns)
    want = sorted_rows(expected.columns, expected.fetchall())
    assert sorted_rows(result.columns, result.collect()) == want


def test_entry(spark):
    assert contract.entry(spark).count() > 0
