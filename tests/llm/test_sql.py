"""Queries of the subpackage against their SQL, row by row."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from txmon.llm import registry, suffix_repeats

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_as_sql(spark, odd, name):
    folder = SF if name.startswith("op1_") else odd
    database = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        database.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    expected = database.sql(registry.oracle_sql()[name])
    columns = sorted(expected.columns)
    result = registry.queries()[name](spark, folder)
    assert sorted(result.columns) == columns
    want = database.sql(f"SELECT {', '.join(columns)} FROM ({registry.oracle_sql()[name]})").fetchall()
    got = [tuple(r) for r in result.select(*columns).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_interval_tree_of_a_small_array():
    # Suffixes of banana, sorted: a, ana, anana, banana, na, nana.
    found = sorted(suffix_repeats.intervals([1, 3, 0, 0, 2], 1))
    assert found == [(0, 3, 1), (1, 3, 3), (4, 6, 2)]
