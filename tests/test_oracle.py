"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from tierfold.checks import queries as library
from conftest import TESTDATA

SF = os.environ.get("ORACLE_SF", "sf0.001")
LIBRARY = library.QUERIES
QUERIES, ORACLE = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in sorted(Path(TESTDATA, SF).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    result = QUERIES[name](spark, f"{TESTDATA}/{SF}")
    found = [tuple(r) for r in result.collect()]
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(result.columns)
    expected = _rows(names, cursor.fetchall())
    assert expected, "an empty result proves nothing"
    assert _rows(result.columns, found) == expected


def test_every_query_has_sql():
    assert set(LIBRARY) <= set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
