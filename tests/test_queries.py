"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tillstream.plans.catalogue import QUERIES as RETAIL

FOLDER = Path("/root/testdata/sf0.001")
QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    yield connection
    connection.close()


def comparable(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_its_sql():
    """The optional operators have SQL where it can express them, else tests of their own."""
    assert set(RETAIL) <= set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, duck, name):
    frame = QUERIES[name](spark, str(FOLDER))
    cursor = duck.execute(SQL[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    expected = comparable(cursor.fetchall(), columns)
    assert comparable([tuple(r) for r in frame.collect()], frame.columns) == expected
    assert expected
