"""Every registered query against its SQL on the same tables."""

import os
from collections import Counter
from decimal import Decimal

import pytest

import __spark_entry__ as entry
from passerby.plans import catalog, oracle

duckdb = pytest.importorskip("duckdb")
FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (float, Decimal)):
        return round(float(value), 6)
    return value if isinstance(value, int) else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in sorted(os.listdir(FOLDER)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows_as_sql(spark, tables, name):
    ours = entry.queries()[name](spark, FOLDER)
    result = tables.execute(entry.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    assert sorted(ours.columns) == sorted(columns)
    expected = _rows(columns, result.fetchall())
    assert expected, "the check needs rows"
    assert _rows(ours.columns, [tuple(row) for row in ours.collect()]) == expected


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 1500
