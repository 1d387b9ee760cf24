"""Every registered query against its SQL in DuckDB, on the smallest data set."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import checks

SF = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not SF.exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(round(value, 9))
    return str(value)


@pytest.mark.parametrize("name", sorted(checks.QUERIES))
def test_query(spark, duck, name):
    compare(spark, duck, name)


def compare(spark, duck, name):
    df = contract.queries()[name](spark, str(SF))
    columns = sorted(df.columns)
    got = sorted(tuple(plain(row[c]) for c in columns) for row in df.collect())
    cursor = duck.execute(contract.oracle_sql()[name])
    found = [d[0] for d in cursor.description]
    assert sorted(found) == columns
    at = [found.index(c) for c in columns]
    assert got == sorted(tuple(plain(row[i]) for i in at) for row in cursor.fetchall())


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
