"""The registered queries that have SQL, against DuckDB on the smallest data set."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from framewright.llm import queries

SF = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not SF.exists(), reason="needs the driver's tables")


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(round(value, 9))
    return str(value)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    connection = duckdb.connect()
    for path in SF.glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    df = queries.QUERIES[name](spark, str(SF))
    columns = sorted(df.columns)
    got = sorted(tuple(plain(row[c]) for c in columns) for row in df.collect())
    cursor = connection.execute(queries.ORACLES[name])
    found = [d[0] for d in cursor.description]
    assert sorted(found) == columns
    at = [found.index(c) for c in columns]
    assert got == sorted(tuple(plain(row[i]) for i in at) for row in cursor.fetchall())
