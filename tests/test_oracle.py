"""Every registered query against its DuckDB twin, on the same files."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pytest

from verification.registry import ORACLE, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return repr(value)


def test_every_query_has_a_twin():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("key", list(QUERIES))
def test_matches_twin(spark, sf_dir, duck, key):
    df = QUERIES[key](spark, sf_dir)
    twin = duck.execute(ORACLE[key])
    names = [d[0] for d in twin.description]
    kinds = {d[0]: str(d[1]) for d in twin.description}
    expected = twin.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert {n: TYPES[t] for n, t in df.dtypes} == kinds
    order = sorted(names)
    mine = sorted(tuple(plain(r[n]) for n in order) for r in df.collect())
    theirs = sorted(tuple(plain(r[names.index(n)]) for n in order) for r in expected)
    assert mine == theirs
