"""Every registered query against its oracle, over whole tables."""

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMALL

QUERIES, ORACLES = entry.lab_queries(), entry.lab_oracles()
# Spark type -> type DuckDB must report.
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "tinyint": "TINYINT",
    "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in entry.TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{SMALL}/{name}.parquet')"
        )
    return connection


def canonical(rows):
    def value(v):
        if isinstance(v, float) and math.isnan(v):
            return "nan"
        return v.isoformat() if isinstance(v, datetime.date) else v

    return sorted((tuple(value(v) for v in row) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    ours = QUERIES[name](spark, SMALL)
    theirs = duck.execute(ORACLES[name])
    kinds = {column[0]: str(column[1]) for column in theirs.description}
    assert {n: TYPES[kind] for n, kind in ours.dtypes} == kinds
    order = sorted(kinds)
    names = [column[0] for column in theirs.description]
    expected = [[row[names.index(n)] for n in order] for row in theirs.fetchall()]
    got = [[row[n] for n in order] for row in ours.collect()]
    assert got, "a query without rows shows nothing"
    assert canonical(got) == canonical(expected)


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    keys = [(row.uid, row.id) for row in rows]
    assert rows and keys == sorted(keys)
    assert {row.result_qty for row in rows} >= {0, 1}
