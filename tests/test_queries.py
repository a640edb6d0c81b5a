"""Every registered query against its SQL, row for row, on whole tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

QUERIES = entry_points.queries()
ORACLES = entry_points.oracle_sql()

DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def canonical(rows):
    def cell(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else repr(value + 0.0)
        return repr(value)

    return sorted(tuple(cell(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    expected = duck.sql(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})")
    types = dict(result.dtypes)
    assert [DUCK_TYPES[types[c]] for c in columns] == [str(t) for t in expected.types]
    got = canonical(result.select(columns).collect())
    assert got
    assert got == canonical(expected.fetchall())


def test_every_query_of_the_lake_has_sql():
    assert set(entry_points.QUERIES) <= set(ORACLES)
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
