"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from medallion_checks.oracle import oracle_sql
from medallion_checks.queries import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from '{path}'")
    yield connection
    connection.close()


def test_each_query_has_sql():
    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    result = duck.execute(oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    names = sorted(types)
    expected = [dict(zip(types, row, strict=True)) for row in result.fetchall()]
    got = [row.asDict() for row in df.collect()]
    assert sorted((repr([r[c] for c in names]) for r in got)) == sorted(
        repr([r[c] for c in names]) for r in expected
    )


def test_entry(spark):
    assert driver.entry(spark).count() > 0
