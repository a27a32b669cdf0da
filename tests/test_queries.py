"""Every registered query against its SQL, on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import TABLES, rows_of  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(QUERIES.keys() & ORACLE.keys()))  # the others have brute-force tests
def test_query_agrees_with_its_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, cursor.fetchall())


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "atlas_id" in df.columns
