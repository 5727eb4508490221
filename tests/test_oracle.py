"""Every registered query against its SQL counterpart on the same tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if value is None:
        return None
    return int(value) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, database, name):
    got = queries()[name](spark, SF_DIR)
    want = database.sql(oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    got_rows = [tuple(row[c] for c in columns) for row in got.collect()]
    order = [want.columns.index(c) for c in columns]
    want_rows = [tuple(plain(row[i]) for i in order) for row in want.fetchall()]
    assert len(got_rows) == len(want_rows)
    assert sorted(got_rows, key=repr) == sorted(want_rows, key=repr)
    assert want_rows


def test_queries_without_sql_give_rows(spark):
    for name in sorted(set(queries()) - set(oracle_sql())):
        assert queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry(spark).count() > 0
