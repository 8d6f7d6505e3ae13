"""Every registered query against its check SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, shape
from sensorloom.catalog import load

SF = "/root/testdata/sf0.001"
QUERIES, SQL = load().queries(), load().check_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["Cable", "measure", "min", "mean", "max", "total", "Change"] and df.count() == 5


def test_every_check_belongs_to_a_query():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = shape(df.columns, [tuple(r) for r in df.collect()])
    if name not in SQL:
        assert got[1]
        return
    res = duck.execute(SQL[name])
    want = shape([d[0] for d in res.description], res.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]
