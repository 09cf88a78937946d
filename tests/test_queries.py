"""Every registered query of the core runs, and equals its SQL twin where it has one."""

import os
from importlib import import_module

import duckdb
import pytest

import __spark_entry__ as entry

from .conftest import SF

CORE = [import_module(m) for m in entry._MODULES]
QUERIES = {n: f for m in CORE for n, f in m.QUERIES.items()}
SQL = {n: s for m in CORE for n, s in m.SQL.items()}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        table = name.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{name}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted(map(repr, map(tuple, df.select(*columns).collect())))
    if name in SQL:
        quoted = ", ".join(f'"{c}"' for c in columns)
        assert sorted(c.lower() for c in duck.sql(SQL[name]).columns) == sorted(c.lower() for c in columns)
        assert rows == sorted(map(repr, duck.sql(f"SELECT {quoted} FROM ({SQL[name]})").fetchall()))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
