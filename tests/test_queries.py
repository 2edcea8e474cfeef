"""Every core query against its DuckDB equivalent on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from millrace.plans import core_queries
from millrace.plans.registry import TABLES

DATA = "/root/testdata/sf0.001"
QUERIES, ORACLES = core_queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def plain(x):
    if isinstance(x, (list, tuple)):
        return "[" + ", ".join(plain(y) for y in x) + "]"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (int, float)):
        return "null" if isinstance(x, float) and math.isnan(x) else f"{float(x):.9g}"
    return "null" if x is None else str(x)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    found = QUERIES[name](spark, DATA)
    got = rows(found.columns, [tuple(r) for r in found.collect()])
    cursor = duck.execute(ORACLES[name])
    columns = [x[0] for x in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    assert got == rows(columns, cursor.fetchall())
