"""Every query with SQL gives what DuckDB gives on the same tables."""

import math
from pathlib import Path

import duckdb
import pytest

from factloom.plans import load

SF = "/root/testdata/sf0.001"
QUERIES, SQL = load()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def cell(x):
    if isinstance(x, float):
        return "null" if math.isnan(x) else f"{x:.9g}"
    return "null" if x is None else f"{float(x):.9g}" if isinstance(x, int) and not isinstance(x, bool) else str(x)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, got.collect()) == rows(names, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    got = QUERIES[name](spark, SF)
    assert got.columns and got.count() >= 0
