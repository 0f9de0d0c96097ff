"""Every registered market query against its DuckDB equivalent on the smallest tables."""

import os
from decimal import Decimal

import duckdb
import pytest

from tidebook.plans import queries as Q

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("events", "orders"):
        c.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


def plain(v):
    return float(v) if isinstance(v, (int, float, Decimal)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_equals_sql(spark, duck, name):
    df = Q.QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=str)
    r = duck.execute(Q.ORACLES[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == cols
    assert got == sorted((tuple(plain(row[names.index(c)]) for c in cols) for row in r.fetchall()), key=str)


def test_no_cartesian_product_and_pushed_filters(spark):
    plan = Q.QUERIES["top_of_book"](spark, DIR)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "props" not in plan.split("== Physical Plan ==")[1]
