"""Every query with SQL, on the smallest example tables, against DuckDB."""

import math
import os

import duckdb
import pytest

from gridloom.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the example tables are not there")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SMALL):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SMALL}/{f}'")
    return c


def rows(df):
    said = lambda v: "none" if v is None or v != v else f"{v:.6f}" if isinstance(v, float) and not math.isinf(v) else str(v)
    return sorted(tuple(map(said, r)) for r in df[sorted(df.columns)].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, con, name):
    got, want = QUERIES[name](spark, SMALL).toPandas(), con.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"checks_all"}))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0
