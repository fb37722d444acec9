"""Every query with SQL, on the smallest tables, against DuckDB."""

import glob
import math
import os

import duckdb
import pytest

from attestor.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def rows(columns, got):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    fit = lambda v: "NaN" if isinstance(v, float) and math.isnan(v) else f"{v:.6g}" if isinstance(v, float) else str(v)
    return sorted(columns), sorted(tuple(fit(r[i]) for i in order) for r in got)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    cur = db.execute(SQL[name])
    assert rows(df.columns, df.collect()) == rows([d[0] for d in cur.description], cur.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
