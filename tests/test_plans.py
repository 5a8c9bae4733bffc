"""Every registered query of the hazard tables against its SQL twin."""

import glob
import math
import os
import threading

import duckdb
import pytest

from galeforge import plans

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = plans.queries(), plans.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    return repr(round(v, 6) + 0.0) if isinstance(v, float) else str(v)


def test_all_have_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, FOLDER)
    want = duck.execute(SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(got.columns)
    order = sorted(columns)
    a = sorted(tuple(plain(r[c]) for c in order) for r in got.collect())
    b = sorted(tuple(plain(r[columns.index(c)]) for c in order) for r in want.fetchall())
    assert a == b


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_sql_ends_under_a_limit(duck, name):
    """A limit may change the plan; none may then run on."""
    got = []
    runner = threading.Thread(target=lambda: got.append(duck.cursor().execute(f"select * from ({SQL[name]}) limit 5").fetchall()), daemon=True)
    runner.start()
    runner.join(30)
    assert got and len(got[0]) <= 5
