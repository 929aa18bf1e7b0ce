"""Every registered query against its SQL on the smallest data; those without SQL must run."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

ROOT = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{ROOT}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return tuple((k, plain(x)) for k, x in v.items()) if isinstance(v, dict) else v


@pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test data")
@pytest.mark.parametrize("name", [n for n in QUERIES if n in SQL])
def test_rows_are_those_of_sql(spark, con, name):
    df = QUERIES[name](spark, ROOT)
    cols = sorted(df.columns)
    rel = con.sql(SQL[name])
    assert sorted(rel.columns) == cols
    got = sorted(repr(tuple(map(plain, r))) for r in df.select(*cols).collect())
    assert got == sorted(repr(tuple(map(plain, r))) for r in rel.project(", ".join(f'"{c}"' for c in cols)).fetchall())


@pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test data")
@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SQL])
def test_runs(spark, name):
    df = QUERIES[name](spark, ROOT)
    assert df.count() >= 0 and len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    assert entry.entry(spark).columns == ["snap_id", "navnelbnr", "change"]


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES) and all(any(n.startswith(f"p{i}_") for n in QUERIES) for i in (1, 3, 5, 6))
