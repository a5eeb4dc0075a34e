"""Every registered query against its SQL on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

import check  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db(folder):
    con = duckdb.connect()
    for name in check.TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, db, folder, name):
    df = QUERIES[name](spark, folder)
    got, _ = check.digest(df.columns, [tuple(r) for r in df.collect()])
    cur = db.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    want, _ = check.digest(cols, cur.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0
