"""Every registered query with an oracle gives the rows of its DuckDB SQL."""

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def _plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, bool) or v is None:
        return str(v)
    return repr(float(v)) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    want = duck.sql(ORACLES[name])
    assert names == sorted(want.columns)
    order = [want.columns.index(c) for c in names]
    ours = sorted(tuple(_plain(r[c]) for c in names) for r in df.collect())
    assert ours == sorted(tuple(_plain(r[i]) for i in order) for r in want.fetchall())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
