"""Every registered query against its SQL in DuckDB."""

import duckdb
import pytest

from listwell.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def test_all_have_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, con, name):
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    want = con.execute(ORACLES[name])
    have = [d[0] for d in want.description]
    assert sorted(have) == names
    key = lambda r: tuple((v is None, str(v)) for v in r)
    rows = sorted((tuple(r[have.index(c)] for c in names) for r in want.fetchall()), key=key)
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=key)
    assert got and got == rows


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql()) and set(QUERIES) <= set(__spark_entry__.queries())
