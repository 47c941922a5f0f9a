"""Every registered query of the subpackage that has SQL gives the same rows as DuckDB does."""

import duckdb
import pytest

from listwell.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, con, name):
    df = QUERIES[name](spark, SF)
    got_names = sorted(df.columns)
    want = con.execute(ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == got_names
    key = lambda r: tuple((v is None, v) for v in r)
    rows = [tuple(r[names.index(c)] for c in got_names) for r in want.fetchall()]
    got = [tuple(r[c] for c in got_names) for r in df.collect()]
    assert sorted(got, key=key) == sorted(rows, key=key) and got
