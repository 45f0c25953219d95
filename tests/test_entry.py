"""Driver contract: every registered query equals its DuckDB oracle (sf0.001)."""


import duckdb
import pytest

import __spark_entry__ as entry
from scripts.compare import digest

SF = "/root/testdata/sf0.001"
OWN = [k for k in entry.queries() if k not in entry.LLM_QUERIES]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["events"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(OWN) == set(entry.oracle_sql()) - set(entry.LLM_ORACLE)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["dt", "uv"] and df.count() > 0


@pytest.mark.parametrize("key", sorted(OWN))
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
