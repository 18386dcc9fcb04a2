"""Every registered query against its SQL twin (DuckDB) at sf0.001."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "scripts"))
import check_oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check_oracle.TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_registry_consistent():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 100


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql_twin(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    ocols, orows = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert check_oracle.canon(cols, rows) == check_oracle.canon(ocols, orows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["country", "region_code", "n_ai_postings", "region", "n_postings", "ai_share"]
    assert df.count() > 0
