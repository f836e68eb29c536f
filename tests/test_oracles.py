"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os
import sys
from collections import Counter

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import TABLES, rows_of  # noqa: E402

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert len(rows) > 0
        return
    res = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert Counter(rows_of(df.columns, rows)) == Counter(rows_of(res.columns, res.fetchall()))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
