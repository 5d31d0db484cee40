"""Every registered query against its DuckDB oracle on the smallest driver tables, and the
driver entry point's smoke check."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from cellmart.plans.catalog import QUERIES
from tools.check_oracles import TABLES, digest

SF_DIR = os.environ.get("CELLMART_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF_DIR).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert digest(got) == digest(want)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    first = df.schema
    n = df.count()
    assert n > 0
    assert entry.entry(spark).schema == first
