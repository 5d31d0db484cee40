"""Registered queries with SQL against DuckDB on the smallest driver tables."""

import duckdb
import pytest

from cellmart.llm.queries import ORACLES, QUERIES
from tools.check_oracles import TABLES, digest

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    got, want = QUERIES[name](spark, SF_DIR).toPandas(), con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert digest(got) == digest(want)
