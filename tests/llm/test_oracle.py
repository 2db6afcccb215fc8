"""Queries that SQL can express against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from gridcast.llm import queries
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    res = con.execute(queries.ORACLE[name])
    names = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(names)
    assert digest([tuple(r) for r in df.collect()], df.columns)[0] == digest(res.fetchall(), names)[0]
