"""The queries that SQL can express, against DuckDB."""

import duckdb
import pytest

from phenoscope.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    out = QUERIES[name](spark, SF)
    columns = sorted(out.columns)
    rel = con.sql(ORACLE[name])
    assert sorted(rel.columns) == columns
    want = sorted(map(tuple, rel.select(*columns).fetchall()), key=repr)
    assert sorted(map(tuple, out.select(*columns).collect()), key=repr) == want and want
