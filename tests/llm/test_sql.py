import glob
import os

import duckdb
import pytest

from sparkfed.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_against_its_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df, rel = queries.queries()[name](spark, SF), con.sql(queries.SQL[name])
    order = sorted(df.columns)
    assert order == sorted(rel.columns)
    got = sorted(tuple(r[c] for c in order) for r in df.collect())
    at = [rel.columns.index(c) for c in order]
    assert got == sorted(tuple(r[i] for i in at) for r in rel.fetchall())
