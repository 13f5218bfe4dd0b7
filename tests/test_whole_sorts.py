"""Sorts without a LIMIT give all rows in the order of DuckDB's."""

import duckdb
import pytest

from sparkfed.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(n for n in registry.QUERIES if n.startswith("sort_") and n.endswith("_all")))
def test_order(spark, name):
    con = duckdb.connect()
    for t in ("nation", "orders", "part", "customer"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    assert "LIMIT" not in registry.SQL[name]
    got = [tuple(r) for r in registry.QUERIES[name](spark, SF).collect()]
    assert got == con.sql(registry.SQL[name]).fetchall()


def test_all_sorts():
    assert sum(n.startswith("sort_") and n.endswith("_all") for n in registry.QUERIES) == 9
