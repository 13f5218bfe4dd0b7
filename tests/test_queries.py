"""Every registered query against DuckDB's answer to its SQL."""

import glob
import os
from decimal import Decimal

import duckdb
import pytest

from sparkfed.plans import registry

SF = "/root/testdata/sf0.001"


def rows(columns, data):
    order = [columns.index(c) for c in sorted(columns)]

    def plain(v):
        if isinstance(v, (float, Decimal)):
            return round(float(v), 6)
        return v.isoformat() if hasattr(v, "isoformat") else v

    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    rel = duck.sql(registry.SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows(df.columns, df.collect()) == rows(rel.columns, rel.fetchall())


def test_entry_and_names(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
