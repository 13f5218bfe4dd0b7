"""All queries over the driver's tables, with the SQL that gives the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of a folder as DataFrames, by attribute; only what is asked for is opened."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._dir}/{name}.parquet")


def both(sql: str) -> Callable:
    """Registers a query over Tables under its function's name, together with its SQL."""

    def put(f: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[f.__name__.rstrip("_")] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        SQL[f.__name__.rstrip("_")] = sql
        return f

    return put


def same_text(name: str, sql: str, oracle: str | None = None) -> None:
    """Registers a query whose natural form is SQL; tables are written {name}. oracle: where DuckDB's text differs."""
    names = sorted(set(re.findall(r"\{(\w+)\}", sql)))

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = Tables(spark, sf_dir)
        return spark.sql(sql, **{n: getattr(tables, n) for n in names})

    QUERIES[name] = run
    SQL[name] = re.sub(r"\{(\w+)\}", r"\1", oracle or sql)


def load() -> None:
    from ..operators import aggregates, filters, joins, scans, sets, sorting, windows  # noqa: F401


load()
