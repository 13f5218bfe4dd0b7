"""Table statistics: ANALYZE, sizes and row estimates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..catalog import Catalog
from ..sources.readers import open_source, open_table

LEAST_ROWS = 1000


def analyze(spark: SparkSession, catalog: Catalog, name: str) -> None:
    """ANALYZE TABLE ... COMPUTE STATISTICS, for a table of Spark's catalog; other sources know their sizes."""
    o = catalog.resolve(name)
    if o["format"] == "table":
        spark.sql(f"ANALYZE TABLE `{o['dbname']}`.`{o['table_name']}` COMPUTE STATISTICS")


def plan_stats(df: DataFrame) -> tuple[int, int | None]:
    """(bytes, rows or None) as the optimiser has them."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    rows = stats.rowCount()
    return int(str(stats.sizeInBytes())), int(str(rows.get())) if rows.isDefined() else None


def size_in_bytes(spark: SparkSession, catalog: Catalog, name: str) -> int:
    return plan_stats(open_source(spark, catalog, name))[0]


def estimated_rows(spark: SparkSession, catalog: Catalog, name: str) -> int:
    """The rows a plan is made for: the statistics' if use_remote_estimate is on and they are known, 1000 at least."""
    if not catalog.resolve(name)["use_remote_estimate"]:
        return LEAST_ROWS
    size, rows = plan_stats(open_table(spark, catalog, name))
    width = 8 * len(catalog.tables[name].columns) + 20
    return max(LEAST_ROWS, rows if rows is not None else size // width)


def vacuum(spark: SparkSession, catalog: Catalog, name: str, analyze_too: bool = False) -> None:
    """VACUUM [FULL | FREEZE | ANALYZE]: accepted for a known table, and no work, since rows lie at the source."""
    catalog.resolve(name)
    if analyze_too:
        analyze(spark, catalog, name)


def sample_rows(spark: SparkSession, catalog: Catalog, name: str, fraction: float, seed: int = 0) -> DataFrame:
    """A Bernoulli sample of a table's rows, taken where they are read."""
    return open_table(spark, catalog, name).sample(False, fraction, seed)
