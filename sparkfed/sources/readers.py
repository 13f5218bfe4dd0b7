"""Opens a declared table as a DataFrame: Parquet, ORC, delimited text, a catalog table, or JDBC.

Columns are matched by name (delimited text: by place, which is all it has), and read as their declared types. Nothing
is inferred, and only what a query asks for is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import Catalog
from ..types import coerced


def jdbc_url(options: dict[str, object]) -> str:
    url = f"jdbc:hive2://{options['host']}:{options['port']}/{options['dbname']}"
    if options["ssl"]:
        url += ";ssl=true" + "".join(f";{k}={options[o]}" for k, o in (("sslTrustStore", "ssltruststore"), ("trustStorePassword", "truststorepassword")) if options[o])
    if not options["username"] or options["auth_type"] == "nosasl":
        url += ";auth=noSasl"
    return url


#: Spark's reader writes names in double quotes, which a source must be told to take as names.
QUOTES = {"hiveserver2": "hive.support.quoted.identifiers=standard", "spark": "spark.sql.ansi.enabled=true;spark.sql.ansi.doubleQuotedIdentifiers=true"}


def remote(spark: SparkSession, options: dict[str, object], what: str, ranges: str | None = None) -> DataFrame:
    """What a JDBC source gives for a table's name or a query in brackets; ranges: the column by whose declared ranges it
    is read in parallel. Without one, a single task reads it all."""
    how = {
        "url": jdbc_url(options) + "?" + QUOTES[options["client_type"]],
        "driver": "org.apache.hive.jdbc.HiveDriver",
        "dbtable": what,
        "fetchsize": str(options["fetch_size"]),
        "preferTimestampNTZ": "true",
    }
    if options["username"]:
        how |= {"user": options["username"], "password": options["password"] or ""}
    if ranges:
        how |= {"partitionColumn": ranges, "lowerBound": options["lower_bound"], "upperBound": options["upper_bound"], "numPartitions": str(options["num_partitions"])}
    return spark.read.format("jdbc").options(**how).load()


def open_source(spark: SparkSession, catalog: Catalog, name: str) -> DataFrame:
    """The table's source under its own column names and types."""
    o, t = catalog.resolve(name), catalog.tables[name]
    if o["format"] in ("parquet", "orc"):
        return spark.read.format(o["format"]).load(o["location"])
    if o["format"] == "csv":
        schema = T.StructType([T.StructField(t.remote.get(c, c), T.StringType()) for c, _ in t.columns])
        return spark.read.csv(o["location"], schema=schema, sep=o["delimiter"], nullValue=o["null_text"], emptyValue="", enforceSchema=True)
    if o["format"] == "jdbc":
        return remote(spark, o, f"{o['dbname']}.{o['table_name']}", o["partition_column"])
    return spark.table(f"{o['dbname']}.{o['table_name']}" if o["dbname"] != "default" else o["table_name"])


def open_table(spark: SparkSession, catalog: Catalog, name: str) -> DataFrame:
    """The table with its declared columns. Empty text is null for every type, unless the table says otherwise."""
    source, t = open_source(spark, catalog, name), catalog.tables[name]
    empty = catalog.resolve(name)["empty_as_null"]
    out = []
    for c, declared in t.columns:
        own = t.remote.get(c, c)
        out.append(coerced(F.col(f"`{own}`"), source.schema[own].dataType, declared, empty).alias(c))
    return source.select(*out)


def open_partitions(spark: SparkSession, catalog: Catalog, parts: list[str], bounds: dict[str, tuple] | None = None, key: str | None = None) -> DataFrame:
    """A partitioned parent: the union of its parts by name. Bounds (low, high exclusive) are enforced only if given."""
    out = None
    for p in parts:
        df = open_table(spark, catalog, p)
        if bounds and key and p in bounds:
            df = df.where((F.col(key) >= bounds[p][0]) & (F.col(key) < bounds[p][1]))
        out = df if out is None else out.unionByName(df)
    return out


def register(spark: SparkSession, catalog: Catalog, name: str) -> None:
    """Makes the table a view of its name, for SQL."""
    open_table(spark, catalog, name).createOrReplaceTempView(name)
