"""Set operations, subqueries, parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import QUERIES, SQL, Tables, both, same_text

A, B = "SELECT n_regionkey AS k FROM nation", "SELECT s_nationkey % 4 AS k FROM supplier"


def sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    a = t.nation.select(F.col("n_regionkey").alias("k"))
    return a, t.supplier.select((F.col("s_nationkey") % 4).alias("k"))


@both(f"{A} UNION {B}")
def union_distinct(t: Tables) -> DataFrame:
    a, b = sides(t)
    return a.union(b).distinct()


@both(f"{A} UNION ALL {B}")
def union_all(t: Tables) -> DataFrame:
    a, b = sides(t)
    return a.union(b)


@both(f"{A} INTERSECT {B}")
def intersect(t: Tables) -> DataFrame:
    a, b = sides(t)
    return a.intersect(b)


@both(f"{A} INTERSECT ALL {B}")
def intersect_all(t: Tables) -> DataFrame:
    a, b = sides(t)
    return a.intersectAll(b)


@both(f"{A} EXCEPT {B}")
def except_(t: Tables) -> DataFrame:
    a, b = sides(t)
    return a.subtract(b)


@both(f"{A} EXCEPT ALL {B}")
def except_all(t: Tables) -> DataFrame:
    a, b = sides(t)
    return a.exceptAll(b)


same_text("scalar_subquery", "SELECT o_orderkey FROM {orders} WHERE o_totalprice > 2.5 * (SELECT avg(o_totalprice) FROM {orders})")
same_text("scalar_subquery_select", "SELECT n_name, (SELECT count(*) FROM {region}) AS n FROM {nation}")
same_text("correlated_scalar", "SELECT o_orderkey FROM {orders} a WHERE o_totalprice = (SELECT max(o_totalprice) FROM {orders} b WHERE b.o_custkey = a.o_custkey)")
same_text("correlated_in", "SELECT s_suppkey FROM {supplier} WHERE s_nationkey IN (SELECT n_nationkey FROM {nation} WHERE n_regionkey = s_suppkey % 5)")
same_text("correlated_not_in", "SELECT s_suppkey FROM {supplier} WHERE s_suppkey % 25 NOT IN (SELECT n_nationkey FROM {nation} WHERE n_regionkey = s_nationkey % 5)")
same_text("correlated_non_equi", "SELECT n_nationkey FROM {nation} a WHERE n_regionkey IN (SELECT n_regionkey FROM {nation} b WHERE b.n_nationkey < a.n_nationkey - 18 OR b.n_nationkey > a.n_nationkey + 18)")
same_text("exists_not_exists", "SELECT n_name FROM {nation} WHERE EXISTS (SELECT 1 FROM {supplier} WHERE s_nationkey = n_nationkey AND s_acctbal > 9000) AND NOT EXISTS (SELECT 1 FROM {supplier} WHERE s_nationkey = n_nationkey AND s_acctbal < 0)")
same_text("derived_join", "SELECT n_name, x.n FROM {nation} JOIN (SELECT c_nationkey, count(*) AS n FROM {customer} GROUP BY c_nationkey) x ON c_nationkey = n_nationkey WHERE x.n > 55")


@both("SELECT r_name, (SELECT max(n_name) FROM nation WHERE n_regionkey = r_regionkey) AS last FROM region")
def scalar_lateral_rewritten(t: Tables) -> DataFrame:
    """A scalar subquery with a lateral inside, as a join with the aggregate."""
    per = t.nation.groupBy("n_regionkey").agg(F.max("n_name").alias("last"))
    return t.region.join(per, F.col("r_regionkey") == F.col("n_regionkey"), "left").select("r_name", "last")


def param_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed parameters, bound by position."""
    orders = Tables(spark, sf_dir).orders
    orders.createOrReplaceTempView("sparkfed_orders")
    return spark.sql("SELECT o_orderkey, o_totalprice FROM sparkfed_orders WHERE o_totalprice > ? AND o_orderstatus = ?", args=[250000.0, "F"])


QUERIES["param_query"] = param_query
SQL["param_query"] = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000.0 AND o_orderstatus = 'F'"
