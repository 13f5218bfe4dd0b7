"""Scans, projections, views, unions of partitions, whole rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.order import pg_order
from ..functions.rewrite import whole_row
from ..plans.registry import Tables, both, same_text


@both("""SELECT c_mktsegment, count(*) AS n_orders, round(sum(o_totalprice), 2) AS revenue, round(avg(o_totalprice), 4) AS avg_price
FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_orderstatus = 'F' GROUP BY c_mktsegment HAVING count(*) > 10
ORDER BY revenue DESC NULLS FIRST, c_mktsegment ASC NULLS LAST LIMIT 5""")
def flagship(t: Tables) -> DataFrame:
    joined = t.orders.where(F.col("o_orderstatus") == "F").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    price = F.col("o_totalprice")
    out = joined.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum(price), 2).alias("revenue"), F.round(F.avg(price), 4).alias("avg_price"))
    return out.where("n_orders > 10").orderBy(*pg_order("-revenue", "c_mktsegment")).limit(5)


@both("SELECT * FROM nation")
def scan_star(t: Tables) -> DataFrame:
    return t.nation


@both("SELECT o_orderkey, o_totalprice FROM orders")
def project_cols(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice")


@both("""SELECT c_name AS "Customer Name", c_acctbal * 2 AS doubled FROM customer""")
def project_alias(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_name").alias("Customer Name"), (F.col("c_acctbal") * 2).alias("doubled"))


@both("SELECT count(*) AS n FROM lineitem")
def scan_no_column(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count(F.lit(1)).alias("n"))


@both("""SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice > 300000""")
def view_over_table(t: Tables) -> DataFrame:
    t.orders.where("o_totalprice > 300000").createOrReplaceTempView("sparkfed_big_orders")
    return t.spark.table("sparkfed_big_orders").select("o_orderkey", "o_custkey", "o_totalprice")


@both("""SELECT o_orderstatus, count(*) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM
(SELECT * FROM orders WHERE o_orderkey < 5000 UNION ALL SELECT * FROM orders WHERE o_orderkey >= 5000) p GROUP BY o_orderstatus""")
def partitioned_union_agg(t: Tables) -> DataFrame:
    """A parent over two range partitions, aggregated."""
    low, high = t.orders.where("o_orderkey < 5000"), t.orders.where("o_orderkey >= 5000")
    out = low.unionByName(high).groupBy("o_orderstatus")
    return out.agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"))


def joined_by_ranges(t: Tables, ranges: list[tuple[int | None, int | None]]) -> DataFrame:
    """Two parents with equal ranges, joined partition by partition; None: no bound."""
    out = None
    for lo, hi in ranges:
        within = lambda k: (F.lit(True) if lo is None else F.col(k) >= lo) & (F.lit(True) if hi is None else F.col(k) < hi)
        a, b = t.orders.where(within("o_orderkey")), t.lineitem.where(within("l_orderkey"))
        part = a.join(b, F.col("o_orderkey") == F.col("l_orderkey")).select("o_orderkey", "l_partkey", "l_quantity")
        out = part if out is None else out.unionByName(part)
    return out


@both("SELECT a.o_orderkey, b.l_partkey, b.l_quantity FROM orders a JOIN lineitem b ON a.o_orderkey = b.l_orderkey")
def partition_wise_join(t: Tables) -> DataFrame:
    return joined_by_ranges(t, [(None, 5000), (5000, None)])


@both("""SELECT r.r_regionkey, n.n_nationkey, n.n_nationkey IS NULL AS row_is_null FROM region r LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 2) n ON r.r_regionkey = n.n_regionkey""")
def whole_row_struct(t: Tables) -> DataFrame:
    """A whole row of an outer join's nullable side is null where the row is absent."""
    n = whole_row(t.nation.where("n_regionkey < 2"), "n").select("n", F.col("n_regionkey"))
    joined = t.region.join(n, F.col("r_regionkey") == F.col("n_regionkey"), "left")
    return joined.select("r_regionkey", F.col("n.n_nationkey").alias("n_nationkey"), F.col("n").isNull().alias("row_is_null"))


same_text("cte_single", "WITH big AS (SELECT * FROM {orders} WHERE o_totalprice > 400000) SELECT o_orderstatus, count(*) AS n FROM big GROUP BY o_orderstatus")
same_text(
    "cte_chain",
    """WITH per AS (SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM {orders} GROUP BY o_custkey), top AS (SELECT * FROM per WHERE total > 1000000)
SELECT c_custkey, c_name, total FROM top JOIN {customer} ON c_custkey = o_custkey""",
)
