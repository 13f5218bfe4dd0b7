"""Window functions; order by and nulls are always written out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.order import pg_order
from ..plans.registry import Tables, both, same_text

col = F.col


def by_customer():
    return Window.partitionBy("o_custkey").orderBy(*pg_order("o_orderkey"))


@both("SELECT o_orderkey, round(avg(o_totalprice) OVER (PARTITION BY o_orderstatus), 4) AS v FROM orders")
def win_avg_partition(t: Tables) -> DataFrame:
    """Three statuses hold all rows: partial averages and a join, where a window would buffer a third of them in a task."""
    per = t.orders.groupBy(col("o_orderstatus").alias("s")).agg(F.avg("o_totalprice").alias("a"))
    return t.orders.join(per, col("o_orderstatus").eqNullSafe(col("s"))).select("o_orderkey", F.round("a", 4).alias("v"))


@both("SELECT o_orderkey, count(o_custkey) OVER (PARTITION BY o_custkey) AS n FROM orders")
def win_count(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.count("o_custkey").over(Window.partitionBy("o_custkey")).alias("n"))


@both("SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey NULLS LAST), 2) AS running FROM orders")
def win_sum(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.round(F.sum("o_totalprice").over(by_customer()), 2).alias("running"))


same_text("win_min_max_named", "SELECT o_orderkey, min(o_totalprice) OVER w AS lo, max(o_totalprice) OVER w AS hi FROM {orders} WINDOW w AS (PARTITION BY o_custkey)")


@both("SELECT s_suppkey, rank() OVER (PARTITION BY s_nationkey % 5 ORDER BY s_nationkey DESC NULLS FIRST) AS r FROM supplier")
def win_rank(t: Tables) -> DataFrame:
    w = Window.partitionBy(col("s_nationkey") % 5).orderBy(*pg_order("-s_nationkey"))
    return t.supplier.select("s_suppkey", F.rank().over(w).cast("bigint").alias("r"))


@both("SELECT s_suppkey, dense_rank() OVER (PARTITION BY s_nationkey % 5 ORDER BY s_nationkey NULLS LAST) AS r FROM supplier")
def win_dense_rank(t: Tables) -> DataFrame:
    w = Window.partitionBy(col("s_nationkey") % 5).orderBy(*pg_order("s_nationkey"))
    return t.supplier.select("s_suppkey", F.dense_rank().over(w).cast("bigint").alias("r"))


@both("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey NULLS LAST) AS r FROM orders")
def win_row_number(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.row_number().over(by_customer()).cast("bigint").alias("r"))


@both("SELECT o_orderkey, round(percent_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderkey NULLS LAST), 6) AS p, round(cume_dist() OVER (PARTITION BY o_custkey ORDER BY o_orderkey NULLS LAST), 6) AS c, ntile(3) OVER (PARTITION BY o_custkey ORDER BY o_orderkey NULLS LAST) AS t FROM orders")
def win_percent_rank(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.round(F.percent_rank().over(by_customer()), 6).alias("p"), F.round(F.cume_dist().over(by_customer()), 6).alias("c"), F.ntile(3).over(by_customer()).cast("bigint").alias("t"))


@both("SELECT o_orderkey, first_value(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderstatus NULLS LAST, o_orderkey NULLS LAST) AS f, last_value(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderstatus NULLS LAST) AS l FROM orders")
def win_first_last(t: Tables) -> DataFrame:
    """The default frame ends with the current row's last peer."""
    w = Window.partitionBy("o_custkey")
    return t.orders.select(
        "o_orderkey", F.first("o_orderkey").over(w.orderBy(*pg_order("o_orderstatus", "o_orderkey"))).alias("f"), F.last("o_orderstatus").over(w.orderBy(*pg_order("o_orderstatus"))).alias("l")
    )


@both("SELECT o_orderkey, lead(o_orderkey, 1, 0) OVER (PARTITION BY o_custkey ORDER BY o_orderkey NULLS LAST) AS nxt, lag(o_orderkey, 1, 0) OVER (PARTITION BY o_custkey ORDER BY o_orderkey NULLS LAST) AS prv FROM orders")
def win_lead_lag(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.lead("o_orderkey", 1, 0).over(by_customer()).alias("nxt"), F.lag("o_orderkey", 1, 0).over(by_customer()).alias("prv"))


@both("SELECT o_orderkey, nth_value(o_orderkey, 2) OVER (PARTITION BY o_custkey ORDER BY o_orderkey NULLS LAST) AS second FROM orders")
def win_nth_value(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.nth_value("o_orderkey", 2).over(by_customer()).alias("second"))


@both("SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey ORDER BY o_orderstatus NULLS LAST RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n FROM orders")
def win_range_frame(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy(*pg_order("o_orderstatus")).rangeBetween(0, Window.unboundedFollowing)
    return t.orders.select("o_orderkey", F.count(F.lit(1)).over(w).alias("n"))


@both("SELECT o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey NULLS LAST ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 2) AS s FROM orders")
def win_rows_frame(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.round(F.sum("o_totalprice").over(by_customer().rowsBetween(-2, 0)), 2).alias("s"))


@both("SELECT c_mktsegment, n, rank() OVER (ORDER BY n DESC NULLS FIRST) AS r FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment) x")
def win_over_agg(t: Tables) -> DataFrame:
    per = t.customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    return per.withColumn("r", F.rank().over(Window.orderBy(*pg_order("-n"))).cast("bigint"))


@both("SELECT n_nationkey, array_to_string(list(n_nationkey) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey DESC NULLS FIRST), ',') AS ks FROM nation")
def win_array_agg(t: Tables) -> DataFrame:
    w = Window.partitionBy("n_regionkey").orderBy(*pg_order("-n_nationkey"))
    return t.nation.select("n_nationkey", F.array_join(F.collect_list(col("n_nationkey").cast("string")).over(w), ",").alias("ks"))
