"""Joins. Physical algorithms are the optimiser's choice; nothing is hinted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rewrite import not_in
from ..plans.registry import Tables, both, same_text

col = F.col


@both("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_totalprice > 200000")
def join_inner(t: Tables) -> DataFrame:
    return t.orders.where("o_totalprice > 200000").join(t.customer, col("o_custkey") == col("c_custkey")).select("o_orderkey", "c_name")


@both("SELECT s_suppkey, n_name FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey = 1) n ON s_nationkey = n_nationkey")
def join_left(t: Tables) -> DataFrame:
    return t.supplier.join(t.nation.where("n_regionkey = 1"), col("s_nationkey") == col("n_nationkey"), "left").select("s_suppkey", "n_name")


@both("SELECT s_suppkey, n_name FROM (SELECT * FROM supplier WHERE s_acctbal > 5000) s RIGHT JOIN nation ON s_nationkey = n_nationkey")
def join_right(t: Tables) -> DataFrame:
    return t.supplier.where("s_acctbal > 5000").join(t.nation, col("s_nationkey") == col("n_nationkey"), "right").select("s_suppkey", "n_name")


@both("""SELECT a.n_nationkey AS a, b.s_suppkey AS b FROM (SELECT * FROM nation WHERE n_nationkey > 5) a FULL JOIN (SELECT * FROM supplier WHERE s_nationkey < 15) b ON a.n_nationkey = b.s_nationkey""")
def join_full_filtered(t: Tables) -> DataFrame:
    """Filters of a full join's sides belong below it."""
    a, b = t.nation.where("n_nationkey > 5"), t.supplier.where("s_nationkey < 15")
    return a.join(b, col("n_nationkey") == col("s_nationkey"), "full").select(col("n_nationkey").alias("a"), col("s_suppkey").alias("b"))


same_text("join_full_on_true", "SELECT r_name, n_name FROM (SELECT * FROM {region} WHERE r_regionkey > 2) r FULL JOIN (SELECT * FROM {nation} WHERE n_nationkey < 3) n ON TRUE")


@both("SELECT r_name, s_name FROM region, supplier WHERE s_suppkey < 20")
def join_cross(t: Tables) -> DataFrame:
    return t.region.crossJoin(t.supplier.where("s_suppkey < 20")).select("r_name", "s_name")


@both("SELECT a.n_name AS a, b.n_name AS b FROM nation a JOIN nation b ON a.n_nationkey < b.n_nationkey AND a.n_regionkey <> b.n_regionkey")
def join_theta(t: Tables) -> DataFrame:
    a, b = t.nation.alias("a"), t.nation.alias("b")
    on = (col("a.n_nationkey") < col("b.n_nationkey")) & (col("a.n_regionkey") != col("b.n_regionkey"))
    return a.join(b, on).select(col("a.n_name").alias("a"), col("b.n_name").alias("b"))


@both("""SELECT r_name, n_name, s_name, c_name FROM region JOIN nation ON r_regionkey = n_regionkey JOIN supplier ON s_nationkey = n_nationkey JOIN customer ON c_nationkey = n_nationkey WHERE c_acctbal > 9000 AND s_acctbal > 5000""")
def join_multiway(t: Tables) -> DataFrame:
    s, c = t.supplier.where("s_acctbal > 5000"), t.customer.where("c_acctbal > 9000")
    out = t.region.join(t.nation, col("r_regionkey") == col("n_regionkey")).join(s, col("s_nationkey") == col("n_nationkey"))
    return out.join(c, col("c_nationkey") == col("n_nationkey")).select("r_name", "n_name", "s_name", "c_name")


@both("SELECT s_name, n_name, r_name FROM supplier LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey AND r_regionkey > 1) ON s_nationkey = n_nationkey")
def join_bushy(t: Tables) -> DataFrame:
    inner = t.nation.join(t.region.where("r_regionkey > 1"), col("n_regionkey") == col("r_regionkey"))
    return t.supplier.join(inner, col("s_nationkey") == col("n_nationkey"), "left").select("s_name", "n_name", "r_name")


@both("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 350000)")
def join_semi_exists(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.where("o_totalprice > 350000"), col("o_custkey") == col("c_custkey"), "left_semi").select("c_custkey")


@both("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 350000)")
def join_anti_not_exists(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.where("o_totalprice > 350000"), col("o_custkey") == col("c_custkey"), "left_anti").select("c_custkey")


@both("SELECT n_nationkey FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000)")
def join_not_in(t: Tables) -> DataFrame:
    return not_in(t.nation.select("n_nationkey"), col("n_nationkey"), t.supplier.where("s_acctbal > 8000"), col("s_nationkey"))


@both("SELECT n_nationkey FROM nation WHERE n_nationkey NOT IN (SELECT CASE WHEN s_acctbal > 8000 THEN NULL ELSE s_nationkey END FROM supplier)")
def join_not_in_nulls(t: Tables) -> DataFrame:
    return not_in(t.nation.select("n_nationkey"), col("n_nationkey"), t.supplier, F.when(~(col("s_acctbal") > 8000), col("s_nationkey")))


@both("SELECT n_nationkey FROM nation WHERE n_nationkey <> ALL (SELECT s_nationkey FROM supplier WHERE s_acctbal > 7000)")
def subquery_all(t: Tables) -> DataFrame:
    return not_in(t.nation.select("n_nationkey"), col("n_nationkey"), t.supplier.where("s_acctbal > 7000"), col("s_nationkey"))


same_text(
    "subquery_any",
    "SELECT n_nationkey FROM {nation} WHERE n_nationkey IN (SELECT s_nationkey FROM {supplier} WHERE s_acctbal > 7000)",
    "SELECT n_nationkey FROM nation WHERE n_nationkey = ANY (SELECT s_nationkey FROM supplier WHERE s_acctbal > 7000)",
)


def labelled(t: Tables, orders: DataFrame) -> DataFrame:
    local = t.spark.createDataFrame([("F", "done"), ("O", "open")], "code string, label string")
    return orders.join(local, col("o_orderstatus") == col("code")).select("o_orderkey", "label")


@both("SELECT o_orderkey, label FROM orders JOIN (VALUES ('F', 'done'), ('O', 'open')) v(code, label) ON o_orderstatus = code")
def join_local_table(t: Tables) -> DataFrame:
    return labelled(t, t.orders)


@both("SELECT o_orderkey, n_name, label FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN (VALUES (0, 'zero'), (1, 'one')) v(k, label) ON n_regionkey = k WHERE o_totalprice > 300000")
def join_mixed_local(t: Tables) -> DataFrame:
    local = t.spark.createDataFrame([(0, "zero"), (1, "one")], "k int, label string")
    out = t.orders.where("o_totalprice > 300000").join(t.customer, col("o_custkey") == col("c_custkey")).join(t.nation, col("c_nationkey") == col("n_nationkey"))
    return out.join(local, col("n_regionkey") == col("k")).select("o_orderkey", "n_name", "label")


@both("SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey")
def join_self(t: Tables) -> DataFrame:
    a, b = t.supplier.alias("a"), t.supplier.alias("b")
    on = (col("a.s_nationkey") == col("b.s_nationkey")) & (col("a.s_suppkey") < col("b.s_suppkey"))
    return a.join(b, on).select(col("a.s_suppkey").alias("a"), col("b.s_suppkey").alias("b"))


same_text("join_lateral_inner", "SELECT n_name, x.n FROM {nation}, LATERAL (SELECT count(*) AS n FROM {supplier} WHERE s_nationkey = n_nationkey) x WHERE x.n > 0")
same_text("join_lateral_left", "SELECT n_name, x.best FROM {nation} LEFT JOIN LATERAL (SELECT max(s_acctbal) AS best FROM {supplier} WHERE s_nationkey = n_nationkey AND s_acctbal > 5000) x ON TRUE")


@both("SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 380000 WHERE c_acctbal > 9000")
def join_nullable_side_cond(t: Tables) -> DataFrame:
    """The nullable side's condition stays in ON; the outer filter stays above."""
    on = (col("o_custkey") == col("c_custkey")) & (col("o_totalprice") > 380000)
    return t.customer.join(t.orders, on, "left").where("c_acctbal > 9000").select("c_custkey", "o_orderkey")


@both("SELECT c_custkey, total FROM customer JOIN (SELECT o_custkey, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey) x ON c_custkey = o_custkey WHERE total > 900000")
def join_subquery(t: Tables) -> DataFrame:
    per = t.orders.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total")).where("total > 900000")
    return t.customer.join(per, col("c_custkey") == col("o_custkey")).select("c_custkey", "total")


@both("SELECT n.n_nationkey, s.k IS NULL AS absent FROM nation n LEFT JOIN (SELECT s_nationkey AS k FROM supplier WHERE s_acctbal > 9000) s ON n.n_nationkey = s.k")
def join_whole_row_nullable(t: Tables) -> DataFrame:
    s = t.supplier.where("s_acctbal > 9000").select(F.struct("*").alias("s"))
    return t.nation.join(s, col("n_nationkey") == col("s.s_nationkey"), "left").select("n_nationkey", col("s").isNull().alias("absent"))
