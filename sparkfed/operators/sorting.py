"""ORDER BY, LIMIT, OFFSET, top-k."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.limits import limit_offset
from ..functions.order import asc, desc, pg_order
from ..plans.registry import Tables, both, same_text

col = F.col
NULLED = "SELECT n_nationkey, CASE WHEN n_regionkey = 2 THEN NULL ELSE n_regionkey END AS k FROM nation"


def first_and_all(sql: str, n: int) -> Callable:
    """Registers a sort twice: its first n rows under the function's name, as the SQL's LIMIT says, and all rows under name_all."""

    def put(f: Callable[[Tables], DataFrame]) -> Callable:
        def some(t: Tables) -> DataFrame:
            return f(t).limit(n)

        def whole(t: Tables) -> DataFrame:
            return f(t)

        some.__name__, whole.__name__ = f.__name__, f"{f.__name__}_all"
        both(sql)(some)
        both(sql.removesuffix(f" LIMIT {n}"))(whole)
        return f

    return put


def nulled(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", F.when(col("n_regionkey") != 2, col("n_regionkey")).alias("k"))


@first_and_all(f"SELECT * FROM ({NULLED}) x ORDER BY k ASC NULLS LAST, n_nationkey ASC NULLS LAST LIMIT 22", 22)
def sort_nulls(t: Tables) -> DataFrame:
    return nulled(t).orderBy(*pg_order("k", "n_nationkey"))


@first_and_all(f"SELECT * FROM ({NULLED}) x ORDER BY k DESC NULLS FIRST, n_nationkey ASC NULLS LAST LIMIT 7", 7)
def sort_nulls_desc(t: Tables) -> DataFrame:
    return nulled(t).orderBy(*pg_order("-k", "n_nationkey"))


@first_and_all(f"SELECT * FROM ({NULLED}) x ORDER BY k ASC NULLS FIRST, n_nationkey DESC NULLS LAST LIMIT 7", 7)
def sort_nulls_explicit(t: Tables) -> DataFrame:
    return nulled(t).orderBy(col("k").asc_nulls_first(), col("n_nationkey").desc_nulls_last())


@first_and_all("SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderstatus DESC NULLS FIRST, o_totalprice ASC NULLS LAST, o_orderkey ASC NULLS LAST LIMIT 50", 50)
def sort_multi(t: Tables) -> DataFrame:
    return t.orders.orderBy(*pg_order("-o_orderstatus", "o_totalprice", "o_orderkey")).select("o_orderkey", "o_orderstatus")


@first_and_all("SELECT p_partkey FROM part ORDER BY p_size * 3 - p_partkey DESC NULLS FIRST, p_partkey ASC NULLS LAST LIMIT 20", 20)
def sort_expr(t: Tables) -> DataFrame:
    return t.part.orderBy(desc(col("p_size") * 3 - col("p_partkey")), asc(col("p_partkey"))).select("p_partkey")


@first_and_all("SELECT c_custkey FROM customer ORDER BY floor(c_acctbal / 100) NULLS LAST, c_custkey NULLS LAST LIMIT 20", 20)
def sort_func(t: Tables) -> DataFrame:
    return t.customer.orderBy(asc(F.floor(col("c_acctbal") / 100)), asc(col("c_custkey"))).select("c_custkey")


same_text("sort_ordinal", "SELECT n_name AS name, n_regionkey FROM {nation} ORDER BY 2 DESC NULLS FIRST, name ASC NULLS LAST LIMIT 9")
same_text("sort_ordinal_all", "SELECT n_name AS name, n_regionkey FROM {nation} ORDER BY 2 DESC NULLS FIRST, name ASC NULLS LAST")


@first_and_all("SELECT n_nationkey FROM nation ORDER BY n_regionkey NULLS LAST, n_name NULLS LAST, n_nationkey NULLS LAST LIMIT 8", 8)
def sort_whole_row(t: Tables) -> DataFrame:
    return t.nation.orderBy(asc(F.struct("n_regionkey", "n_name", "n_nationkey"))).select("n_nationkey")


@first_and_all("SELECT n_nationkey FROM nation ORDER BY abs(n_nationkey - 10) NULLS LAST, n_nationkey NULLS LAST LIMIT 6", 6)
def sort_using_mapped_key(t: Tables) -> DataFrame:
    """ORDER BY ... USING a user's operator, as a key mapped to the operator's order."""
    return t.nation.orderBy(asc(F.abs(col("n_nationkey") - 10)), asc(col("n_nationkey"))).select("n_nationkey")


@both("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS FIRST, o_orderkey NULLS LAST LIMIT 10")
def topk(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(*pg_order("-o_totalprice", "o_orderkey")).limit(10)


@both("SELECT o_orderkey FROM orders ORDER BY o_orderkey NULLS LAST LIMIT 5 OFFSET 7")
def limit_offset_(t: Tables) -> DataFrame:
    return limit_offset(t.orders.select("o_orderkey").orderBy(*pg_order("o_orderkey")), "5", 7)


@both("SELECT n_nationkey FROM nation ORDER BY n_nationkey NULLS LAST OFFSET 20")
def offset_only(t: Tables) -> DataFrame:
    return limit_offset(t.nation.select("n_nationkey").orderBy(*pg_order("n_nationkey")), "ALL", 20)


@both("SELECT n_nationkey FROM nation LIMIT 0")
def limit_zero(t: Tables) -> DataFrame:
    return limit_offset(t.nation.select("n_nationkey"), 0)


@both("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC NULLS FIRST, o_custkey NULLS LAST LIMIT 5")
def sort_above_group(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).orderBy(*pg_order("-n", "o_custkey")).limit(5)
