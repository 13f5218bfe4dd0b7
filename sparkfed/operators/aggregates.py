"""Aggregation, grouping sets, DISTINCT, ordered-set and hypothetical-set aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.percentile import percentile_cont
from ..functions.rewrite import array_agg, filtered, hypothetical_rank
from ..plans.registry import Tables, both, same_text

col, lit = F.col, F.lit
two = lambda c: F.round(c, 2)


@both("SELECT count(*) AS n, count(l_partkey) AS nc, round(sum(l_quantity), 2) AS s, round(avg(l_discount), 6) AS a, min(l_shipdate)::DATE::VARCHAR AS lo, max(l_shipdate)::DATE::VARCHAR AS hi FROM lineitem")
def agg_global(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count(lit(1)).alias("n"), F.count("l_partkey").alias("nc"), two(F.sum("l_quantity")).alias("s"), F.round(F.avg("l_discount"), 6).alias("a"), F.min("l_shipdate").cast("date").cast("string").alias("lo"), F.max("l_shipdate").cast("date").cast("string").alias("hi"))


@both("SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem GROUP BY l_returnflag, l_linestatus")
def agg_group(t: Tables) -> DataFrame:
    revenue = col("l_extendedprice") * (1 - col("l_discount"))
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count(lit(1)).alias("n"), two(F.sum(revenue)).alias("revenue"))


@both("SELECT p_size % 5 + 20 AS k, count(*) AS n FROM part GROUP BY p_size % 5 + 20")
def agg_group_expr(t: Tables) -> DataFrame:
    return t.part.groupBy((col("p_size") % 5 + 20).alias("k")).agg(F.count(lit(1)).alias("n"))


same_text("agg_group_ordinal", "SELECT p_brand AS b, p_size, count(*) AS n FROM {part} GROUP BY 1, 2")


@both("SELECT 5 AS five, count(*) AS n FROM part GROUP BY 'const'")
def agg_group_constant(t: Tables) -> DataFrame:
    """A constant is no ordinal and no key: it groups everything."""
    return t.part.groupBy(lit("const").alias("k")).agg(F.count(lit(1)).alias("n")).select(lit(5).alias("five"), "n")


@both("SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 15 AND avg(o_totalprice) < 200000 AND sqrt(count(*)) > 3")
def agg_having(t: Tables) -> DataFrame:
    out = t.orders.groupBy("o_custkey").agg(F.count(lit(1)).alias("n"), F.avg("o_totalprice").alias("a"))
    return out.where((col("n") > 15) & (col("a") < 200000) & (F.sqrt("n") > 3)).select("o_custkey", "n")


@both("SELECT p_brand, count(DISTINCT p_size) AS n FROM part GROUP BY p_brand")
def agg_count_distinct(t: Tables) -> DataFrame:
    return t.part.groupBy("p_brand").agg(F.count_distinct("p_size").alias("n"))


@both("SELECT p_brand, sum(DISTINCT p_size)::BIGINT AS s FROM part GROUP BY p_brand")
def agg_sum_distinct(t: Tables) -> DataFrame:
    return t.part.groupBy("p_brand").agg(F.sum_distinct("p_size").alias("s"))


@both("SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'F') AS done, round(sum(o_totalprice) FILTER (WHERE o_totalprice > 100000), 2) AS big FROM orders GROUP BY o_custkey")
def agg_filter(t: Tables) -> DataFrame:
    p = col("o_totalprice")
    return t.orders.groupBy("o_custkey").agg(filtered(F.count, lit(1), col("o_orderstatus") == "F").alias("done"), two(filtered(F.sum, p, p > 100000)).alias("big"))


@both("SELECT n_name, count(*) AS n, round(sum(c_acctbal), 2) AS s FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def agg_over_join(t: Tables) -> DataFrame:
    return t.customer.join(t.nation, col("c_nationkey") == col("n_nationkey")).groupBy("n_name").agg(F.count(lit(1)).alias("n"), two(F.sum("c_acctbal")).alias("s"))


@both("SELECT max(n) AS most, min(n) AS least FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) x")
def agg_nested(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.count(lit(1)).alias("n")).agg(F.max("n").alias("most"), F.min("n").alias("least"))


@both("SELECT p_brand, sum(p_size)::BIGINT * 2 AS twice, max(p_size) - min(p_size) AS span FROM part GROUP BY p_brand")
def agg_expr_over_agg(t: Tables) -> DataFrame:
    s = col("p_size")
    return t.part.groupBy("p_brand").agg((F.sum(s) * 2).alias("twice"), (F.max(s) - F.min(s)).alias("span"))


@both("SELECT n_regionkey, n_nationkey % 3 AS k, count(*) AS n, sum(n_nationkey)::BIGINT AS s FROM nation GROUP BY ROLLUP (n_regionkey, n_nationkey % 3)")
def agg_rollup(t: Tables) -> DataFrame:
    return t.nation.withColumn("k", col("n_nationkey") % 3).rollup("n_regionkey", "k").agg(F.count(lit(1)).alias("n"), F.sum("n_nationkey").alias("s"))


@both("SELECT n_regionkey, n_nationkey % 3 AS k, count(*) AS n FROM nation GROUP BY CUBE (n_regionkey, n_nationkey % 3)")
def agg_cube(t: Tables) -> DataFrame:
    return t.nation.withColumn("k", col("n_nationkey") % 3).cube("n_regionkey", "k").agg(F.count(lit(1)).alias("n"))


same_text("agg_grouping_sets", "SELECT o_orderstatus, o_orderpriority, count(*) AS n, CAST(grouping(o_orderstatus) AS BIGINT) AS g FROM {orders} GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())")


@both("SELECT n_regionkey, 0::BIGINT AS g, count(*) AS n FROM nation GROUP BY n_regionkey")
def agg_grouping_plain(t: Tables) -> DataFrame:
    """grouping() of a plain key is 0; Spark knows the function in grouping sets alone."""
    return t.nation.groupBy("n_regionkey").agg(lit(0).cast("bigint").alias("g"), F.count(lit(1)).alias("n"))


@both("SELECT c_mktsegment, round(percentile_cont(0.5) WITHIN GROUP (ORDER BY c_acctbal), 4) AS med, round(percentile_cont(0.25) WITHIN GROUP (ORDER BY c_acctbal), 4) AS q1 FROM customer GROUP BY c_mktsegment")
def agg_percentile_cont(t: Tables) -> DataFrame:
    found = percentile_cont(t.customer, ["c_mktsegment"], "c_acctbal", {"med": 0.5, "q1": 0.25})
    return found.select("c_mktsegment", F.round("med", 4).alias("med"), F.round("q1", 4).alias("q1"))


@both("SELECT c_mktsegment, (SELECT count(*) FROM customer b WHERE b.c_mktsegment = a.c_mktsegment AND b.c_acctbal < 1234.5) + 1 AS r FROM customer a GROUP BY c_mktsegment")
def agg_hypothetical_rank(t: Tables) -> DataFrame:
    """rank(1234.5) WITHIN GROUP (ORDER BY c_acctbal)."""
    return t.customer.groupBy("c_mktsegment").agg(hypothetical_rank(lit(1234.5), col("c_acctbal")).alias("r"))


@both("SELECT DISTINCT p_brand, p_size FROM part")
def select_distinct(t: Tables) -> DataFrame:
    return t.part.select("p_brand", "p_size").distinct()


@both("SELECT DISTINCT count(*) AS n FROM part GROUP BY p_brand, p_size")
def distinct_over_agg(t: Tables) -> DataFrame:
    return t.part.groupBy("p_brand", "p_size").agg(F.count(lit(1)).alias("n")).select("n").distinct()


@both("SELECT o_orderstatus FROM orders GROUP BY o_orderstatus")
def agg_no_aggregate(t: Tables) -> DataFrame:
    return t.orders.select("o_orderstatus").distinct()


@both("SELECT count(*) AS n FROM nation")
def agg_count_whole_row(t: Tables) -> DataFrame:
    return t.nation.agg(F.count(F.struct("*")).alias("n"))


@both("SELECT n_regionkey, list(CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey END ORDER BY n_nationkey)::VARCHAR AS ks FROM nation GROUP BY n_regionkey")
def agg_array_keeps_nulls(t: Tables) -> DataFrame:
    """array_agg(x ORDER BY k) with nulls kept."""
    pair = F.struct(col("n_nationkey").alias("k"), F.when(col("n_nationkey") % 2 == 0, col("n_nationkey")).alias("v"))
    return t.nation.groupBy("n_regionkey").agg(F.transform(F.array_sort(array_agg(pair)), lambda x: F.coalesce(x["v"].cast("string"), lit("NULL"))).alias("ks")).withColumn("ks", F.concat(lit("["), F.array_join("ks", ", "), lit("]")))


@both("SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name DESC) AS names FROM nation GROUP BY n_regionkey")
def agg_string_ordered(t: Tables) -> DataFrame:
    return t.nation.groupBy("n_regionkey").agg(F.array_join(F.sort_array(F.collect_list("n_name"), asc=False), ",").alias("names"))


@both("SELECT c_mktsegment, round(stddev_samp(c_acctbal), 4) AS sd, round(var_pop(c_acctbal), 2) AS vp, bool_and(c_acctbal > -1000) AS all_, bool_or(c_acctbal > 9990) AS any_ FROM customer GROUP BY c_mktsegment")
def agg_other_builtin(t: Tables) -> DataFrame:
    b = col("c_acctbal")
    return t.customer.groupBy("c_mktsegment").agg(F.round(F.stddev_samp(b), 4).alias("sd"), F.round(F.var_pop(b), 2).alias("vp"), F.bool_and(b > -1000).alias("all_"), F.bool_or(b > 9990).alias("any_"))


@both("SELECT n_regionkey, min(least(n_nationkey, 9 - n_regionkey)) AS lowest FROM nation GROUP BY n_regionkey")
def agg_variadic_least(t: Tables) -> DataFrame:
    """A user's variadic least-of-all aggregate as min over least."""
    return t.nation.groupBy("n_regionkey").agg(F.min(F.least(col("n_nationkey"), 9 - col("n_regionkey"))).alias("lowest"))


@both("""SELECT r_name, (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey AND n_nationkey > r_regionkey) AS n FROM region""")
def agg_correlated_in_select(t: Tables) -> DataFrame:
    """A correlated aggregate in the SELECT list as one join."""
    joined = t.region.join(t.nation, (col("n_regionkey") == col("r_regionkey")) & (col("n_nationkey") > col("r_regionkey")), "left")
    return joined.groupBy("r_regionkey", "r_name").agg(F.count("n_nationkey").alias("n")).select("r_name", "n")
