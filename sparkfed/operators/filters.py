"""Predicates and scalar expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rewrite import int_div, power, round_half_even, trunc
from ..plans.registry import Tables, both, same_text

col, lit = F.col, F.lit


@both("SELECT o_orderkey FROM orders WHERE o_totalprice >= 100000 AND o_totalprice <> 200000 AND o_orderkey <= 10000 OR o_orderkey = 3")
def filter_cmp(t: Tables) -> DataFrame:
    p, k = col("o_totalprice"), col("o_orderkey")
    return t.orders.where(((p >= 100000) & (p != 200000) & (k <= 10000)) | (k == 3)).select("o_orderkey")


@both("SELECT p_partkey FROM part WHERE p_size BETWEEN 5 AND 9")
def filter_between(t: Tables) -> DataFrame:
    return t.part.where(col("p_size").between(5, 9)).select("p_partkey")


@both("SELECT p_partkey, p_size FROM part WHERE p_size IN (1, 7, 49)")
def filter_in_list(t: Tables) -> DataFrame:
    return t.part.where(col("p_size").isin(1, 7, 49)).select("p_partkey", "p_size")


@both("SELECT c_custkey FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
def filter_not_in_list(t: Tables) -> DataFrame:
    return t.customer.where(~col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey")


@both("SELECT p_partkey FROM part WHERE p_type LIKE '%STEEL%' OR p_name LIKE 'a_%'")
def filter_like(t: Tables) -> DataFrame:
    return t.part.where(col("p_type").like("%STEEL%") | col("p_name").like("a_%")).select("p_partkey")


@both("SELECT p_partkey FROM part WHERE p_type NOT LIKE '%S%'")
def filter_not_like(t: Tables) -> DataFrame:
    return t.part.where(~col("p_type").like("%S%")).select("p_partkey")


@both("SELECT n_nationkey, n_name FROM nation WHERE n_name ILIKE '%AN%' AND n_name NOT ILIKE '%Z%'")
def filter_ilike(t: Tables) -> DataFrame:
    return t.nation.where(col("n_name").ilike("%aN%") & ~col("n_name").ilike("%z%")).select("n_nationkey", "n_name")


@both("SELECT c_custkey FROM customer WHERE regexp_matches(c_name, '[13]$') AND NOT regexp_matches(c_name, '(?i)R#0*1')")
def filter_regex(t: Tables) -> DataFrame:
    """The host's ~ and !~*."""
    return t.customer.where(col("c_name").rlike("[13]$") & ~col("c_name").rlike("(?i)R#0*1")).select("c_custkey")


@both("SELECT o_orderkey FROM orders WHERE NOT (o_totalprice > 50000)")
def filter_bool_not(t: Tables) -> DataFrame:
    flagged = t.orders.withColumn("flag", col("o_totalprice") > 50000)
    return flagged.where(~col("flag")).select("o_orderkey")


@both("""SELECT o_orderkey, v IS NULL AS is_null, v IS NOT NULL AS not_null FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS v FROM orders) x WHERE v IS NULL OR v > 400000""")
def filter_is_null(t: Tables) -> DataFrame:
    v = t.orders.select("o_orderkey", F.when(col("o_orderstatus") != "P", col("o_totalprice")).alias("v"))
    return v.where(col("v").isNull() | (col("v") > 400000)).select("o_orderkey", col("v").isNull().alias("is_null"), col("v").isNotNull().alias("not_null"))


@both("""SELECT n_nationkey, a IS DISTINCT FROM 3 AS differs, a IS NOT DISTINCT FROM NULL AS absent FROM (SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN NULL ELSE n_regionkey END AS a FROM nation) x""")
def filter_is_distinct(t: Tables) -> DataFrame:
    a = t.nation.select("n_nationkey", F.when(col("n_regionkey") != 1, col("n_regionkey")).alias("a"))
    return a.select("n_nationkey", (~col("a").eqNullSafe(3)).alias("differs"), col("a").eqNullSafe(lit(None)).alias("absent"))


@both("SELECT p_partkey, p_size % 7 AS rest, p_size // 7 AS whole, p_size + 1 AS plus, p_size - 1 AS minus, p_size * 2 AS times FROM part WHERE p_size % 7 = 3")
def filter_arith_mod(t: Tables) -> DataFrame:
    s = col("p_size")
    return t.part.where(s % 7 == 3).select("p_partkey", (s % 7).alias("rest"), int_div(s, lit(7)).alias("whole"), (s + 1).alias("plus"), (s - 1).alias("minus"), (s * 2).alias("times"))


@both("SELECT c_custkey, upper(c_mktsegment) AS up, length(c_name) AS len FROM customer WHERE lower(c_mktsegment) = 'building' AND abs(c_acctbal) > 5000")
def filter_func(t: Tables) -> DataFrame:
    return t.customer.where((F.lower("c_mktsegment") == "building") & (F.abs("c_acctbal") > 5000)).select("c_custkey", F.upper("c_mktsegment").alias("up"), F.length("c_name").alias("len"))


@both("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1996-02-01'")
def filter_date_range(t: Tables) -> DataFrame:
    d = col("o_orderdate")
    return t.orders.where((d >= lit("1996-01-01").cast("date")) & (d < lit("1996-02-01").cast("date"))).select("o_orderkey", d.cast("date").cast("string").alias("d"))


@both("SELECT count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1997-03-05'")
def filter_date_equal(t: Tables) -> DataFrame:
    return t.orders.where(col("o_orderdate").cast("date") == lit("1997-03-05").cast("date")).agg(F.count(lit(1)).alias("n"))


@both("""SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'big' WHEN o_totalprice > 100000 THEN 'mid' ELSE 'small' END AS size,
coalesce(CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderstatus END, 'none') AS st, nullif(o_orderstatus, 'O') AS no, greatest(o_totalprice, 1000) AS g, least(o_totalprice, 1000) AS l FROM orders""")
def case_coalesce(t: Tables) -> DataFrame:
    p, s = col("o_totalprice"), col("o_orderstatus")
    size = F.when(p > 300000, "big").when(p > 100000, "mid").otherwise("small")
    return t.orders.select(
        "o_orderkey", size.alias("size"), F.coalesce(F.when(s != "F", s), lit("none")).alias("st"),
        F.nullif(s, lit("O")).alias("no"), F.greatest(p, lit(1000)).alias("g"), F.least(p, lit(1000)).alias("l"),
    )


@both("SELECT n_nationkey, n_name || '-' || n_regionkey::VARCHAR AS label, pow(n_regionkey, 2) AS squared, n_regionkey & 1 AS bit, n_regionkey << 2 AS shifted, n_regionkey | 8 AS ored FROM nation")
def operators_other(t: Tables) -> DataFrame:
    """Operators that mean something else, or nothing, in Spark: each has its own mapping."""
    r = col("n_regionkey")
    return t.nation.select(
        "n_nationkey", F.concat("n_name", lit("-"), r.cast("string")).alias("label"), power(r, lit(2)).alias("squared"),
        r.bitwiseAND(1).alias("bit"), F.shiftleft(r, 2).alias("shifted"), r.bitwiseOR(8).alias("ored"),
    )


@both("""SELECT r_regionkey, ([r_name, 'x', 'y'])[1] AS first, array_to_string(([r_name, 'x', 'y'])[2:3], ',') AS rest, len([r_name, 'x']) AS n FROM region""")
def array_constructs(t: Tables) -> DataFrame:
    a = F.array("r_name", lit("x"), lit("y"))
    return t.region.select("r_regionkey", F.element_at(a, 1).alias("first"), F.array_join(F.slice(a, 2, 2), ",").alias("rest"), F.size(F.array("r_name", lit("x"))).cast("bigint").alias("n"))


@both("""SELECT n_nationkey, substr(n_name, 2, 3) AS sub, trim('  ' || n_name || ' ') AS t, replace(n_name, 'A', 'b') AS rep, lpad(n_name, 12, '*') AS lp, rpad(n_name, 12, '-') AS rp,
reverse(n_name) AS rev, ascii(n_name) AS asc_, chr(65 + n_regionkey) AS ch, repeat('ab', n_regionkey) AS rpt, strpos(n_name, 'A') AS pos, split_part(n_name, 'A', 1) AS sp, translate(n_name, 'AE', '12') AS tr,
md5(n_name) AS md, left(n_name, 2) AS le, right(n_name, 2) AS ri, starts_with(n_name, 'A') AS st, ltrim('  x') AS lt, rtrim('x  ') || '.' AS rt, concat(n_name, '!') AS cc FROM nation""")
def functions_string(t: Tables) -> DataFrame:
    n, r = col("n_name"), col("n_regionkey")
    return t.nation.select(
        "n_nationkey", F.substring(n, 2, 3).alias("sub"), F.trim(F.concat(lit("  "), n, lit(" "))).alias("t"), F.replace(n, lit("A"), lit("b")).alias("rep"),
        F.lpad(n, 12, "*").alias("lp"), F.rpad(n, 12, "-").alias("rp"), F.reverse(n).alias("rev"), F.ascii(n).alias("asc_"), F.char(lit(65) + r).alias("ch"),
        F.repeat(lit("ab"), r).alias("rpt"), F.instr(n, "A").cast("bigint").alias("pos"), F.split_part(n, lit("A"), lit(1)).alias("sp"), F.translate(n, "AE", "12").alias("tr"),
        F.md5(n).alias("md"), F.left(n, lit(2)).alias("le"), F.right(n, lit(2)).alias("ri"), F.startswith(n, lit("A")).alias("st"),
        F.ltrim(lit("  x")).alias("lt"), F.concat(F.rtrim(lit("x  ")), lit(".")).alias("rt"), F.concat(n, lit("!")).alias("cc"),
    )


@both("""SELECT c_custkey, abs(c_acctbal) AS a, ceil(c_acctbal)::BIGINT AS c, floor(c_acctbal)::BIGINT AS f, trunc(c_acctbal)::BIGINT AS t, round(sqrt(abs(c_acctbal)), 6) AS sq, round(exp(c_acctbal / 10000), 6) AS e,
round(ln(abs(c_acctbal) + 1), 6) AS ln_, round(log10(abs(c_acctbal) + 1), 6) AS lg, sign(c_acctbal)::INTEGER AS sg, round(degrees(1.0), 6) AS deg, round(radians(c_acctbal), 6) AS rad, round(sin(c_acctbal), 6) AS sn,
round_even(c_custkey / 2.0, 0) AS half_even, mod(c_custkey, 5) AS m FROM customer""")
def functions_math(t: Tables) -> DataFrame:
    b = col("c_acctbal")
    six = lambda c: F.round(c, 6)
    return t.customer.select(
        "c_custkey", F.abs(b).alias("a"), F.ceil(b).alias("c"), F.floor(b).alias("f"), trunc(b).alias("t"), six(F.sqrt(F.abs(b))).alias("sq"), six(F.exp(b / 10000)).alias("e"),
        six(F.log(F.abs(b) + 1)).alias("ln_"), six(F.log10(F.abs(b) + 1)).alias("lg"), F.signum(b).cast("int").alias("sg"), six(F.degrees(lit(1.0))).alias("deg"), six(F.radians(b)).alias("rad"), six(F.sin(b)).alias("sn"),
        round_half_even(col("c_custkey") / lit(2.0)).alias("half_even"), (col("c_custkey") % 5).alias("m"),
    )


def date_functions(orders: DataFrame) -> DataFrame:
    d = col("o_orderdate")
    day = d.cast("date")
    return orders.select(
        "o_orderkey", F.year(d).cast("bigint").alias("y"), F.month(d).cast("bigint").alias("m"), F.day(d).cast("bigint").alias("d"), F.quarter(d).cast("bigint").alias("q"),
        F.date_trunc("month", d).cast("date").cast("string").alias("mon"), F.date_add(day, 10).cast("string").alias("later"), F.date_sub(day, 10).cast("string").alias("sooner"), F.make_date(F.year(d), lit(1), lit(1)).cast("string").alias("jan"),
    )


@both("""SELECT o_orderkey, extract(year FROM o_orderdate) AS y, extract(month FROM o_orderdate) AS m, extract(day FROM o_orderdate) AS d, extract(quarter FROM o_orderdate) AS q,
CAST(date_trunc('month', o_orderdate) AS DATE)::VARCHAR AS mon, CAST(CAST(o_orderdate AS DATE) + 10 AS DATE)::VARCHAR AS later, CAST(CAST(o_orderdate AS DATE) - 10 AS DATE)::VARCHAR AS sooner, make_date(extract(year FROM o_orderdate)::INT, 1, 1)::VARCHAR AS jan FROM orders""")
def functions_date(t: Tables) -> DataFrame:
    return date_functions(t.orders)


same_text(
    "coercion_cast",
    """SELECT o_orderkey, CAST(o_orderkey AS STRING) AS as_text, CAST(CAST(o_orderkey AS STRING) AS INT) AS back, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day_text,
CAST(CAST('1980-12-17' AS DATE) AS STRING) AS d, CAST(true AS INT) AS one, CAST(round(o_totalprice, 0) AS BIGINT) AS whole, CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS STRING) AS dec FROM {orders}""",
)
