"""Host constructs that Spark lacks or reads differently, built from column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def int_div(a: Column, b: Column) -> Column:
    """Integer division that truncates toward zero and stays a whole number."""
    return F.call_function("div", a, b)


def hypothetical_rank(value: Column, of: Column) -> Column:
    """rank(value) WITHIN GROUP (ORDER BY of): an aggregate; nulls sort last, so they never come before a value."""
    return (F.lit(1) + F.coalesce(F.sum(F.when(of < value, 1).otherwise(0)), F.lit(0))).cast("bigint")


def hypothetical_dense_rank(value: Column, of: Column) -> Column:
    return (F.lit(1) + F.count_distinct(F.when(of < value, of))).cast("bigint")


def array_agg(c: Column) -> Column:
    """array_agg that keeps nulls, which collect_list drops."""
    return F.transform(F.collect_list(F.struct(c.alias("v"))), lambda x: x["v"])


def filtered(agg, c: Column, condition: Column) -> Column:
    """agg(c) FILTER (WHERE condition)."""
    return agg(F.when(condition, c))


def whole_row(df: DataFrame, name: str) -> DataFrame:
    """df with its row as one struct column `name`. Built before an outer join, the struct is null where the row is absent."""
    return df.withColumn(name, F.struct(*df.columns))


def power(a: Column, b: Column) -> Column:
    """The host's ^, which Spark reads as XOR."""
    return F.pow(a, b)


def trunc(c: Column) -> Column:
    """Numeric truncation toward zero; Spark's trunc is for dates."""
    return F.when(c < 0, F.ceil(c)).otherwise(F.floor(c))


def strpos(text: Column, part: Column) -> Column:
    return F.locate(part, text) if isinstance(part, str) else F.call_function("position", part, text)


def regexp_replace_first(text: Column, pattern: str, to: str) -> Column:
    """The host's regexp_replace without flags: the first match only."""
    return F.regexp_replace(text, rf"(?s)^(.*?)(?:{pattern})(.*)$", f"$1{to}$2")


def regexp_replace_column(text: Column, pattern: Column, to: Column) -> Column:
    """The same with a pattern of columns; groups of the pattern keep their numbers' order."""
    whole = F.concat(F.lit("(?s)^(?<sparkfedpre>.*?)(?:"), pattern, F.lit(")(?<sparkfedpost>.*)$"))
    return F.call_function("regexp_replace", text, whole, F.concat(F.lit("${sparkfedpre}"), to, F.lit("${sparkfedpost}")))


def not_in(rows: DataFrame, key: Column, of: DataFrame, value: Column) -> DataFrame:
    """rows WHERE key NOT IN (SELECT value FROM of): all rows if `of` has none; none if it holds a null; else those with
    a key that is not null and not found. An ordinary anti join on distinct values, and two counts."""
    counts = of.agg(F.count(F.lit(1)).alias("n"), F.count(value).alias("known"))
    n, known = counts.select("n").scalar(), counts.select("known").scalar()
    left = rows.join(of.select(value.alias("__sparkfed_v")).where("__sparkfed_v is not null").distinct(), key == F.col("__sparkfed_v"), "left_anti")
    return left.where((n == 0) | ((n == known) & key.isNotNull()))


def log10(c: Column) -> Column:
    """The host's log of one argument has base 10."""
    return F.log10(c)


def round_half_even(c: Column, digits: int = 0) -> Column:
    """The host's round of a double goes to the even neighbour."""
    return F.bround(c, digits)
