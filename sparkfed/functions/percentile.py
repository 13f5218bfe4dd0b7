"""Exact percentiles of groups of any size."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranks that the sketch gives are right within rows / ACCURACY.
ACCURACY = 10_000


def percentile_cont(df: DataFrame, keys: list[str], value: str, fractions: Mapping[str, float]) -> DataFrame:
    """percentile_cont(f) WITHIN GROUP (ORDER BY value) for each name and f, as doubles; nulls do not count, a group
    without values has nulls, and null keys are a group.

    Spark's own function holds all of a group's distinct values in one buffer. Here a sketch bounds the two values that a
    fraction lies between, partial counts say how many rows come before, and only the distinct values within the
    bounds, about 4 / ACCURACY of the rows, are put in order."""
    rows = df.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col(value).cast("double").alias("_v"))
    by, v = [f"_k{i}" for i in range(len(keys))], F.col("_v")
    margin = 2 / ACCURACY
    wanted = [q for f in fractions.values() for q in (max(0.0, f - margin), min(1.0, f + margin))]
    bounds = rows.groupBy(*by).agg(F.count("_v").alias("_n"), F.percentile_approx("_v", wanted, ACCURACY).alias("_q"))

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.select(*(F.col(k).alias(f"_r{k}") for k in by), *(c for c in right.columns if c not in by))
        on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_r{k}")) for k in by), F.lit(True))
        return left.join(right, on).drop(*(f"_r{k}" for k in by))

    near = beside(rows.where(v.isNotNull()), bounds)
    low, high = (lambda i: F.col("_q")[2 * i]), (lambda i: F.col("_q")[2 * i + 1])
    each = range(len(fractions))
    around = near.groupBy(*by).agg(
        *(F.count_if(v < low(i)).alias(f"_before{i}") for i in each),
        *(F.max(F.when(v < low(i), v)).alias(f"_prev{i}") for i in each),
        *(F.min(F.when(v > high(i), v)).alias(f"_next{i}") for i in each),
    )
    within = [v.between(low(i), high(i)) for i in each]
    flags = [F.first(w).alias(f"_in{i}") for i, w in zip(each, within)]
    distinct = near.where(reduce(lambda a, b: a | b, within)).groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_c"), *flags)
    upto = Window.partitionBy(*by).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    running = distinct.select(*by, "_v", *(F.sum(F.when(F.col(f"_in{i}"), F.col("_c")).otherwise(0)).over(upto).alias(f"_sum{i}") for i in each))
    ranked = beside(running, beside(bounds.select(*by, "_n"), around))

    def at(i: int, rank: Column) -> tuple[Column, Column]:
        """The value of a rank from 0: within the bounds, or just beside them."""
        inside = F.min(F.when(F.col(f"_before{i}") + F.col(f"_sum{i}") > rank, v))
        return F.first(F.when(rank < F.col(f"_before{i}"), F.col(f"_prev{i}"))), F.coalesce(inside, F.first(f"_next{i}"))

    out = []
    for i, (name, f) in enumerate(fractions.items()):
        place = F.lit(float(f)) * (F.col("_n") - 1)
        below, above = (F.coalesce(*at(i, rank)) for rank in (F.floor(place), F.ceil(place)))
        out.append((below + (above - below) * F.first(place - F.floor(place))).alias(name))
    found = ranked.groupBy(*by).agg(*out)
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_r{k}")) for k in by), F.lit(True))
    found = found.select(*(F.col(k).alias(f"_r{k}") for k in by), *fractions)
    return bounds.select(*by).join(found, on, "left").select(*(F.col(k).alias(n) for k, n in zip(by, keys)), *fractions)
