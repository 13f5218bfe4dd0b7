"""NOT IN over rewritten anti joins, against the host's own."""

import itertools

import pytest
from pyspark.sql import functions as F

from sparkfed.functions.rewrite import not_in


@pytest.mark.parametrize("left,right", list(itertools.product([[1, 2, None], []], [[], [2, 3], [2, None], [None]])))
def test_not_in(spark, left, right):
    a, b = spark.createDataFrame([(x,) for x in left], "k int"), spark.createDataFrame([(x,) for x in right], "v int")
    got = not_in(a, F.col("k"), b, F.col("v"))
    want = spark.sql("SELECT k FROM {a} WHERE k NOT IN (SELECT v FROM {b})", a=a, b=b)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "BroadcastNestedLoopJoin" not in got._jdf.queryExecution().executedPlan().toString()
