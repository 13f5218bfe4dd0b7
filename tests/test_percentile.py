import random

import numpy as np
import pytest

from sparkfed.functions import percentile


@pytest.mark.parametrize("accuracy", [10, 100, 10_000])
def test_against_sorting(spark, monkeypatch, accuracy):
    """Groups of many sizes, ties, nulls and a null key; coarse sketches leave much within the bounds, fine ones little."""
    monkeypatch.setattr(percentile, "ACCURACY", accuracy)
    rng = random.Random(accuracy)
    rows = [(None, 1, 3.5), (None, 1, None), ("none", 1, None)]
    for n in [*range(1, 12), 300, 2500]:
        rows += [(f"g{n}", n % 3, rng.choice([rng.gauss(0, 100), float(rng.randint(0, 3))])) for _ in range(n)]
    df = spark.createDataFrame(rows, "k string, j int, x double").repartition(5)
    fractions = {"low": 0.0, "q1": 0.25, "med": 0.5, "p99": 0.99, "top": 1.0}
    got = {(r["k"], r["j"]): [r[f] for f in fractions] for r in percentile.percentile_cont(df, ["k", "j"], "x", fractions).collect()}
    assert len(got) == len({r[:2] for r in rows}) and got["none", 1] == [None] * 5
    for key, found in got.items():
        values = [r[2] for r in rows if r[:2] == key and r[2] is not None]
        if values:
            assert np.allclose(found, [np.percentile(values, 100 * f) for f in fractions.values()])


def test_empty(spark):
    df = spark.createDataFrame([], "k string, x double")
    assert percentile.percentile_cont(df, ["k"], "x", {"med": 0.5}).collect() == []
