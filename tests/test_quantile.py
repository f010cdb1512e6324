"""Exact quantiles by radix selection against Spark's exact percentile."""

import random

import pytest
from pyspark.sql import functions as F

from lendlens.operators.quantile import exact_quantiles, quantile_table


@pytest.mark.parametrize("q", [0.5, 0.8, 0.0, 1.0])
def test_matches_percentile(spark, q):
    rnd = random.Random(3)
    rows = []
    for i in range(20000):
        rows.append((rnd.random() * 1e6,                       # continuous: forces bracketing
                     float(rnd.randint(0, 5)),                  # few values
                     None if rnd.random() < 0.2 else rnd.gauss(0, 1),
                     float("nan") if rnd.random() < 0.1 else 7.0,  # one value + NaN
                     50.0 if rnd.random() < 0.4 else rnd.random()))  # hot value
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    cols = ["a", "b", "c", "d", "e"]
    ours = exact_quantiles(df, cols, q, buckets=16)
    ref = df.agg(*[F.percentile(F.when(~F.isnan(c), F.col(c)), q).alias(c) for c in cols]).first()
    for c in cols:
        assert ours[c] == pytest.approx(ref[c], rel=1e-12, abs=1e-12), c


def test_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "a double")
    assert exact_quantiles(df, ["a"]) == {"a": None}


def test_single_value_and_single_row(spark):
    df = spark.createDataFrame([(7.0,)] * 50 + [(None,)] * 3, "a double")
    assert exact_quantiles(df, ["a"], 0.5) == {"a": 7.0}
    one = spark.createDataFrame([(3.5,)], "a double")
    assert exact_quantiles(one, ["a"], 0.8) == {"a": 3.5}


def test_extreme_values(spark):
    """Signs, zeros, denormals, infinities, neighbouring doubles; several quantiles at once."""
    import math
    import sys
    up = [1.0]
    for _ in range(40):
        up.append(math.nextafter(up[-1], 2.0))
    rows = up * 2 + [-x for x in up] + [0.0, -0.0, 5e-324, -5e-324, sys.float_info.max, -sys.float_info.max, 1e-308, float("inf"), float("-inf")]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(x,) for x in rows] + [(None,), (float("nan"),)], "a double").repartition(3)
    want = sorted(rows)
    qs = [k / (len(rows) - 1) for k in range(0, len(rows), 5)]
    got = quantile_table(df, ["a"], qs, buckets=8)["a"]
    for q, g in zip(qs, got):
        pos = q * (len(rows) - 1)
        lo, hi = want[math.floor(pos)], want[min(math.floor(pos) + 1, len(rows) - 1)]
        assert g == (lo if lo == hi or pos == math.floor(pos) else lo + (hi - lo) * (pos - math.floor(pos)))


def test_passes_are_bounded(spark, monkeypatch):
    """Spread-out doubles need at most three passes after the first."""
    from lendlens.operators import quantile
    passes = []
    real = quantile._hits
    monkeypatch.setattr(quantile, "_hits", lambda *a: passes.append(1) or real(*a))
    df = spark.range(50000).select((F.exp(F.rand(5) * 40 - 20) * 1.7).alias("a"), (F.rand(6) * 1e-9 + 1).alias("b"))
    got = exact_quantiles(df, ["a", "b"], 0.5)
    ref = df.agg(F.percentile("a", 0.5), F.percentile("b", 0.5)).first()
    assert got == {"a": pytest.approx(ref[0], rel=1e-15), "b": pytest.approx(ref[1], rel=1e-15)} and len(passes) <= 4
