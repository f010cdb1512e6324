"""Modelling plumbing and the dashboard exports on the sf0.001 fixture."""

import os

from pyspark.sql import functions as F

from paths import SF001
from lendlens.plans import export, loss, segments, vintage
from lendlens.plans.book import book


def test_models(spark):
    b = book(spark, SF001)
    r = b.models(gbt_iter=5, folds=3, lr_iter=50)
    m = r.metrics.collect()
    assert [x["model"] for x in m] == ["logistic_baseline", "gradient_boosting"]
    assert sum(x["is_champion"] for x in m) <= 1
    for x in m:
        assert 0.0 <= x["auc"] <= 1.0 and abs(x["gini"] - (2 * x["auc"] - 1)) < 1e-12
    s = r.scores
    assert s.columns == ["loan_amnt", "int_rate", "grade", "purpose", "is_default", "pd_hat"]
    assert s.filter((F.col("pd_hat") < 0) | (F.col("pd_hat") > 1)).count() == 0


def test_export_star(spark, tmp_path):
    f = book(spark, SF001).features
    seg = segments.segment_risk(f, min_loans=20)
    g = loss.grade_loss(f)
    paths = export.export_star(str(tmp_path), f, seg, vintage.vintage_curves(f), g,
                               loss.segment_expected_loss(seg, g))
    assert spark.read.parquet(paths["fact_loans"]).count() == f.count()
    assert len(spark.read.parquet(paths["fact_loans"]).columns) == 18
    csv = [p for p in os.listdir(paths["grade_loss_csv"]) if p.endswith(".csv")]
    assert len(csv) == 1
    assert spark.read.option("header", True).csv(paths["grade_loss_csv"]).count() == g.count()


def test_sample_is_top_n_by_hash(spark):
    from lendlens.plans.reports import sample_loans
    f = book(spark, SF001).features
    n = 500
    got = [r["loan_id"] for r in sample_loans(f, n=n).collect()]
    ref = [r["loan_id"] for r in f.select("loan_id", F.md5(F.concat("loan_id", F.lit("42"))).alias("k"))
           .orderBy("k", "loan_id").limit(n).collect()]
    assert got == ref


def test_isotonic_on_aggregates_equals_raw(spark):
    """Fitting isotonic regression on (score, weight, mean label) per distinct
    score gives the same map as fitting on the raw rows."""
    import random
    from pyspark.ml.regression import IsotonicRegression
    rnd = random.Random(3)
    rows = [(float(rnd.randint(0, 30)) / 30, float(rnd.random() < 0.3 + 0.01 * i % 7)) for i in range(600)]
    raw = spark.createDataFrame(rows, "s double, y double")
    agg = raw.groupBy("s").agg(F.count(F.lit(1)).cast("double").alias("w"), F.avg("y").alias("y"))
    m1 = IsotonicRegression(featuresCol="s", labelCol="y").fit(raw)
    m2 = IsotonicRegression(featuresCol="s", labelCol="y", weightCol="w").fit(agg)
    grid = spark.createDataFrame([(i / 60,) for i in range(-3, 64)], "s double")
    p1 = [r["prediction"] for r in m1.transform(grid).orderBy("s").collect()]
    p2 = [r["prediction"] for r in m2.transform(grid).orderBy("s").collect()]
    assert all(abs(a - b) < 1e-12 for a, b in zip(p1, p2))


def test_best_rounds_patience():
    from lendlens.plans.model import _best_rounds

    class Fake:
        def __init__(self, losses):
            self.losses = losses

        def evaluateEachIteration(self, _):
            return self.losses

    assert _best_rounds(Fake([5, 4, 3, 3.5, 3.6, 2.9, 3.0]), None) == 6          # later improvement kept
    flat = [1.0, 0.9] + [0.95] * 10 + [0.1]                                  # 10 rounds without gain stop
    assert _best_rounds(Fake(flat), None) == 2
    assert _best_rounds(Fake([3.0]), None) == 1
