"""Exact ranking and calibration metrics of a score column."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exact_auc(df: DataFrame, score: str, label: str, classes: tuple[int, int] | None = None) -> float | None:
    """Area under ROC with ties counted half (rank-sum AUC); None when one
    class is absent (undefined; Spark's evaluator would report 0.0).

    ``numBins=0`` keeps every distinct score (the default 1000 down-samples
    the curve).  The evaluator counts per distinct score, range-sorts those
    counts across the cluster and integrates; only the number returns.
    ``classes`` = (positives, negatives) when already counted.
    """
    if classes is None:
        r = df.agg(F.count(F.when(F.col(label) == 1, 1)).alias("p"),
                   F.count(F.when(F.col(label) == 0, 1)).alias("n")).first()
        classes = (r["p"], r["n"])
    if min(classes) == 0:
        return None
    data = df.select(F.col(score).cast("double").alias("s"), F.col(label).cast("double").alias("y"))
    ev = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y",
                                       metricName="areaUnderROC", numBins=0)
    return ev.evaluate(data)


def score_metrics(df: DataFrame, score: str, label: str, model: str = "score") -> DataFrame:
    """One row: model, n, AUC, Gini = 2 AUC - 1, Brier = mean (p - y)^2.

    Rows with a NULL score are left out.
    """
    scored = df.filter(F.col(score).isNotNull())
    agg = scored.agg(F.count(F.lit(1)).alias("n"),
                     F.avg((F.col(score) - F.col(label)) ** 2).alias("brier"),
                     F.count(F.when(F.col(label) == 1, 1)).alias("pos"),
                     F.count(F.when(F.col(label) == 0, 1)).alias("neg")).first()
    auc = exact_auc(scored, score, label, (agg["pos"], agg["neg"]))
    spark = df.sparkSession
    gini = None if auc is None else 2 * auc - 1
    return spark.createDataFrame([(model, agg["n"], auc, gini, agg["brier"])],
                                 "model string, n bigint, auc double, gini double, brier double")
