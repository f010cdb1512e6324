"""Realised loss by grade and expected loss by segment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.operators.joins import join_small


def _net_loss() -> F.Column:
    return F.col("loan_amnt") - F.col("actual_total_pymnt") - F.col("actual_recoveries")


def grade_loss(features: DataFrame) -> DataFrame:
    """PD, net loss, LGD (floored at 0, 0 when a grade has no default) and loss rate."""
    dflt = F.col("is_default") == 1
    loss_all = F.sum(F.when(dflt, _net_loss()).otherwise(F.lit(0.0)))
    return features.groupBy("grade").agg(
        F.count(F.lit(1)).alias("n_loans"),
        F.avg("is_default").alias("pd_observed"),
        F.sum("loan_amnt").alias("disbursed"),
        loss_all.alias("net_loss"),
        F.greatest(F.lit(0.0), F.sum(F.when(dflt, _net_loss()))
                   / F.nullif(F.sum(F.when(dflt, F.col("loan_amnt"))), F.lit(0.0))).alias("lgd"),
        F.try_divide(loss_all, F.sum("loan_amnt")).alias("loss_rate"),
    )


def segment_expected_loss(seg_risk: DataFrame, grades: DataFrame) -> DataFrame:
    """EL = PD x LGD x EAD per segment; inner join on grade (NULL grade drops)."""
    g = grades.select("grade", "lgd")
    j = join_small(seg_risk, g, ["grade"], null_safe=False)
    pd_lgd = F.col("default_rate") * F.col("lgd")
    return j.select(
        "grade", "purpose", "income_decile", "n_loans", "disbursed",
        F.col("default_rate").alias("pd"), "lgd",
        (pd_lgd * F.col("disbursed")).alias("expected_loss"),
        pd_lgd.alias("el_rate"),
        (F.col("avg_rate") / 100.0 - pd_lgd).alias("approx_margin"),
    )
