"""Default risk by grade x purpose x income decile, with lift over the book."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlens.functions.numeric import round_half_away

SEGMENT_KEYS = ("grade", "purpose", "income_decile")


def segment_base(features: DataFrame) -> DataFrame:
    """A2/A3: one row per segment, before the volume floor.

    Carries ``n_defaults`` so the book rate can be rebuilt from the segments
    without a second scan of the loan table.
    """
    return features.groupBy(*SEGMENT_KEYS).agg(
        F.count(F.lit(1)).alias("n_loans"),
        F.sum("loan_amnt").alias("disbursed"),
        F.avg("is_default").alias("default_rate"),
        F.avg("fico").alias("avg_fico"),
        F.avg("int_rate").alias("avg_rate"),
        F.sum(F.when(F.col("is_default") == 1, F.col("loan_amnt"))).alias("defaulted_amount"),
        F.sum("is_default").cast("bigint").alias("n_defaults"),
    )


def segment_risk(features: DataFrame, min_loans: int = 200) -> DataFrame:
    """Segments with at least ``min_loans`` loans, lift and rank by default rate.

    The book rate is the loan-weighted rate over all loans, including those of
    suppressed segments; the rank is taken after the floor.  Both windows run
    over the aggregate (a few hundred rows), not over loans.
    """
    seg = segment_base(features)
    book = Window.partitionBy()
    with_book = seg.withColumn(
        "__book_rate",
        F.sum("n_defaults").over(book).cast("double") / F.sum("n_loans").over(book).cast("double"))
    kept = with_book.filter(F.col("n_loans") >= min_loans)
    return (kept
            .withColumn("lift_vs_book", F.col("default_rate") / F.nullif(F.col("__book_rate"), F.lit(0.0)))
            .withColumn("risk_rank", F.rank().over(Window.orderBy(F.col("default_rate").desc_nulls_last()))
                        .cast("bigint"))
            .select(*SEGMENT_KEYS, "n_loans", "disbursed", "default_rate", "avg_fico", "avg_rate",
                    "defaulted_amount", "lift_vs_book", "risk_rank"))


def top_segments(seg_risk: DataFrame, k: int = 15, rounded: bool = True) -> DataFrame:
    """O1: the ``k`` segments with the highest default rate (key tie-break)."""
    top = seg_risk.orderBy(F.col("default_rate").desc_nulls_last(), *SEGMENT_KEYS).limit(k)
    if not rounded:
        return top.select(*SEGMENT_KEYS, "n_loans", "default_rate", "lift_vs_book")
    return top.select(*SEGMENT_KEYS, "n_loans",
                      round_half_away(F.col("default_rate") * 100, 1).alias("default_pct"),
                      round_half_away("lift_vs_book", 2).alias("lift"))
