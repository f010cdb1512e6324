"""Loan features computable at origination (ratios, peer ranks, cohort gaps)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.functions.cleaning import ratio
from lendlens.operators.joins import join_small, pinned_grouping_sets, together
from lendlens.operators.ordering import RankSpec, add_ranks
from lendlens.plans.staging import LOANS_COLUMNS

FEATURE_COLUMNS = LOANS_COLUMNS + (
    "vintage_quarter", "loan_to_income", "payment_to_income", "income_decile",
    "fico_quintile", "rate_rank_in_grade", "dti_rank_in_grade", "dti_vs_cohort",
    "rate_vs_subgrade",
)

RANKS = [
    RankSpec("income_decile", "annual_inc", "ntile", tiles=10),
    RankSpec("fico_quintile", "fico", "ntile", tiles=5),
    RankSpec("rate_rank_in_grade", "int_rate", "percent_rank", parts=("grade",)),
    RankSpec("dti_rank_in_grade", "dti", "percent_rank", parts=("grade",)),
]


def with_ratios(loans: DataFrame) -> DataFrame:
    """Quarter cohort and affordability ratios (NULL on zero income)."""
    return loans.withColumns({
        "vintage_quarter": F.trunc("issue_date", "quarter"),
        "loan_to_income": ratio("loan_amnt", "annual_inc"),
        "payment_to_income": ratio(F.col("installment") * 12, "annual_inc"),
    })


def cohort_means(src: DataFrame) -> list[DataFrame] | None:
    """Mean dti by grade x term and mean rate by sub-grade, pinned, from one scan; None with too many cohorts."""
    return pinned_grouping_sets(src, [["grade", "term_months"], ["sub_grade"]],
                                [F.avg("dti").alias("__avg_dti"), F.avg("int_rate").alias("__avg_rate")])


def cohort_deviation(df: DataFrame, source: DataFrame | None = None, sets: list[DataFrame] | None = None) -> DataFrame:
    """dti minus its grade x term mean; rate minus its sub-grade mean.

    Both means come from one scan (GROUPING SETS with partial aggregation),
    are pinned after a size check and joined back by broadcast, instead of
    unordered windows over a few huge partitions.  Too many cohorts: plain
    group-bys and shuffle joins.  ``source`` (default ``df``) is the table the
    means are computed on, e.g. the stored loans under a derived plan; ``sets``
    the means when ``cohort_means`` already found them.
    """
    src = source if source is not None else df
    sets = cohort_means(src) if sets is None else sets
    if sets is None:
        gt = src.groupBy("grade", "term_months").agg(F.avg("dti").alias("__avg_dti"))
        sg = src.groupBy("sub_grade").agg(F.avg("int_rate").alias("__avg_rate"))
    else:
        gt, sg = sets[0].drop("__avg_rate"), sets[1].drop("__avg_dti")
    out = join_small(df, gt, ["grade", "term_months"], how="left", pinned=sets is not None)
    out = join_small(out, sg, ["sub_grade"], how="left", pinned=sets is not None)
    return (out.withColumn("dti_vs_cohort", F.col("dti") - F.col("__avg_dti"))
            .withColumn("rate_vs_subgrade", F.col("int_rate") - F.col("__avg_rate"))
            .drop("__avg_dti", "__avg_rate"))


def loan_features(loans: DataFrame, buckets: int | None = None) -> DataFrame:
    """Typed loans -> feature table (loans + 9 columns).

    ``loans`` is read several times (rank passes, cohort means); pass a
    materialised table.
    """
    base = with_ratios(loans)
    ranked, sets = together(loans.sparkSession, lambda: add_ranks(base, RANKS, tie="loan_id", buckets=buckets), lambda: cohort_means(loans))
    return cohort_deviation(ranked, loans, sets).select(*FEATURE_COLUMNS)
