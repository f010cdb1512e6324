"""The whole risk layer (segments, grade loss, cohorts, defaults by month on
book) from one scan of the feature table.

Four group-bys become one ``GROUPING SETS`` aggregate: each loan row is
expanded map-side into its four group keys and partially aggregated there,
so the feature table is read once instead of four times.  The result (a few
thousand rows) is pinned; lift, rank, LGD and running sums are computed on
it.  Equal to ``segments.segment_risk``, ``loss.grade_loss`` and
``vintage.vintage_curves`` up to the addition order of double sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlens.functions.cleaning import calendar_months
from lendlens.operators.joins import BROADCAST_ROW_LIMIT, STORED_ROW_LIMIT, pinned_grouping_sets
from lendlens.plans import loss as loss_tables
from lendlens.plans import segments, vintage
from lendlens.plans.segments import SEGMENT_KEYS


def risk_layer(features: DataFrame, min_loans: int = 200, max_mob: int = 60, limit: int = BROADCAST_ROW_LIMIT,
               stored_limit: int = STORED_ROW_LIMIT) -> dict[str, DataFrame]:
    """The four tables by name; with more groups than ``stored_limit`` each comes from its own scan."""
    d = F.col("is_default") == 1
    loss = F.col("loan_amnt") - F.col("actual_total_pymnt") - F.col("actual_recoveries")
    mob = F.greatest(F.lit(1).cast("bigint"), calendar_months("issue_date", "last_pymnt_date"))
    timed = d & F.col("last_pymnt_date").isNotNull() & (mob <= max_mob)
    rows = features.select(*SEGMENT_KEYS, "vintage_quarter", "is_default", "loan_amnt", "fico", "int_rate",
                           loss.alias("__loss"), F.when(timed, mob).alias("mob"))
    aggs = [
        F.count(F.lit(1)).alias("n_loans"),
        F.sum("loan_amnt").alias("disbursed"),
        F.avg("is_default").alias("default_rate"),
        F.avg("fico").alias("avg_fico"),
        F.avg("int_rate").alias("avg_rate"),
        F.sum(F.when(d, F.col("loan_amnt"))).alias("defaulted_amount"),
        F.sum("is_default").cast("bigint").alias("n_defaults"),
        F.sum(F.when(d, F.col("__loss")).otherwise(F.lit(0.0))).alias("net_loss"),
        F.sum(F.when(d, F.col("__loss"))).alias("__loss_def"),
    ]
    tables = pinned_grouping_sets(
        rows, [list(SEGMENT_KEYS), ["grade"], ["vintage_quarter"], ["vintage_quarter", "mob"]], aggs,
        limit, stored_limit)
    if tables is None:
        return {"segment_risk": segments.segment_risk(features, min_loans), "grade_loss": loss_tables.grade_loss(features),
                "cohort_sizes": vintage.cohort_sizes(features), "vintage_curves": vintage.vintage_curves(features, max_mob)}
    seg, grade, cohort, timing = tables

    book = Window.partitionBy()
    seg = seg.withColumn("__book_rate", F.sum("n_defaults").over(book).cast("double")
                         / F.sum("n_loans").over(book).cast("double"))
    segment_risk = (seg.filter(F.col("n_loans") >= min_loans)
                    .withColumn("lift_vs_book", F.col("default_rate") / F.nullif(F.col("__book_rate"), F.lit(0.0)))
                    .withColumn("risk_rank", F.rank().over(Window.orderBy(F.col("default_rate").desc_nulls_last()))
                                .cast("bigint"))
                    .select(*SEGMENT_KEYS, "n_loans", "disbursed", "default_rate", "avg_fico", "avg_rate",
                            "defaulted_amount", "lift_vs_book", "risk_rank"))
    grade_loss = grade.select(
        "grade", "n_loans", F.col("default_rate").alias("pd_observed"), "disbursed", "net_loss",
        F.greatest(F.lit(0.0), F.col("__loss_def") / F.nullif(F.col("defaulted_amount"), F.lit(0.0))).alias("lgd"),
        F.try_divide(F.col("net_loss"), F.col("disbursed")).alias("loss_rate"))
    cohorts = cohort.select("vintage_quarter", F.col("n_loans").alias("cohort_n"))
    dmob = timing.filter(F.col("mob").isNotNull()).select("vintage_quarter", "mob", "n_loans")
    run = Window.partitionBy("vintage_quarter").orderBy("mob").rowsBetween(Window.unboundedPreceding, 0)
    curves = (dmob.join(cohorts, "vintage_quarter")
              .select("vintage_quarter", "mob", F.col("n_loans").alias("n_defaults"), "cohort_n",
                      (F.sum("n_loans").over(run).cast("double") / F.col("cohort_n").cast("double"))
                      .alias("cum_default_rate")))
    return {"segment_risk": segment_risk, "grade_loss": grade_loss, "cohort_sizes": cohorts,
            "vintage_curves": curves}
