"""M1/M2: hard policy declines and the out-of-time train/test split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.functions.cleaning import nan_to_null
from lendlens.operators.quantile import exact_quantiles
from lendlens.plans.lineage import ancestors
from lendlens.plans.staging import OUTCOME_COLUMNS

# Model inputs (22 numeric, 5 categorical), target, split date.
NUMERIC = [
    "loan_amnt", "term_months", "int_rate", "installment", "emp_length_yrs",
    "annual_inc", "dti", "fico", "open_acc", "pub_rec", "revol_bal",
    "revol_util", "total_acc", "mort_acc", "delinq_2yrs", "inq_last_6mths",
    "loan_to_income", "payment_to_income", "rate_rank_in_grade",
    "dti_rank_in_grade", "dti_vs_cohort", "rate_vs_subgrade",
]
CATEGORICAL = ["grade", "purpose", "home_ownership", "verification_status", "application_type"]
TARGET = "is_default"
SPLIT_DATE = "issue_date"

# Policy thresholds.
MAX_DTI = 60
MIN_FICO = 640
MAX_REVOL_UTIL = 120
TINY_INCOME = 200_000 / 83
MAX_LOAN_TO_TINY_INCOME = 0.8


# Columns known only after the loan was made (exact names, name prefixes).
AFTER_ORIGINATION = OUTCOME_COLUMNS + (
    "total_pymnt", "total_rec_prncp", "total_rec_int", "recoveries", "collection_recovery_fee", "out_prncp",
    "out_prncp_inv", "last_pymnt_d", "last_pymnt_amnt", "next_pymnt_d", "last_fico_range_high",
    "last_fico_range_low", "debt_settlement_flag")
AFTER_ORIGINATION_PREFIXES = ("settlement_", "hardship_")


def check_inputs(inputs) -> None:
    """Fails if a model input is the target, the split date or known only after the loan was made."""
    leaked = [c for c in inputs if c in AFTER_ORIGINATION or c in (TARGET, SPLIT_DATE)
              or c.startswith(AFTER_ORIGINATION_PREFIXES)]
    if leaked:
        raise ValueError(f"outcome columns among model inputs: {sorted(leaked)}")


def check_lineage(features: DataFrame, inputs) -> None:
    """Fails if an input is computed from the target or from a column known only after the loan was made."""
    known = ancestors(features)
    late = lambda c: c in AFTER_ORIGINATION or c == TARGET or c.startswith(AFTER_ORIGINATION_PREFIXES)
    leaked = {c: sorted(filter(late, known.get(c, ()))) for c in inputs}
    leaked = {c: found for c, found in leaked.items() if found}
    if leaked:
        raise ValueError(f"model inputs computed from outcome columns: {leaked}")


def model_frame(features: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The pruned model table (and ``keep``); fails if an input is an outcome column or computed from one."""
    check_inputs(NUMERIC + CATEGORICAL)
    check_lineage(features, NUMERIC + CATEGORICAL)
    return features.select(*NUMERIC, *CATEGORICAL, TARGET, SPLIT_DATE, *keep)


def declined(df: DataFrame | None = None) -> F.Column:
    """Policy decline flag; a missing (NULL or NaN) input never fires a rule."""
    dti, fico, util = nan_to_null("dti"), nan_to_null("fico"), nan_to_null("revol_util")
    inc, amt = nan_to_null("annual_inc"), nan_to_null("loan_amnt")
    stretched = F.when(inc == 0, amt > 0).otherwise(amt / F.nullif(inc, F.lit(0.0)) > MAX_LOAN_TO_TINY_INCOME)
    return (F.coalesce(dti > MAX_DTI, F.lit(False))
            | F.coalesce(fico < MIN_FICO, F.lit(False))
            | F.coalesce(util > MAX_REVOL_UTIL, F.lit(False))
            | F.coalesce((inc < TINY_INCOME) & stretched, F.lit(False)))


def with_decline(df: DataFrame) -> DataFrame:
    return df.withColumn("declined", declined())


def policy_summary(df: DataFrame) -> DataFrame:
    """Decline share and the default rate inside the declines (one pass)."""
    d = declined()
    return df.agg(
        F.count(F.lit(1)).alias("n_loans"),
        F.sum(F.when(d, 1).otherwise(0)).cast("bigint").alias("n_declined"),
        F.avg(F.when(d, 1.0).otherwise(0.0)).alias("decline_share"),
        F.avg(F.when(d, F.col(TARGET))).alias("default_rate_declined"),
    )


def passing(df: DataFrame) -> DataFrame:
    return df.filter(~declined())


def oot_cutoff_days(df: DataFrame, q: float = 0.8) -> float | None:
    """Exact linear-interpolated quantile of the issue date, in days since 1970
    (radix selection: no task holds all distinct dates)."""
    days = df.select(F.unix_date(SPLIT_DATE).cast("double").alias("__days"))
    return exact_quantiles(days, ["__days"], q)["__days"]


def oot_cutoff(df: DataFrame, q: float = 0.8) -> DataFrame:
    """The cutoff as a one-row table: days since 1970 and the calendar date."""
    cut = oot_cutoff_days(df, q)
    return df.sparkSession.createDataFrame([(cut,)], "cutoff_days double").withColumn(
        "cutoff_date", F.date_from_unix_date(F.floor("cutoff_days").cast("int")))


def oot_split(df: DataFrame, q: float = 0.8) -> tuple[DataFrame, DataFrame, float]:
    """Train = issued on or before the cutoff, test = after.  Returns (train, test, cutoff_days)."""
    cut = oot_cutoff_days(df, q)
    days = F.unix_date(SPLIT_DATE)
    return df.filter(days <= F.lit(cut)), df.filter(days > F.lit(cut)), cut


def split_counts(df: DataFrame, cutoff_days: float) -> DataFrame:
    days = F.unix_date(SPLIT_DATE)
    split = F.when(days <= F.lit(cutoff_days), F.lit("train")).otherwise(F.lit("test"))
    return df.groupBy(split.alias("split")).agg(
        F.count(F.lit(1)).alias("n_loans"),
        F.avg(TARGET).alias("default_rate"),
        F.min(SPLIT_DATE).alias("min_issue_date"),
        F.max(SPLIT_DATE).alias("max_issue_date"),
    )
