"""Raw text -> typed table of completed loans (target + leakage drop)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.functions.cleaning import (emp_length_years, first_int, month_year_date,
                                         try_double, try_double_pct)

# The completed loan statuses kept; open loans are right-censored.
COMPLETED_STATUSES = (
    "Fully Paid",
    "Charged Off",
    "Does not meet the credit policy. Status:Fully Paid",
    "Does not meet the credit policy. Status:Charged Off",
)
DEFAULT_PATTERN = "%Charged Off%"

# Outcome columns: kept only for loss and timing analysis, never model inputs.
OUTCOME_COLUMNS = ("last_pymnt_date", "actual_total_pymnt", "actual_recoveries")

LOANS_COLUMNS = (
    "loan_id", "is_default", "loan_amnt", "term_months", "int_rate", "installment",
    "grade", "sub_grade", "purpose", "emp_length_yrs", "home_ownership", "annual_inc",
    "verification_status", "dti", "fico", "open_acc", "pub_rec", "revol_bal", "revol_util",
    "total_acc", "mort_acc", "delinq_2yrs", "inq_last_6mths", "addr_state",
    "application_type", "issue_date", "last_pymnt_date", "actual_total_pymnt",
    "actual_recoveries",
)

_PLAIN_DOUBLES = ("open_acc", "pub_rec", "revol_bal", "total_acc", "mort_acc",
                  "delinq_2yrs", "inq_last_6mths")


def completed_filter() -> F.Column:
    return (F.col("loan_status").isin(*COMPLETED_STATUSES)
            & try_double("loan_amnt").isNotNull()
            & try_double("annual_inc").isNotNull()
            & F.col("issue_d").isNotNull())


def stage_loans(raw: DataFrame, strict_dates: bool = True) -> DataFrame:
    """Type the landed text; keep completed loans with amount, income and issue month.

    The filter runs on the raw text (pushed into a Parquet scan); the typed
    projection is narrow and map-only.  With ``strict_dates`` an unparsable
    issue month fails the job, as the analysed pipeline does; otherwise it
    becomes NULL (see :func:`staging_rejects` for the count).
    """
    c = F.col
    typed = {
        "loan_id": c("id"),
        "is_default": F.when(c("loan_status").like(DEFAULT_PATTERN), F.lit(1)).otherwise(F.lit(0)),
        "loan_amnt": try_double("loan_amnt"),
        "term_months": first_int("term"),
        "int_rate": try_double_pct("int_rate"),
        "installment": try_double("installment"),
        "grade": c("grade"),
        "sub_grade": c("sub_grade"),
        "purpose": c("purpose"),
        "emp_length_yrs": emp_length_years("emp_length"),
        "home_ownership": c("home_ownership"),
        "annual_inc": try_double("annual_inc"),
        "verification_status": c("verification_status"),
        "dti": try_double("dti"),
        "fico": (try_double("fico_range_low") + try_double("fico_range_high")) / F.lit(2.0),
        **{k: try_double(k) for k in _PLAIN_DOUBLES},
        "revol_util": try_double_pct("revol_util"),
        "addr_state": c("addr_state"),
        "application_type": c("application_type"),
        "issue_date": month_year_date("issue_d", strict_dates),
        "last_pymnt_date": month_year_date(F.nullif(c("last_pymnt_d"), F.lit("")), strict_dates),
        "actual_total_pymnt": try_double("total_pymnt"),
        "actual_recoveries": try_double("recoveries"),
    }
    return raw.filter(completed_filter()).select(*[typed[k].alias(k) for k in LOANS_COLUMNS])


def staging_sanity(loans: DataFrame) -> DataFrame:
    """A1: one-row summary of the staged book."""
    return loans.agg(
        F.count(F.lit(1)).alias("n_loans"),
        F.avg("is_default").alias("default_rate"),
        F.min("issue_date").alias("first_vintage"),
        F.max("issue_date").alias("last_vintage"),
    )


def staging_rejects(raw: DataFrame) -> DataFrame:
    """Counts of raw rows by the reason staging drops them (one pass)."""
    c = F.col
    kept_status = c("loan_status").isin(*COMPLETED_STATUSES)
    return raw.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.sum(F.when(~kept_status | c("loan_status").isNull(), 1).otherwise(0)).cast("bigint").alias("open_or_unknown_status"),
        F.sum(F.when(kept_status & try_double("loan_amnt").isNull(), 1).otherwise(0)).cast("bigint").alias("bad_amount"),
        F.sum(F.when(kept_status & try_double("annual_inc").isNull(), 1).otherwise(0)).cast("bigint").alias("bad_income"),
        F.sum(F.when(kept_status & c("issue_d").isNull(), 1).otherwise(0)).cast("bigint").alias("no_issue_month"),
        F.sum(F.when(completed_filter() & month_year_date("issue_d", strict=False).isNull(), 1)
              .otherwise(0)).cast("bigint").alias("unparsable_issue_month"),
        F.sum(F.when(completed_filter(), 1).otherwise(0)).cast("bigint").alias("kept"),
    )
