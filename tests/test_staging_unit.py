"""Staging on a hand-written raw frame covering the text traps."""

import datetime as dt

import pytest

from lendlens.plans.staging import LOANS_COLUMNS, stage_loans, staging_rejects

RAW_COLS = ["id", "loan_status", "loan_amnt", "term", "int_rate", "installment", "grade", "sub_grade",
            "purpose", "emp_length", "home_ownership", "annual_inc", "verification_status", "dti",
            "fico_range_low", "fico_range_high", "open_acc", "pub_rec", "revol_bal", "revol_util",
            "total_acc", "mort_acc", "delinq_2yrs", "inq_last_6mths", "addr_state", "application_type",
            "issue_d", "last_pymnt_d", "total_pymnt", "recoveries"]


def row(i, status="Fully Paid", amnt="1000", term=" 36 months", rate="10.5", emp="5 years", inc="50000",
        dti="10.0", lo="700", hi="704", util="50%", grade="B", issue="Jan-2015", last="Jun-2016"):
    return (f"L{i:02d}", status, amnt, term, rate, "30.1", grade, (grade or "X") + "1", "car", emp, "RENT",
            inc, "Verified", dti, lo, hi, "5", "0", "1000", util, "10", "1", "0", "1", "CA", "Individual",
            issue, last, "900", "0")


ROWS = [
    row(1),
    row(2, status="Charged Off", last="Mar-2015"),
    row(3, status="Does not meet the credit policy. Status:Fully Paid"),
    row(4, status="Does not meet the credit policy. Status:Charged Off"),
    row(5, status="Current"),                      # open loan: dropped
    row(6, amnt="n/a"),                            # no amount: dropped
    row(7, amnt="1d"),                             # Java suffix is not a number: dropped
    row(8, inc=None),                              # no income: dropped
    row(9, inc="0"),                               # zero income kept
    row(10, rate="13.5%", term="x"),               # percent sign; term without digits
    row(11, emp="10+ years"),
    row(12, emp="< 1 year"),
    row(13, emp="n/a"),
    row(14, emp=None),
    row(15, lo=None),                              # one fico bound missing
    row(16, dti="NaN"),
    row(17, last=""),                              # empty last payment -> NULL
    row(18, grade=None, status="Charged Off"),
    row(19, amnt="2.5e3", inc="inf"),
    row(20, amnt="1_000", issue=" Dec-2015 ", last="dec-16"),   # digit separator; spaces; short year
]


@pytest.fixture(scope="module")
def staged(spark):
    raw = spark.createDataFrame(ROWS, ", ".join(f"{c} string" for c in RAW_COLS))
    return {r["loan_id"]: r for r in stage_loans(raw).collect()}, raw


def test_kept_rows_and_columns(staged, spark):
    rows, raw = staged
    assert set(rows) == {f"L{i:02d}" for i in (1, 2, 3, 4, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20)}
    assert tuple(stage_loans(raw).columns) == LOANS_COLUMNS


def test_target(staged):
    rows, _ = staged
    assert rows["L01"]["is_default"] == 0 and rows["L02"]["is_default"] == 1
    assert rows["L03"]["is_default"] == 0 and rows["L04"]["is_default"] == 1


def test_casts(staged):
    rows, _ = staged
    assert rows["L10"]["int_rate"] == 13.5 and rows["L10"]["term_months"] is None
    assert rows["L01"]["term_months"] == 36
    assert rows["L09"]["annual_inc"] == 0.0
    assert rows["L19"]["loan_amnt"] == 2500.0 and rows["L19"]["annual_inc"] == float("inf")
    assert rows["L01"]["revol_util"] == 50.0
    import math
    assert math.isnan(rows["L16"]["dti"])


def test_sql_style_text(staged):
    rows, _ = staged
    assert rows["L20"]["loan_amnt"] == 1000.0
    assert rows["L20"]["issue_date"] == dt.date(2015, 12, 1)
    assert rows["L20"]["last_pymnt_date"] == dt.date(16, 12, 1)


def test_emp_length(staged):
    rows, _ = staged
    assert rows["L01"]["emp_length_yrs"] == 5
    assert rows["L11"]["emp_length_yrs"] == 10
    assert rows["L12"]["emp_length_yrs"] == 0
    assert rows["L13"]["emp_length_yrs"] is None
    assert rows["L14"]["emp_length_yrs"] is None


def test_fico_and_dates(staged):
    rows, _ = staged
    assert rows["L01"]["fico"] == 702.0
    assert rows["L15"]["fico"] is None
    assert rows["L01"]["issue_date"] == dt.date(2015, 1, 1)
    assert rows["L01"]["last_pymnt_date"] == dt.date(2016, 6, 1)
    assert rows["L17"]["last_pymnt_date"] is None
    assert rows["L18"]["grade"] is None


def test_rejects(staged):
    _, raw = staged
    r = staging_rejects(raw).first()
    assert r["raw_rows"] == len(ROWS)
    assert r["open_or_unknown_status"] == 1
    assert r["bad_amount"] == 2
    assert r["bad_income"] == 1
    assert r["kept"] == 16


def test_strict_dates_raise(spark):
    bad = [row(1, issue="Foo-2015")]
    raw = spark.createDataFrame(bad, ", ".join(f"{c} string" for c in RAW_COLS))
    with pytest.raises(Exception):
        stage_loans(raw).collect()
    lenient = stage_loans(raw, strict_dates=False).collect()
    assert lenient[0]["issue_date"] is None
    r = staging_rejects(raw).first()
    assert r["unparsable_issue_month"] == 1 and r["kept"] == 1


def test_strict_dates_raise_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        raw = spark.createDataFrame([row(1, issue="Foo-2015")], ", ".join(f"{c} string" for c in RAW_COLS))
        with pytest.raises(Exception):
            stage_loans(raw).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
