"""Plan-shape guards for the properties the design relies on at scale."""

import re

from paths import SF001
from lendlens.plans import cutoff, loss, reports
from lendlens.plans.book import book
from lendlens.plans.features import loan_features


def _explain(spark, df) -> str:
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_feature_build_never_shuffles_all_rows(spark):
    text = _explain(spark, loan_features(book(spark, SF001).loans))
    assert "SinglePartition" not in text
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text
    # exchanges that move loan rows: only the two tile-edge windows (the other
    # exchanges move the small per-value count tables of the percent ranks)
    row_exchanges = [m for m in re.finditer(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)
                     if "loan_id" in m.group(1)]
    assert len(row_exchanges) <= 2


def test_cutoff_sweep_has_no_theta_join(spark):
    f = book(spark, SF001).features
    text = _explain(spark, cutoff.cutoff_table(cutoff.deterministic_scores(f), loss.grade_loss(f)))
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_slicers_reach_the_scan(spark):
    f = book(spark, SF001).features
    text = _explain(spark, reports.portfolio_kpis(f, term_months=36, grades=("A",), vintage_year=1998))
    pushed = " ".join(re.findall(r"PushedFilters: \[(.*)\]", text))
    assert "EqualTo(term_months,36)" in pushed
    assert "GreaterThanOrEqual(issue_date,1998-01-01)" in pushed
    assert "LessThan(vintage_quarter,1999-01-01)" in pushed


def test_exported_fact_prunes_partitions(spark, tmp_path):
    """The fact export is partitioned by issue quarter: a year slicer on the
    exported table becomes a partition filter (whole folders skipped)."""
    from lendlens.plans import export
    f = book(spark, SF001).features
    path = str(tmp_path / "fact")
    export.write_parquet(export.fact_loans(f), path, ("vintage_quarter",))
    fact = spark.read.parquet(path)
    text = _explain(spark, reports.portfolio_kpis(fact.withColumn("actual_total_pymnt", fact.loan_amnt)
                                                  .withColumn("actual_recoveries", fact.loan_amnt * 0),
                                                  vintage_year=1998))
    part = " ".join(re.findall(r"PartitionFilters: \[(.*)\]", text))
    assert "vintage_quarter" in part and "1998-01-01" in part
