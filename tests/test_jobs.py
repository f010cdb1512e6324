"""End to end: raw CSV (gzip) -> warehouse -> models -> cutoff CSV."""

import os

from pyspark.sql import functions as F

from paths import SF001
from lendlens import jobs
from lendlens.plans import export
from lendlens.sources.fixture import raw_loans
from lendlens.sources.raw import read_raw_csv


def test_pipeline_from_csv(spark, tmp_path):
    src = str(tmp_path / "raw_csv")
    raw_loans(spark, SF001).coalesce(1).write.option("header", True).option("compression", "gzip").csv(src)
    raw = read_raw_csv(spark, src, min_partitions=4)
    assert all(t == "string" for _, t in raw.dtypes)
    out = str(tmp_path / "book")
    w = jobs.build_warehouse(spark, raw, out, min_loans=20)
    direct = raw_loans(spark, SF001)
    assert w["loans"].count() == jobs.stage_loans(direct).count()
    assert spark.read.parquet(os.path.join(out, "processed", "segment_risk.parquet")).count() == w["segment_risk"].count()
    for name, schema in jobs.SCHEMAS.items():
        assert spark.table(f"{schema}.{name}").count() > 0
    assert w["quarantine"].filter("fatal").count() > 0
    m = jobs.train_models(w["features"], out, gbt_iter=3)
    assert m["metrics"].count() == 2
    t = jobs.cutoff_economics(spark, out, w["grade_loss"])
    back = export.read_cutoff_csv(spark, os.path.join(out, "reports", "cutoff_table.csv"))
    assert back.count() == t.count() > 0
    assert back.filter(F.col("approval_rate") > 1).count() == 0
    few = jobs.build_warehouse(spark, raw, str(tmp_path / "book2"), min_loans=40)           # the names now stand for the second book
    assert 0 < spark.table("features.segment_risk").count() == few["segment_risk"].count()
    assert spark.read.parquet(os.path.join(out, "processed", "segment_risk.parquet")).count() > few["segment_risk"].count()


def test_save_table(spark, tmp_path):
    df = spark.range(5).withColumnRenamed("id", "x")
    name = export.save_table(df, "t_save_check")
    assert spark.table(name).count() == 5


def test_cli_main(spark, tmp_path, capsys):
    src = str(tmp_path / "raw_csv")
    raw_loans(spark, SF001).coalesce(1).write.option("header", True).option("compression", "gzip").csv(src)
    out = str(tmp_path / "cli_out")
    jobs.main(["--raw", src, "--out", out, "--gbt-iter", "2", "--partitions", "4"])
    printed = capsys.readouterr().out
    assert "done in" in printed
    for p in ("loans", "loan_features", "processed/fact_loans.parquet", "reports/test_scores.parquet",
              "reports/cutoff_table.csv", "reports/model_metrics.csv"):
        assert os.path.exists(os.path.join(out, p)), p


def test_csv_empty_fields_are_null(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text('id,loan_amnt,last_pymnt_d\n1,,Jan-2015\n2,"",""\n3,"1,000",x\n')
    rows = {r["id"]: r for r in read_raw_csv(spark, str(p)).collect()}
    assert rows["1"]["loan_amnt"] is None and rows["2"]["loan_amnt"] is None
    assert rows["2"]["last_pymnt_d"] is None
    assert rows["3"]["loan_amnt"] == "1,000"
