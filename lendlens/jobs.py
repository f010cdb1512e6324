"""The three batch jobs of the loan-book pipeline, end to end.

1. ``build_warehouse``: raw loan file -> loans -> features -> segment,
   vintage, grade-loss and expected-loss tables -> dashboard exports.
2. ``train_models``: policy rules, out-of-time split, two PD models,
   metrics and test scores.
3. ``cutoff_economics``: scores x grade LGD -> cutoff table (CSV).

Usage::

    spark-submit lendlens/jobs.py --raw s3://.../loans.csv.gz --out s3://.../book

Intermediate layers are written under ``--out`` (shared storage), so a lost
executor re-reads files instead of recomputing the upstream joins.
"""

from __future__ import annotations

import argparse
import os
import time

from pyspark.sql import DataFrame, SparkSession

from lendlens.plans import cutoff, export, loss
from lendlens.plans.risk_layer import risk_layer
from lendlens.plans.features import loan_features
from lendlens.plans.model import train_and_score
from lendlens.plans.staging import stage_loans, staging_rejects, staging_sanity
from lendlens.plans.quarantine import land_with_quarantine, reason_counts
from lendlens.session import scratch
from lendlens.sources.raw import read_raw_csv
from lendlens.sources.records import read_csv_records


def _land(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


# The schema of every named table.
SCHEMAS = {"loans_raw": "staging", "loans": "staging", "loan_features": "features", "segment_risk": "features",
           "vintage_curves": "risk", "grade_loss": "risk", "segment_expected_loss": "risk"}


def build_warehouse(spark: SparkSession, raw: DataFrame, out: str, min_loans: int = 200,
                    max_mob: int = 60, prefix: str = "") -> dict:
    """Entry 1: land, type, feature, aggregate, name the seven tables and export.  Returns the tables.

    The named tables are ``<prefix>staging.loans`` and so on (``SCHEMAS``).  Raw rows with reject reasons are written
    beside the book (``quarantine``); intermediate tables are removed at the end.
    """
    schema = {name: prefix + s for name, s in SCHEMAS.items()}
    with scratch(spark):
        kept, rejects = land_with_quarantine(raw, os.path.join(out, "loans_raw"), os.path.join(out, "quarantine"))
        loans = _land(stage_loans(kept), os.path.join(out, "loans"))
        features = _land(loan_features(loans), os.path.join(out, "loan_features"))
        for name in ("loans_raw", "loans", "loan_features"):
            export.name_layer(spark, schema[name], name, os.path.join(out, name))
        # segments, grade loss and vintage curves from one scan of the features
        layer = risk_layer(features, min_loans, max_mob)
        layer["segment_expected_loss"] = loss.segment_expected_loss(layer["segment_risk"], layer["grade_loss"])
        tables = {name: spark.table(export.save_table(layer[name], name, schema[name], os.path.join(out, "warehouse")))
                  for name in ("segment_risk", "vintage_curves", "grade_loss", "segment_expected_loss")}
        export.export_star(os.path.join(out, "processed"), features, *[tables[name] for name in (
            "segment_risk", "vintage_curves", "grade_loss", "segment_expected_loss")])
    return {"raw": kept, "loans": loans, "features": features, **tables, "sanity": staging_sanity(loans),
            "rejects": staging_rejects(kept), "quarantine": rejects}


def train_models(features: DataFrame, out: str, gbt_iter: int = 400) -> dict:
    """Entry 2: returns metrics and test scores; writes both."""
    path = os.path.join(out, "reports", "test_scores.parquet")
    with scratch(features.sparkSession):
        res = train_and_score(features, gbt_iter=gbt_iter)
        export.write_scores(res.scores, path)
        export.write_small_csv(res.metrics, os.path.join(out, "reports", "model_metrics.csv"))
    return {"metrics": res.metrics, "scores": export.read_scores(features.sparkSession, path), "cutoff_days": res.cutoff_days}


def cutoff_economics(spark: SparkSession, out: str, grades: DataFrame) -> DataFrame:
    """Entry 3: cutoff table from the written scores and grade LGD."""
    scores = export.read_scores(spark, os.path.join(out, "reports", "test_scores.parquet"))
    table = cutoff.cutoff_table(scores, grades)
    export.write_cutoff_csv(table, os.path.join(out, "reports", "cutoff_table.csv"))
    return table


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    ap.add_argument("--raw", required=True, help="raw loan CSV (gz ok), header, text columns")
    ap.add_argument("--out", required=True, help="output folder on shared storage")
    ap.add_argument("--gbt-iter", type=int, default=400)
    ap.add_argument("--partitions", type=int, default=None, help="spread a single gzip split")
    ap.add_argument("--min-loans", type=int, default=200, help="volume floor of the segment table")
    ap.add_argument("--max-mob", type=int, default=60, help="last month on book of the vintage curves")
    ap.add_argument("--stray-quotes", action="store_true", help="plain fields may hold single quotes: one task per file")
    ap.add_argument("--prefix", default="", help="put before the names of the three schemas")
    a = ap.parse_args(argv)
    from lendlens.session import get_spark
    spark = get_spark()
    t = time.time()
    raw = read_raw_csv(spark, a.raw, a.partitions) if a.stray_quotes else read_csv_records(spark, a.raw, keep_record=True)
    raw = raw.repartition(a.partitions) if a.partitions and not a.stray_quotes else raw
    w = build_warehouse(spark, raw, a.out, a.min_loans, a.max_mob, a.prefix)
    w["sanity"].show()
    w["rejects"].show()
    reason_counts(w["quarantine"]).show()
    m = train_models(w["features"], a.out, a.gbt_iter)
    m["metrics"].show()
    cutoff_economics(spark, a.out, w["grade_loss"]).orderBy("pd_cutoff").show(60)
    print(f"done in {time.time() - t:.1f}s")


if __name__ == "__main__":
    main()
