"""Named queries of the sources and sinks: what is written comes back as it was."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import functions as F

from lendlens import oracle_sql as O
from lendlens.catalog import _CUT_ROUND, _EL_ROUND, _EL_SQL, _GRADE_ROUND, _KEPT, _SEG_ROUND, FACT_COLUMNS, _cutoff_table, _expected_loss, _feat, _logit_rows, register
from lendlens.operators.logit import fit_logit, logit_probability
from lendlens.plans import cutoff, export, loss, model, policy, quarantine, segments, vintage
from lendlens.plans.staging import stage_loans
from lendlens.session import remove_folder, scratch, shared_dir, shuffles_removed, split_methods
from lendlens.sources.fixture import raw_loan_parts
from lendlens.sources.ordered import read_ordered, write_ordered
from lendlens.sources.records import read_csv_records


def _folder(spark, name: str) -> str:
    return os.path.join(shared_dir(spark), "exports", f"{name}-{uuid.uuid4().hex[:12]}")


# ---------------------------------------------------------------- sinks and what is read back
@register("ordered_curves_roundtrip", "SELECT *, row_number() OVER (ORDER BY vintage_quarter, mob) AS position FROM curves",
          {"cum_default_rate": 9}, dates=("vintage_quarter",))
def q_ordered_curves(spark, sf_dir):
    """O2: the stored curves tell every row its place in the report."""
    path = _folder(spark, "curves")
    write_ordered(vintage.vintage_curves(_feat(spark, sf_dir)), path, export.REPORT_ORDER["vintage_curves"], ranges=8)
    return read_ordered(spark, path)


@register("ordered_losses_roundtrip", f"""
SELECT *, row_number() OVER (ORDER BY el_rate DESC, grade, purpose, income_decile) AS position FROM ({_EL_SQL})""", _EL_ROUND)
def q_ordered_losses(spark, sf_dir):
    """O2: expected losses stored from the largest rate to the smallest."""
    path = _folder(spark, "losses")
    write_ordered(_expected_loss(spark, sf_dir), path, export.REPORT_ORDER["segment_expected_loss"], ranges=4)
    return read_ordered(spark, path)


@register("export_fact_roundtrip", f"SELECT {', '.join(FACT_COLUMNS)} FROM features", {"loan_to_income": 6},
          dates=("vintage_quarter", "issue_date"), nullable_ints=("term_months",))
def q_export_fact(spark, sf_dir):
    """The fact table, partitioned by quarter, as a dashboard reads it."""
    path = _folder(spark, "fact")
    export.write_parquet(export.fact_loans(_feat(spark, sf_dir)), path, ("vintage_quarter",))
    return spark.read.parquet(path)


@register("export_aggregates_roundtrip", "SELECT * FROM seg", {**_SEG_ROUND, "lift_vs_book": 9})
def q_export_aggregates(spark, sf_dir):
    """The segment table out of the whole star export."""
    f = _feat(spark, sf_dir)
    seg, grades = segments.segment_risk(f), loss.grade_loss(f)
    paths = export.export_star(_folder(spark, "star"), f, seg, vintage.vintage_curves(f), grades, loss.segment_expected_loss(seg, grades))
    return spark.read.parquet(paths["segment_risk"])


@register("export_csv_roundtrip", "SELECT * FROM grades", _GRADE_ROUND)
def q_export_csv(spark, sf_dir):
    """The grade losses as CSV; numbers come back to the last digit."""
    path = _folder(spark, "grades.csv")
    grades = loss.grade_loss(_feat(spark, sf_dir))
    export.write_small_csv(grades, path, export.REPORT_ORDER["grade_loss"])
    return spark.read.option("header", True).schema(grades.schema).csv(path)


@register("scores_roundtrip", "SELECT loan_amnt, int_rate, grade, purpose, is_default, pd_hat FROM sc", extra_ctes=O.SCORE_CTES)
def q_scores_roundtrip(spark, sf_dir):
    """Scores written by the model job and read by the cutoff job."""
    path = _folder(spark, "scores")
    export.write_scores(cutoff.deterministic_scores(_feat(spark, sf_dir)), path)
    return export.read_scores(spark, path)


@register("cutoff_csv_roundtrip", "SELECT * FROM ctab", _CUT_ROUND, extra_ctes=O.SCORE_CTES)
def q_cutoff_csv(spark, sf_dir):
    """The cutoff table through its CSV file."""
    path = _folder(spark, "cutoffs.csv")
    export.write_cutoff_csv(_cutoff_table(spark, sf_dir), path)
    return export.read_cutoff_csv(spark, path)


@register("catalog_table_roundtrip", "SELECT * FROM grades", _GRADE_ROUND)
def q_catalog_table(spark, sf_dir):
    """A catalog table created, replaced by another version and read by name."""
    name = f"grade_loss_{uuid.uuid4().hex[:12]}"
    grades = loss.grade_loss(_feat(spark, sf_dir))
    export.save_table(grades.filter("grade = 'A'"), name)
    export.save_table(grades, name)
    return spark.table(name)


# ---------------------------------------------------------------- sources
def _digest(length: int = 2) -> F.Column:
    return F.substring(F.md5("id"), 1, length)


# Applications whose CSV text and cut records are on disk at the same time.
CSV_ROWS = 8_000_000


@contextmanager
def _landing(spark):
    """Folder for the CSV files of one part of the book; they and the intermediate tables of the part go at the end of the block."""
    path = _folder(spark, "raw.csv")
    with split_methods(spark), shuffles_removed(spark), scratch(spark):
        try:
            yield path
        finally:
            remove_folder(spark, path)


# Which rows of the fixture file are odd, by the first two digits of md5(id).
_SHORT, _EXTRA, _BAD_PAYMENT, _BAD_ISSUE = "00", "01", "02", "03"


@register("staging_from_csv", """
SELECT * REPLACE (CASE WHEN substr(md5(loan_id), 1, 1) = 'a' THEN addr_state || chr(10) || '"quoted", line two' ELSE addr_state END AS addr_state)
FROM loans""", dates=("issue_date", "last_pymnt_date"), nullable_ints=("term_months", "emp_length_yrs"))
def q_staging_from_csv(spark, sf_dir):
    """The book staged from CSV files with quoted line breaks, cut at byte ranges."""
    state = F.when(_digest(1) == "a", F.concat("addr_state", F.lit('\n"quoted", line two'))).otherwise(F.col("addr_state"))
    staged = _folder(spark, "loans-csv")
    for raw in raw_loan_parts(spark, sf_dir, CSV_ROWS):
        with _landing(spark) as path:
            # a file a core, so that files are large enough to be split
            raw.withColumn("addr_state", state).coalesce(spark.sparkContext.defaultParallelism).write.option("header", True).option(
                "quoteAll", True).option("escape", '"').csv(path)
            stage_loans(read_csv_records(spark, path)).write.mode("append").parquet(staged)
    return spark.read.parquet(staged)


_LOOKED_AT = f"({_KEPT} OR k IN ('{_SHORT}', '{_EXTRA}'))"


@register("staging_quarantine", f"""
SELECT reason, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE fatal) AS n_fatal
FROM (SELECT unnest([CASE WHEN k = '{_SHORT}' THEN 'short_row' END, CASE WHEN k = '{_EXTRA}' THEN 'extra_fields' END,
    CASE WHEN no_amount THEN 'bad_amount' END, CASE WHEN no_income THEN 'bad_income' END,
    CASE WHEN k = '{_BAD_ISSUE}' THEN 'bad_issue_month' END, CASE WHEN k = '{_BAD_PAYMENT}' THEN 'bad_payment_month' END]) AS reason,
    no_amount OR no_income OR k = '{_BAD_ISSUE}' AS fatal
  FROM (SELECT *, substr(md5(id), 1, 2) AS k, TRY_CAST(loan_amnt AS DOUBLE) IS NULL AS no_amount, TRY_CAST(annual_inc AS DOUBLE) IS NULL AS no_income FROM raw)
  WHERE {_LOOKED_AT})
WHERE reason IS NOT NULL GROUP BY reason""")
def q_staging_quarantine(spark, sf_dir):
    """Rejects of a CSV file with short rows, extra fields and months that are none, read back from beside the book."""
    k = _digest()
    landed, rejected = _folder(spark, "book"), _folder(spark, "rejects")
    for raw in raw_loan_parts(spark, sf_dir, CSV_ROWS):
        raw = raw.withColumns({"last_pymnt_d": F.when(k == _BAD_PAYMENT, "Foo-1999").otherwise(F.col("last_pymnt_d")),
                               "issue_d": F.when(k == _BAD_ISSUE, "13 of 1999").otherwise(F.col("issue_d"))})
        line = F.to_csv(F.struct(*raw.columns), {"quoteAll": "true", "escape": '"'})
        line = F.when(k == _SHORT, F.regexp_replace(line, ',[^,]*,[^,]*$', "")).when(k == _EXTRA, F.concat(line, F.lit(',"more","fields"'))).otherwise(line)
        with _landing(spark) as path:
            raw.select(line.alias("value")).write.text(path)
            rows = read_csv_records(spark, path, keep_record=True, names=raw.columns)
            _, rejects = quarantine.land_with_quarantine(rows, landed, rejected, mode="append")
    return quarantine.reason_counts(rejects)


# ---------------------------------------------------------------- encoded inputs
@register("onehot_levels", " UNION ALL ".join(
    f"SELECT '{c}' AS input, coalesce({c}, '__missing__') AS level, COUNT(*) AS n_train, AVG(is_default) AS default_rate FROM train GROUP BY ALL" for c in policy.CATEGORICAL),
    {"default_rate": 9}, extra_ctes=O.MODEL_CTES)
def q_onehot_levels(spark, sf_dir):
    """M5: every level has a column of its own; rows and defaults under each, from the encoded training design."""
    train, test, _ = policy.oot_split(policy.passing(policy.model_frame(_feat(spark, sf_dir), keep=("loan_id",))))
    design, _, binning = model.design_tables(train, test)
    names = [(c[2:], x) for c, levels in binning.levels.items() for x in levels]
    coded = F.slice("x", F.size("x") - len(names) + 1, len(names))
    ones = design.select("y", F.posexplode(coded).alias("at", "on")).filter("on = 1").groupBy("at").agg(
        F.count(F.lit(1)).alias("n_train"), F.avg("y").alias("default_rate"))
    told = spark.createDataFrame([(i, c, x) for i, (c, x) in enumerate(names)], "at int, input string, level string")
    return ones.join(F.broadcast(told), "at").select("input", "level", "n_train", "default_rate")


# ---------------------------------------------------------------- scoring and model choice
_Z = " + ".join(["b0"] + [f"b{k} * (({c} - {m}) / {s})" for k, (c, (m, s)) in enumerate(O.LOGIT_INPUTS.items(), 1)])


@register("logit_scores", f"SELECT loan_id, 1 / (1 + exp(-({_Z}))) AS pd_hat FROM test, nw{O.NEWTON_STEPS} WHERE fico IS NOT NULL AND int_rate IS NOT NULL",
          {"pd_hat": 7}, extra_ctes=O.MODEL_CTES + O.newton_ctes())
def q_logit_scores(spark, sf_dir):
    """M9: the later loans scored by the model fitted on the earlier ones."""
    train, test, _ = policy.oot_split(policy.passing(_feat(spark, sf_dir)))
    rows = test.filter(" AND ".join(f"{c} IS NOT NULL" for c in O.LOGIT_INPUTS))
    fitted = fit_logit(_logit_rows(spark, sf_dir), "x", "y")
    return rows.withColumn("x", F.array(*[(F.col(c) - m) / s for c, (m, s) in O.LOGIT_INPUTS.items()])).select(
        "loan_id", logit_probability(fitted, "x").alias("pd_hat"))


_RIVALS = {"debt": "dti / 100.0", "utilisation": "revol_util / 200.0", "utilisation_again": "revol_util / 200.0"}


def _rival_sql(name: str, number: int, score: str) -> str:
    return f"""SELECT {number} AS k, '{name}' AS model,
  (SELECT SUM(pos * (below + 0.5 * neg)) / (SUM(pos) * SUM(neg)) FROM (
    SELECT pos, neg, COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
    FROM (SELECT {score} AS s, CAST(SUM(is_default) AS DOUBLE) AS pos, CAST(COUNT(*) - SUM(is_default) AS DOUBLE) AS neg
          FROM test WHERE {score} IS NOT NULL GROUP BY ALL))) AS auc,
  (SELECT AVG(({score} - is_default) * ({score} - is_default)) FROM test WHERE {score} IS NOT NULL) AS brier"""


@register("champion_selection", "SELECT model, auc, 2 * auc - 1 AS gini, brier, k = (SELECT MIN(k) FROM r WHERE auc = (SELECT MAX(auc) FROM r) AND auc > 0) AS is_champion FROM r",
          {"auc": 9, "gini": 9, "brier": 9},
          extra_ctes=O.MODEL_CTES + [("r", " UNION ALL ".join(_rival_sql(n, k, s) for k, (n, s) in enumerate(_RIVALS.items())))])
def q_champion_selection(spark, sf_dir):
    """The metrics report; the larger AUC wins, the first of two equal ones."""
    test = policy.oot_split(policy.passing(_feat(spark, sf_dir)))[1]
    return model.metrics_report(test.select(F.col(policy.TARGET).alias("y"), *[F.expr(e).alias(n) for n, e in _RIVALS.items()]), {n: n for n in _RIVALS})[0]


# ---------------------------------------------------------------- missing grades and empty cutoffs
# Grade G is taken as unknown, grade B has no loss table row, no score lies below 0.18.
_SPARSE_CTES = [
    ("grades_known", "SELECT NULLIF(grade, 'G') AS grade, lgd FROM grades WHERE grade <> 'B'"),
    ("sp", "SELECT loan_amnt, NULLIF(grade, 'G') AS grade, is_default, 0.18 + revol_util / 500.0 AS pd_hat FROM features"),
    ("spl", "SELECT sp.*, lgd FROM sp LEFT JOIN grades_known g ON sp.grade IS NOT DISTINCT FROM g.grade"),
    ("spf", "SELECT * REPLACE (COALESCE(lgd, (SELECT AVG(lgd) FROM spl)) AS lgd) FROM spl"),
]


def _known_grades(spark, sf_dir):
    grades = loss.grade_loss(_feat(spark, sf_dir)).filter("grade <> 'B'")
    return grades.withColumn("grade", F.nullif("grade", F.lit("G")))


@register("cutoff_table_sparse", """
SELECT any_value(label) AS pd_cutoff, COUNT(*) / (SELECT COUNT(*) FROM spf) AS approval_rate, AVG(is_default) AS default_rate,
  SUM(loan_amnt) / (SELECT SUM(loan_amnt) FROM spf) AS disbursed_share,
  SUM(CASE WHEN is_default = 1 THEN loan_amnt * lgd ELSE 0 END) / SUM(loan_amnt) * 100 AS loss_per_100cr_inr
FROM grid JOIN spf ON spf.pd_hat < grid.cutoff GROUP BY i""", _CUT_ROUND, extra_ctes=O.SCORE_CTES + _SPARSE_CTES)
def q_cutoff_table_sparse(spark, sf_dir):
    """Cutoffs without loans are left out, unknown grades meet each other, a grade without a loss gets the mean."""
    scores = _feat(spark, sf_dir).select("loan_amnt", "int_rate", F.nullif("grade", F.lit("G")).alias("grade"), "purpose", "is_default",
                                         (0.18 + F.col("revol_util") / 500.0).alias("pd_hat"))
    return cutoff.cutoff_table(scores, _known_grades(spark, sf_dir))


@register("expected_loss_sparse", _EL_SQL.replace("FROM seg JOIN (SELECT grade, lgd FROM grades) USING (grade)",
                                                  "FROM (SELECT * REPLACE (NULLIF(grade, 'G') AS grade) FROM seg_small) seg JOIN grades_known USING (grade)"),
          _EL_ROUND, extra_ctes=[_SPARSE_CTES[0], ("seg_small", "SELECT * EXCLUDE (n_defaults) FROM seg_all WHERE n_loans >= 20")])
def q_expected_loss_sparse(spark, sf_dir):
    """Segments of an unknown grade and of a grade without a loss drop out."""
    seg = segments.segment_risk(_feat(spark, sf_dir), min_loans=20).withColumn("grade", F.nullif("grade", F.lit("G")))
    return loss.segment_expected_loss(seg, _known_grades(spark, sf_dir))
