"""Registry of named queries: Spark builder + DuckDB oracle text + compare rounding.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
fixture book of ``sf_dir``.  Output doubles are snapped to a grid identically on both
sides (``gate_snap``): money to 2 places, aggregate ratios to 9, row-level
derived values to 6, because sums of doubles depend on addition order.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendlens import oracle_sql as O
from lendlens.functions.numeric import gate_snap
from lendlens.operators.boosting import Binning, boosted_score, fit_boosting, root_splits
from lendlens.operators.isotonic import fit_isotonic
from lendlens.operators.logit import fit_logit, logit_gradient
from lendlens.operators.metrics import score_metrics
from lendlens.plans import cutoff, export, loss, policy, prep, reports, segments, vintage
from lendlens.plans.book import book
from lendlens.plans.risk_layer import risk_layer
from lendlens.plans.staging import staging_rejects, staging_sanity

Builder = Callable[[SparkSession, str], DataFrame]

TEXT = "text"      # rounding marker: emit a DATE column as ISO text
DOUBLE = "double"  # marker: emit a nullable INTEGER column as DOUBLE (pandas
                   # turns it into float64 from Spark, nullable Int32 from DuckDB)


@dataclass
class Query:
    name: str
    build: Builder
    sql: str | None
    rounding: dict = field(default_factory=dict)

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(spark, sf_dir)
        out = {}
        for c, d in self.rounding.items():
            out[c] = (F.col(c).cast("string") if d == TEXT else F.col(c).cast("double") if d == DOUBLE
                      else gate_snap(c, d))
        return df.withColumns(out) if out else df


REGISTRY: dict[str, Query] = {}


def register(name: str, sql_select: str | None, rounding: dict | None = None,
             extra_ctes: list | None = None, oracle: bool = True, dates: tuple = (), nullable_ints: tuple = ()):
    """Add a query.  ``dates`` lists DATE outputs, emitted as ISO text on both
    sides; ``nullable_ints`` lists INTEGER outputs that may hold NULL, emitted
    as DOUBLE on both sides."""
    rounding = dict(rounding or {})
    for c in dates:
        rounding[c] = TEXT
    for c in nullable_ints:
        rounding[c] = DOUBLE

    def deco(fn: Builder) -> Builder:
        sql = O.with_ctes(sql_select, extra_ctes or [], rounding) if (oracle and sql_select) else None
        REGISTRY[name] = Query(name, fn, sql, rounding)
        return fn
    return deco


def _feat(spark, sf_dir):
    return book(spark, sf_dir).features


# ---------------------------------------------------------------- staging
@register("staging_loans", "SELECT * FROM loans", dates=("issue_date", "last_pymnt_date"),
          nullable_ints=("term_months", "emp_length_yrs"))
def q_staging_loans(spark, sf_dir):
    return book(spark, sf_dir).loans


@register("staging_sanity",
          "SELECT COUNT(*) AS n_loans, AVG(is_default) AS default_rate, "
          "MIN(issue_date) AS first_vintage, MAX(issue_date) AS last_vintage FROM loans",
          dates=("first_vintage", "last_vintage"))
def q_staging_sanity(spark, sf_dir):
    return staging_sanity(book(spark, sf_dir).loans)


_KEPT = ("loan_status IN ('Fully Paid', 'Charged Off', 'Does not meet the credit policy. Status:Fully Paid', "
         "'Does not meet the credit policy. Status:Charged Off')")
_DONE = (f"{_KEPT} AND TRY_CAST(loan_amnt AS DOUBLE) IS NOT NULL AND TRY_CAST(annual_inc AS DOUBLE) IS NOT NULL "
         "AND issue_d IS NOT NULL")


@register("staging_rejects", f"""
SELECT COUNT(*) AS raw_rows,
  CAST(SUM(CASE WHEN loan_status IS NULL OR NOT ({_KEPT}) THEN 1 ELSE 0 END) AS BIGINT) AS open_or_unknown_status,
  CAST(SUM(CASE WHEN {_KEPT} AND TRY_CAST(loan_amnt AS DOUBLE) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS bad_amount,
  CAST(SUM(CASE WHEN {_KEPT} AND TRY_CAST(annual_inc AS DOUBLE) IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS bad_income,
  CAST(SUM(CASE WHEN {_KEPT} AND issue_d IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS no_issue_month,
  CAST(SUM(CASE WHEN {_DONE} AND try_strptime(trim(issue_d), '%b-%Y') IS NULL THEN 1 ELSE 0 END) AS BIGINT)
    AS unparsable_issue_month,
  CAST(SUM(CASE WHEN {_DONE} THEN 1 ELSE 0 END) AS BIGINT) AS kept
FROM raw""")
def q_staging_rejects(spark, sf_dir):
    return staging_rejects(book(spark, sf_dir).raw)


# ---------------------------------------------------------------- features
@register("feat_ratios", "SELECT loan_id, vintage_quarter, loan_to_income, payment_to_income FROM features",
          {"loan_to_income": 6, "payment_to_income": 6}, dates=("vintage_quarter",))
def q_feat_ratios(spark, sf_dir):
    return _feat(spark, sf_dir).select("loan_id", "vintage_quarter", "loan_to_income", "payment_to_income")


@register("feat_income_decile", "SELECT loan_id, annual_inc, income_decile FROM features")
def q_feat_income_decile(spark, sf_dir):
    return _feat(spark, sf_dir).select("loan_id", "annual_inc", "income_decile")


@register("feat_fico_quintile", "SELECT loan_id, fico, fico_quintile FROM features")
def q_feat_fico_quintile(spark, sf_dir):
    return _feat(spark, sf_dir).select("loan_id", "fico", "fico_quintile")


@register("feat_rate_rank", "SELECT loan_id, grade, int_rate, rate_rank_in_grade FROM features",
          {"rate_rank_in_grade": 9})
def q_feat_rate_rank(spark, sf_dir):
    return _feat(spark, sf_dir).select("loan_id", "grade", "int_rate", "rate_rank_in_grade")


@register("feat_dti_rank", "SELECT loan_id, grade, dti, dti_rank_in_grade FROM features",
          {"dti_rank_in_grade": 9})
def q_feat_dti_rank(spark, sf_dir):
    return _feat(spark, sf_dir).select("loan_id", "grade", "dti", "dti_rank_in_grade")


@register("feat_cohort_deviation", "SELECT loan_id, dti_vs_cohort, rate_vs_subgrade FROM features",
          {"dti_vs_cohort": 6, "rate_vs_subgrade": 6})
def q_feat_cohort_deviation(spark, sf_dir):
    return _feat(spark, sf_dir).select("loan_id", "dti_vs_cohort", "rate_vs_subgrade")


# ---------------------------------------------------------------- segments
_SEG_ROUND = {"disbursed": 2, "default_rate": 9, "avg_fico": 9, "avg_rate": 9, "defaulted_amount": 2}


@register("segment_base", "SELECT * FROM seg_all", _SEG_ROUND)
def q_segment_base(spark, sf_dir):
    return segments.segment_base(_feat(spark, sf_dir))


@register("segment_risk", "SELECT * FROM seg", {**_SEG_ROUND, "lift_vs_book": 9})
def q_segment_risk(spark, sf_dir):
    return segments.segment_risk(_feat(spark, sf_dir))


@register("top_segments", """
SELECT grade, purpose, income_decile, n_loans, {dp} AS default_pct, {lf} AS lift
FROM seg ORDER BY default_rate DESC, grade, purpose, income_decile LIMIT 15
""".format(dp=O.round_half_away_sql("default_rate * 100", 1), lf=O.round_half_away_sql("lift_vs_book", 2)))
def q_top_segments(spark, sf_dir):
    return segments.top_segments(segments.segment_risk(_feat(spark, sf_dir)))


# ---------------------------------------------------------------- vintage
@register("cohort_sizes", "SELECT * FROM cohorts", dates=("vintage_quarter",))
def q_cohort_sizes(spark, sf_dir):
    return vintage.cohort_sizes(_feat(spark, sf_dir))


@register("defaults_by_mob", "SELECT * FROM dmob", dates=("vintage_quarter",))
def q_defaults_by_mob(spark, sf_dir):
    return vintage.defaults_by_mob(_feat(spark, sf_dir))


@register("vintage_curves", "SELECT * FROM curves", {"cum_default_rate": 9}, dates=("vintage_quarter",))
def q_vintage_curves(spark, sf_dir):
    return reports.in_order(vintage.vintage_curves(_feat(spark, sf_dir)), "vintage_curves")


@register("vintage_by_year", """
SELECT CAST(strftime(vintage_quarter, '%Y') AS INTEGER) AS yr, mob, SUM(cum_default_rate) / COUNT(*) AS cum_dr
FROM curves GROUP BY ALL HAVING mob < 49
""", {"cum_dr": 9})
def q_vintage_by_year(spark, sf_dir):
    return vintage.vintage_by_year(vintage.vintage_curves(_feat(spark, sf_dir)))


@register("vintage_by_year_window", """
SELECT yr, mob, AVG(cum_default_rate) AS cum_dr
FROM (SELECT CAST(year(vintage_quarter) AS INTEGER) AS yr, * FROM curves)
WHERE yr BETWEEN 1996 AND 2000 AND mob <= 48
GROUP BY yr, mob
""", {"cum_dr": 9})
def q_vintage_by_year_window(spark, sf_dir):
    return vintage.vintage_by_year(vintage.vintage_curves(_feat(spark, sf_dir)), 1996, 2000)


@register("vintage_mob36", """
SELECT yr, AVG(cum_default_rate) AS cum_dr
FROM (SELECT CAST(year(vintage_quarter) AS INTEGER) AS yr, * FROM curves) WHERE mob = 36
GROUP BY yr
""", {"cum_dr": 9})
def q_vintage_mob36(spark, sf_dir):
    return vintage.vintage_at_mob(vintage.vintage_curves(_feat(spark, sf_dir)), 36)


@register("vintage_observed36", """
SELECT * FROM curves
WHERE date_diff('month', vintage_quarter, (SELECT MAX(last_pymnt_date) FROM features)) >= 36
""", {"cum_default_rate": 9}, dates=("vintage_quarter",))
def q_vintage_observed36(spark, sf_dir):
    f = _feat(spark, sf_dir)
    return vintage.observed_curves(vintage.vintage_curves(f), f, 36)


# ---------------------------------------------------------------- loss
_GRADE_ROUND = {"pd_observed": 9, "disbursed": 2, "net_loss": 2, "lgd": 9, "loss_rate": 9}


@register("grade_loss", "SELECT * FROM grades", _GRADE_ROUND)
def q_grade_loss(spark, sf_dir):
    return reports.in_order(loss.grade_loss(_feat(spark, sf_dir)), "grade_loss")


_EL_SQL = """
SELECT grade, purpose, income_decile, n_loans, disbursed, pd, lgd,
  el_rate * disbursed AS expected_loss, el_rate, avg_rate / 100 - el_rate AS approx_margin
FROM (SELECT seg.*, default_rate AS pd, lgd, default_rate * lgd AS el_rate
      FROM seg JOIN (SELECT grade, lgd FROM grades) USING (grade))
"""
_EL_ROUND = {"disbursed": 2, "pd": 9, "lgd": 9, "expected_loss": 2, "el_rate": 9, "approx_margin": 9}


def _expected_loss(spark, sf_dir):
    f = _feat(spark, sf_dir)
    return loss.segment_expected_loss(segments.segment_risk(f), loss.grade_loss(f))


@register("segment_expected_loss", _EL_SQL, _EL_ROUND)
def q_segment_expected_loss(spark, sf_dir):
    return reports.in_order(_expected_loss(spark, sf_dir), "segment_expected_loss")


# ---------------------------------------------------------------- exports
FACT_COLUMNS = export.FACT_COLUMNS


@register("fact_loans", f"SELECT {', '.join(FACT_COLUMNS)} FROM features", {"loan_to_income": 6},
          dates=("vintage_quarter", "issue_date"), nullable_ints=("term_months",))
def q_fact_loans(spark, sf_dir):
    return export.fact_loans(_feat(spark, sf_dir))


# ---------------------------------------------------------------- policy / split / prep
@register("policy_declines", """
SELECT COUNT(*) AS n_loans, CAST(SUM(CASE WHEN declined THEN 1 ELSE 0 END) AS BIGINT) AS n_declined,
  AVG(CASE WHEN declined THEN 1.0 ELSE 0.0 END) AS decline_share,
  AVG(CASE WHEN declined THEN is_default END) AS default_rate_declined
FROM pol""", {"decline_share": 9, "default_rate_declined": 9}, extra_ctes=O.MODEL_CTES)
def q_policy_declines(spark, sf_dir):
    return policy.policy_summary(_feat(spark, sf_dir))


@register("oot_cutoff_date", """
SELECT cutoff_days, CAST(DATE '1970-01-01' + CAST(floor(cutoff_days) AS INTEGER) AS DATE) AS cutoff_date
FROM cut""", {"cutoff_days": 6}, extra_ctes=O.MODEL_CTES, dates=("cutoff_date",))
def q_oot_cutoff_date(spark, sf_dir):
    return policy.oot_cutoff(policy.passing(_feat(spark, sf_dir)))


@register("oot_split_counts", """
SELECT 'train' AS split, COUNT(*) AS n_loans, AVG(is_default) AS default_rate,
  MIN(issue_date) AS min_issue_date, MAX(issue_date) AS max_issue_date FROM train
UNION ALL
SELECT 'test', COUNT(*), AVG(is_default), MIN(issue_date), MAX(issue_date) FROM test""",
          {"default_rate": 9}, extra_ctes=O.MODEL_CTES, dates=("min_issue_date", "max_issue_date"))
def q_oot_split_counts(spark, sf_dir):
    p = policy.passing(_feat(spark, sf_dir))
    _, _, cut = policy.oot_split(p)
    return policy.split_counts(p, cut)


@register("impute_medians", O.medians_sql(policy.NUMERIC), {"median": 6}, extra_ctes=O.MODEL_CTES)
def q_impute_medians(spark, sf_dir):
    train, _, _ = policy.oot_split(policy.passing(_feat(spark, sf_dir)))
    return prep.long_table(spark, {"median": prep.medians(train)}, policy.NUMERIC)


_prep_ctes, _prep_sql = O.prep_stats_sql(policy.NUMERIC)


@register("scale_stats", _prep_sql, {"median": 6, "mean": 4, "std": 4}, extra_ctes=O.MODEL_CTES + _prep_ctes)
def q_scale_stats(spark, sf_dir):
    train, _, _ = policy.oot_split(policy.passing(_feat(spark, sf_dir)))
    return prep.prep_stats_frame(train)


# ---------------------------------------------------------------- scores and cutoffs
@register("score_metrics", """
SELECT 'score' AS model, (SELECT COUNT(*) FROM s0) AS n, a.auc, 2 * a.auc - 1 AS gini,
  (SELECT AVG((pd_hat - is_default) * (pd_hat - is_default)) FROM s0) AS brier
FROM (SELECT SUM(pos * (below + 0.5 * neg)) / (SUM(pos) * SUM(neg)) AS auc FROM sg) a""",
          {"auc": 9, "gini": 9, "brier": 9},
          extra_ctes=O.SCORE_CTES + [
              ("s0", "SELECT pd_hat, is_default FROM sc WHERE pd_hat IS NOT NULL"),
              ("sg0", "SELECT pd_hat, CAST(SUM(is_default) AS DOUBLE) AS pos, "
                      "CAST(COUNT(*) - SUM(is_default) AS DOUBLE) AS neg FROM s0 GROUP BY pd_hat"),
              ("sg", "SELECT pos, neg, COALESCE(SUM(neg) OVER (ORDER BY pd_hat ROWS BETWEEN UNBOUNDED "
                     "PRECEDING AND 1 PRECEDING), 0) AS below FROM sg0")])
def q_score_metrics(spark, sf_dir):
    return score_metrics(cutoff.deterministic_scores(_feat(spark, sf_dir)), "pd_hat", "is_default")


_CUT_ROUND = {"approval_rate": 9, "default_rate": 9, "disbursed_share": 9, "loss_per_100cr_inr": 9}


def _cutoff_table(spark, sf_dir):
    f = _feat(spark, sf_dir)
    return cutoff.cutoff_table(cutoff.deterministic_scores(f), loss.grade_loss(f))


@register("cutoff_table", "SELECT * FROM ctab", _CUT_ROUND, extra_ctes=O.SCORE_CTES)
def q_cutoff_table(spark, sf_dir):
    return _cutoff_table(spark, sf_dir)


@register("cutoff_marginal", """
SELECT pd_cutoff, LAG(pd_cutoff, 5) OVER w AS from_cutoff,
  (approval_rate - LAG(approval_rate, 5) OVER w) * 100 AS d_approval_pp,
  (default_rate - LAG(default_rate, 5) OVER w) * 100 AS d_default_pp,
  loss_per_100cr_inr - LAG(loss_per_100cr_inr, 5) OVER w AS d_loss_per_100
FROM ctab WINDOW w AS (ORDER BY pd_cutoff DESC)""",
          {"d_approval_pp": 7, "d_default_pp": 7, "d_loss_per_100": 7}, extra_ctes=O.SCORE_CTES)
def q_cutoff_marginal(spark, sf_dir):
    return cutoff.cutoff_marginal(_cutoff_table(spark, sf_dir))


@register("cutoff_at_25", "SELECT * FROM ctab WHERE abs(pd_cutoff - 0.25) < 1e-9", _CUT_ROUND,
          extra_ctes=O.SCORE_CTES)
def q_cutoff_at_25(spark, sf_dir):
    return cutoff.cutoff_lookup(_cutoff_table(spark, sf_dir), 0.25)


@register("book_baseline", """
SELECT COUNT(*) AS n, AVG(is_default) AS default_rate,
  SUM(CASE WHEN is_default = 1 THEN loan_amnt * lgd ELSE 0 END) / SUM(loan_amnt) * 100 AS loss_per_100cr_inr
FROM scf""", {"default_rate": 9, "loss_per_100cr_inr": 9}, extra_ctes=O.SCORE_CTES)
def q_book_baseline(spark, sf_dir):
    f = _feat(spark, sf_dir)
    return cutoff.book_baseline(cutoff.deterministic_scores(f), loss.grade_loss(f))


# ---------------------------------------------------------------- reports
@register("grade_overview", """
SELECT grade, n_loans, pd_observed * 100 AS default_pct, avg_rate_pct, avg_fico, avg_dti,
  disbursed / 1000000000 AS disbursed_bn_usd
FROM grades JOIN (SELECT grade, AVG(int_rate) AS avg_rate_pct, AVG(fico) AS avg_fico, AVG(dti) AS avg_dti
                  FROM loans GROUP BY grade) USING (grade)""",
          {"default_pct": 9, "avg_rate_pct": 8, "avg_fico": 9, "avg_dti": 8, "disbursed_bn_usd": 6})
def q_grade_overview(spark, sf_dir):
    return reports.grade_overview(_feat(spark, sf_dir))


@register("verification_profile", """
SELECT verification_status, n, 100 * defaults / n AS default_pct, income / n AS avg_income,
  debt / with_debt AS avg_dti, rate / with_rate AS avg_rate
FROM (SELECT verification_status, CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(is_default) AS DOUBLE) AS defaults, SUM(annual_inc) AS income,
        SUM(dti) AS debt, COUNT(dti) AS with_debt, SUM(int_rate) AS rate, COUNT(int_rate) AS with_rate FROM features GROUP BY ALL)""", {"default_pct": 9, "avg_income": 4, "avg_dti": 8, "avg_rate": 8})
def q_verification_profile(spark, sf_dir):
    return reports.verification_profile(_feat(spark, sf_dir))


_HEAT = """SELECT grade, income_decile, CAST(SUM(n_defaults) AS DOUBLE) / SUM(n_loans) AS default_rate,
  SUM(defaulted_amount) / SUM(disbursed) AS bad_share FROM (FROM seg_all WHERE n_loans >= 200) GROUP BY ALL"""


@register("heatmap_long", _HEAT, {"default_rate": 9, "bad_share": 9})
def q_heatmap_long(spark, sf_dir):
    return reports.heatmap_long(segments.segment_risk(_feat(spark, sf_dir)))


@register("heatmap_pivot", "SELECT grade, " + ", ".join(
    f"MAX(CASE WHEN income_decile = {i} THEN default_rate END) AS d{i}" for i in range(1, 11))
          + " FROM heat GROUP BY grade", {f"d{i}": 9 for i in range(1, 11)}, extra_ctes=[("heat", _HEAT)])
def q_heatmap_pivot(spark, sf_dir):
    return reports.heatmap_pivot(segments.segment_risk(_feat(spark, sf_dir)))


_KPI = """SELECT SUM(loan_amnt) AS disbursed, SUM(loan_amnt) * 83 / 10000000 AS disbursed_cr,
  COUNT(*) AS n_loans, SUM(is_default) / COUNT(*) AS default_rate,
  SUM(CASE WHEN is_default = 1 THEN loan_amnt - actual_total_pymnt - actual_recoveries ELSE 0 END)
    / SUM(loan_amnt) AS loss_rate, AVG(fico) AS avg_fico FROM features"""
_KPI_ROUND = {"disbursed": 2, "disbursed_cr": 4, "default_rate": 9, "loss_rate": 9, "avg_fico": 9}
_SLICE = dict(term_months=36, grades=("A", "B", "C"), purposes=("debt_consolidation",), vintage_year=1998)


@register("portfolio_kpis", _KPI, _KPI_ROUND)
def q_portfolio_kpis(spark, sf_dir):
    return reports.portfolio_kpis(_feat(spark, sf_dir))


@register("portfolio_kpis_sliced", _KPI + """ WHERE term_months = 36 AND grade IN ('A', 'B', 'C')
  AND purpose IN ('debt_consolidation') AND year(issue_date) = 1998""", _KPI_ROUND)
def q_portfolio_kpis_sliced(spark, sf_dir):
    return reports.portfolio_kpis(_feat(spark, sf_dir), **_SLICE)


@register("portfolio_kpis_empty_slice", _KPI + " WHERE year(issue_date) = 2050", _KPI_ROUND)
def q_portfolio_kpis_empty_slice(spark, sf_dir):
    """A selection without loans gives blank (NULL) rates, not an error."""
    return reports.portfolio_kpis(_feat(spark, sf_dir), vintage_year=2050)


@register("default_by_grade", "SELECT grade, COUNT(*) AS n_loans, SUM(is_default) / COUNT(*) AS default_rate "
          "FROM features GROUP BY grade", {"default_rate": 9})
def q_default_by_grade(spark, sf_dir):
    return reports.default_by(_feat(spark, sf_dir), "grade")


@register("default_by_year", "SELECT CAST(year(issue_date) AS INTEGER) AS yr, COUNT(*) AS n_loans, "
          "SUM(is_default) / COUNT(*) AS default_rate FROM features GROUP BY 1", {"default_rate": 9})
def q_default_by_year(spark, sf_dir):
    return reports.default_by_year(_feat(spark, sf_dir))


@register("disbursed_by_purpose", "SELECT purpose, SUM(loan_amnt) AS disbursed, COUNT(*) AS n_loans "
          "FROM features GROUP BY purpose", {"disbursed": 2})
def q_disbursed_by_purpose(spark, sf_dir):
    return reports.disbursed_by_purpose(_feat(spark, sf_dir))


@register("default_lift", """
SELECT grade, COUNT(*) AS n_loans, SUM(is_default) / COUNT(*) AS default_rate,
  (SUM(is_default) / COUNT(*)) / (SELECT AVG(is_default) FROM features) AS lift
FROM features WHERE term_months = 36 GROUP BY grade""", {"default_rate": 9, "lift": 9})
def q_default_lift(spark, sf_dir):
    return reports.default_lift(_feat(spark, sf_dir), "grade", term_months=36)


@register("bad_share", "SELECT grade, SUM(loan_amnt) FILTER (WHERE is_default = 1) / SUM(loan_amnt) AS bad_share "
          "FROM features GROUP BY grade", {"bad_share": 9})
def q_bad_share(spark, sf_dir):
    return reports.bad_share(_feat(spark, sf_dir))


@register("worst_pocket", """SELECT * FROM seg WHERE grade IN ('D', 'E', 'F', 'G')
  AND purpose = 'debt_consolidation' AND income_decile <= 5""", {**_SEG_ROUND, "lift_vs_book": 9})
def q_worst_pocket(spark, sf_dir):
    return reports.worst_pocket(segments.segment_risk(_feat(spark, sf_dir)), ("D", "E", "F", "G"),
                                "debt_consolidation", 5)


def _density_sql(col: str) -> str:
    return f"""
WITH st AS (SELECT is_default AS cls, COUNT(*) AS n, stddev_samp({col}) * pow(COUNT(*), -0.2) AS h,
              MIN({col}) AS lo, MAX({col}) AS hi FROM features WHERE {col} IS NOT NULL GROUP BY is_default),
gr AS (SELECT cls, k, CASE WHEN k = 199 THEN hi + 3 * h
                           ELSE (lo - 3 * h) + k * (((hi + 3 * h) - (lo - 3 * h)) / 199.0) END AS x, h, n
       FROM st, range(200) t(k)),
dv AS (SELECT is_default AS cls, {col} AS v, COUNT(*) AS c FROM features WHERE {col} IS NOT NULL GROUP BY 1, 2)
SELECT gr.cls AS is_default, gr.k AS grid_index, any_value(gr.x) AS x,
  SUM(dv.c * exp(-0.5 * ((gr.x - dv.v) / gr.h) * ((gr.x - dv.v) / gr.h)))
    / (any_value(gr.n) * any_value(gr.h) * sqrt(2 * pi())) AS density
FROM gr JOIN dv USING (cls) GROUP BY gr.cls, gr.k"""


for _col, _name in (("int_rate", "density_rate"), ("fico", "density_fico"), ("dti", "density_dti")):
    def _mk(col):
        def build(spark, sf_dir):
            return reports.class_density(_feat(spark, sf_dir), col)
        return build
    register(_name, None)(_mk(_col))
    REGISTRY[_name].sql = O.with_ctes("SELECT * FROM dens", [("dens", _density_sql(_col).replace(
        "WITH st AS", "SELECT * FROM (WITH st AS") + ")")], {"x": 6, "density": 9})
    REGISTRY[_name].rounding = {"x": 6, "density": 9}


@register("sample_loans", """
SELECT loan_id, is_default, int_rate, fico, dti, loan_to_income FROM features
ORDER BY md5(coalesce(loan_id, '') || '42'), loan_id LIMIT 150000""", {"loan_to_income": 6})
def q_sample_loans(spark, sf_dir):
    return reports.sample_loans(_feat(spark, sf_dir))


@register("sample_loans_500", """
SELECT loan_id, is_default, int_rate, fico, dti, loan_to_income FROM features
ORDER BY md5(coalesce(loan_id, '') || '42'), loan_id LIMIT 500""", {"loan_to_income": 6})
def q_sample_loans_500(spark, sf_dir):
    return reports.sample_loans(_feat(spark, sf_dir), n=500)


# ---------------------------------------------------------------- model parts with an exact counterpart in SQL
@register("isotonic_fixture", """
SELECT MIN(x) AS lo, MAX(x) AS hi, SUM(w) AS weight, SUM(t) / SUM(w) AS value FROM ic JOIN iv USING (i) GROUP BY round(value, 12)""",
          {"value": 9}, extra_ctes=O.SCORE_CTES + O.ISOTONIC_CTES)
def q_isotonic_fixture(spark, sf_dir):
    """M8: the calibration map of the fixture score."""
    return fit_isotonic(cutoff.deterministic_scores(_feat(spark, sf_dir)), "pd_hat", "is_default")


def _train(spark, sf_dir):
    return policy.oot_split(policy.passing(_feat(spark, sf_dir)))[0]


_LOGIT_NAMES = ["intercept", *O.LOGIT_INPUTS]


def _logit_rows(spark, sf_dir):
    known = [F.col(c).isNotNull() for c in O.LOGIT_INPUTS]
    x = F.array(*[(F.col(c) - m) / s for c, (m, s) in O.LOGIT_INPUTS.items()])
    return _train(spark, sf_dir).filter(known[0] & known[1]).select(x.alias("x"), F.col("is_default").alias("y"))


@register("logit_coefficients", f"""
SELECT '{_LOGIT_NAMES[0]}' AS input, b0 AS coefficient FROM nw{O.NEWTON_STEPS} UNION ALL SELECT '{_LOGIT_NAMES[1]}', b1 FROM nw{O.NEWTON_STEPS}
UNION ALL SELECT '{_LOGIT_NAMES[2]}', b2 FROM nw{O.NEWTON_STEPS}""", {"coefficient": 8}, extra_ctes=O.MODEL_CTES + O.newton_ctes())
def q_logit_coefficients(spark, sf_dir):
    """M6: penalised logistic fit of the training loans on two inputs."""
    model = fit_logit(_logit_rows(spark, sf_dir), "x", "y")
    return spark.createDataFrame(list(zip(_LOGIT_NAMES, map(float, model.coefficients))), "input string, coefficient double")


@register("logit_gradient", f"""
SELECT '{_LOGIT_NAMES[0]}' AS input, abs(g0) < 1e-6 AS optimal FROM ng{O.NEWTON_STEPS - 1}
UNION ALL SELECT '{_LOGIT_NAMES[1]}', abs(g1) < 1e-6 FROM ng{O.NEWTON_STEPS - 1}
UNION ALL SELECT '{_LOGIT_NAMES[2]}', abs(g2) < 1e-6 FROM ng{O.NEWTON_STEPS - 1}""", extra_ctes=O.MODEL_CTES + O.newton_ctes())
def q_logit_gradient(spark, sf_dir):
    """M6: the penalised gradient vanishes at the fit (both engines at their own coefficients)."""
    rows = _logit_rows(spark, sf_dir)
    gradient = logit_gradient(rows, "x", "y", fit_logit(rows, "x", "y"))
    return spark.createDataFrame([(n, bool(abs(g) < 1e-6)) for n, g in zip(_LOGIT_NAMES, gradient)], "input string, optimal boolean")


_GBT_NAMES = [*O.GBT_EDGES, *O.GBT_LEVELS]


@register("gbt_first_split", "SELECT CASE k " + " ".join(f"WHEN {k} THEN '{c}'" for k, c in enumerate(_GBT_NAMES, 1)) + """ END AS input,
  CAST(b AS BIGINT) AS bin, m = 1 AS missing_left, gain, CAST(nl AS BIGINT) AS n_left, CAST(nr AS BIGINT) AS n_right
FROM (SELECT *, MAX(gain) OVER (PARTITION BY k) AS top FROM cand0) WHERE gain >= top * (1 - 1e-10)
QUALIFY row_number() OVER (PARTITION BY k ORDER BY b, m) = 1""", {"gain": 6}, extra_ctes=O.MODEL_CTES + O.boosting_ctes())
def q_gbt_first_split(spark, sf_dir):
    """M7: the best split of every input over the training loans."""
    found = root_splits(_train(spark, sf_dir), Binning(O.GBT_EDGES, O.GBT_LEVELS), "is_default")
    rows = [(c, s.at, s.missing_left, s.gain, int(s.left[2]), int(s.right[2])) for c, s in zip(_GBT_NAMES, found) if s]
    return spark.createDataFrame(rows, "input string, bin bigint, missing_left boolean, gain double, n_left bigint, n_right bigint")


@register("gbt_leaf_values", """
SELECT COUNT(*) AS n_loans, -0.08 * SUM(g) / SUM(h) AS value FROM (
  SELECT g, h, node, CASE WHEN node = chosen THEN CASE WHEN category = 1 THEN bins[k] <> b WHEN bins[k] = 255 THEN m = 1 ELSE bins[k] <= b END END AS side
  FROM node1, (SELECT * EXCLUDE (node), node AS chosen FROM split1 ORDER BY gain DESC, node LIMIT 1))
GROUP BY node, side""", {"value": 8}, extra_ctes=O.MODEL_CTES + O.boosting_ctes())
def q_gbt_leaf_values(spark, sf_dir):
    """M7, M9: leaves of one round with three leaves, as the training loans are scored by it."""
    train = _train(spark, sf_dir)
    model = fit_boosting(train, Binning(O.GBT_EDGES, O.GBT_LEVELS), "is_default", rounds=1, leaves=3, depth=2, patience=None)[0]
    return train.groupBy((boosted_score(model) - F.lit(model.start)).alias("value")).agg(F.count(F.lit(1)).alias("n_loans"))


# ---------------------------------------------------------------- models (rows-only checks)

@register("model_metrics", None)
def q_model_metrics(spark, sf_dir):
    return book(spark, sf_dir).models().metrics


@register("model_scores", None)
def q_model_scores(spark, sf_dir):
    return book(spark, sf_dir).models().scores


@register("model_cutoff_table", None)
def q_model_cutoff_table(spark, sf_dir):
    b = book(spark, sf_dir)
    return cutoff.cutoff_table(b.models().scores, loss.grade_loss(b.features))


# ---------------------------------------------------------------- one-scan risk layer
@register("risk_layer_segments", "SELECT * FROM seg", {**_SEG_ROUND, "lift_vs_book": 9})
def q_risk_layer_segments(spark, sf_dir):
    return risk_layer(_feat(spark, sf_dir))["segment_risk"]


@register("risk_layer_grades", "SELECT * FROM grades", _GRADE_ROUND)
def q_risk_layer_grades(spark, sf_dir):
    return risk_layer(_feat(spark, sf_dir))["grade_loss"]


@register("risk_layer_curves", "SELECT * FROM curves", {"cum_default_rate": 9}, dates=("vintage_quarter",))
def q_risk_layer_curves(spark, sf_dir):
    return risk_layer(_feat(spark, sf_dir))["vintage_curves"]


from lendlens import catalog_io  # noqa: E402, F401 (registers the source and sink queries)


def queries() -> dict[str, Builder]:
    return {name: q.run for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q.sql for name, q in REGISTRY.items() if q.sql}
