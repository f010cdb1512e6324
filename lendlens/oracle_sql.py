"""DuckDB texts of the same queries, for the correctness gate.

Every text starts from the fixture raw view and rebuilds the layers from
their definitions: tiles and percent ranks by arithmetic on single-node row
numbers and ranks, cohort means and running sums by joins.  Tie-breaks: tiles
order by the key then ``loan_id``; NULLs sort last.
"""

from __future__ import annotations

from lendlens.functions.numeric import gate_snap_sql, round_half_away_sql  # noqa: F401 (re-export)
from lendlens.sources.fixture import raw_view_sql

# SQL that types one raw text column, by kind
_KINDS = {
    "text": "{0}",
    "number": "TRY_CAST({0} AS DOUBLE)",
    "percent": "TRY_CAST(rtrim({0}, '%') AS DOUBLE)",
    "digits": "TRY_CAST(regexp_extract({0}, '[0-9]+') AS INTEGER)",
    "years": "TRY_CAST(regexp_extract({0}, '[0-9]+') AS INTEGER) - CAST(starts_with({0}, '<') AS INTEGER)",
    "month": "CASE WHEN {0} <> '' THEN strptime({0}, '%b-%Y')::DATE END",
    "charged_off": "CAST(contains({0}, 'Charged Off') AS INTEGER)",
}

# Loan column, raw column (same name when empty), kind
_COLUMNS = (
    ("loan_id", "id", "text"), ("is_default", "loan_status", "charged_off"), ("loan_amnt", "", "number"),
    ("term_months", "term", "digits"), ("int_rate", "", "percent"), ("installment", "", "number"),
    ("grade", "", "text"), ("sub_grade", "", "text"), ("purpose", "", "text"),
    ("emp_length_yrs", "emp_length", "years"), ("home_ownership", "", "text"), ("annual_inc", "", "number"),
    ("verification_status", "", "text"), ("dti", "", "number"), ("fico_low", "fico_range_low", "number"),
    ("fico_high", "fico_range_high", "number"), ("open_acc", "", "number"), ("pub_rec", "", "number"),
    ("revol_bal", "", "number"), ("revol_util", "", "percent"), ("total_acc", "", "number"),
    ("mort_acc", "", "number"), ("delinq_2yrs", "", "number"), ("inq_last_6mths", "", "number"),
    ("addr_state", "", "text"), ("application_type", "", "text"), ("issue_date", "issue_d", "month"),
    ("last_pymnt_date", "last_pymnt_d", "month"), ("actual_total_pymnt", "total_pymnt", "number"),
    ("actual_recoveries", "recoveries", "number"),
)

# A completed loan's status, with or without this prefix
_ENDED = ("Fully Paid", "Charged Off")
_OFF_POLICY = "Does not meet the credit policy. Status:"

TYPED = ("SELECT " + ", ".join(f"{_KINDS[kind].format(raw or name)} AS {name}" for name, raw, kind in _COLUMNS)
         + " FROM raw WHERE loan_status IN (" + ", ".join(f"'{p}{e}'" for p in ("", _OFF_POLICY) for e in _ENDED) + ")")

LOANS = """
SELECT * EXCLUDE (fico_low, fico_high), fico_low + (fico_high - fico_low) / 2 AS fico
FROM typed WHERE loan_amnt IS NOT NULL AND annual_inc IS NOT NULL AND issue_date IS NOT NULL
"""

RANKED = """
SELECT *, row_number() OVER (ORDER BY annual_inc NULLS LAST, loan_id) - 1 AS by_income,
  row_number() OVER (ORDER BY fico NULLS LAST, loan_id) - 1 AS by_fico,
  count(*) OVER () AS n_book, count(*) OVER (PARTITION BY grade) - 1 AS n_others,
  rank() OVER (PARTITION BY grade ORDER BY int_rate NULLS LAST) - 1 AS cheaper,
  rank() OVER (PARTITION BY grade ORDER BY dti NULLS LAST) - 1 AS less_indebted
FROM loans
"""


def _tile(position: str, k: int) -> str:
    """Tile 1..k of a 0-based position: the first n_book % k tiles hold one row more."""
    wide = f"((n_book % {k}) * (n_book // {k} + 1))"
    return (f"1 + CASE WHEN {position} < {wide} THEN {position} // (n_book // {k} + 1) "
            f"ELSE n_book % {k} + ({position} - {wide}) // greatest(n_book // {k}, 1) END")


FEATURES = f"""
SELECT r.* EXCLUDE (by_income, by_fico, n_book, n_others, cheaper, less_indebted),
  make_date(year(issue_date), 3 * quarter(issue_date) - 2, 1) AS vintage_quarter,
  CASE WHEN annual_inc <> 0 THEN loan_amnt / annual_inc END AS loan_to_income,
  CASE WHEN annual_inc <> 0 THEN 12 * installment / annual_inc END AS payment_to_income,
  {_tile("by_income", 10)} AS income_decile, {_tile("by_fico", 5)} AS fico_quintile,
  cheaper / greatest(n_others, 1) AS rate_rank_in_grade, less_indebted / greatest(n_others, 1) AS dti_rank_in_grade,
  r.dti - c.dti AS dti_vs_cohort, r.int_rate - s.int_rate AS rate_vs_subgrade
FROM ranked r
JOIN (SELECT grade, term_months, AVG(dti) AS dti FROM loans GROUP BY ALL) c
  ON r.grade IS NOT DISTINCT FROM c.grade AND r.term_months IS NOT DISTINCT FROM c.term_months
JOIN (SELECT sub_grade, AVG(int_rate) AS int_rate FROM loans GROUP BY ALL) s
  ON r.sub_grade IS NOT DISTINCT FROM s.sub_grade
"""

SEG_ALL = """
SELECT grade, purpose, income_decile, COUNT(*) AS n_loans, SUM(loan_amnt) AS disbursed,
  AVG(is_default) AS default_rate, AVG(fico) AS avg_fico, AVG(int_rate) AS avg_rate,
  SUM(loan_amnt) FILTER (WHERE is_default = 1) AS defaulted_amount,
  COUNT(*) FILTER (WHERE is_default = 1) AS n_defaults
FROM features GROUP BY ALL
"""

SEG = """
SELECT a.* EXCLUDE (n_defaults), default_rate / NULLIF(book_rate, 0) AS lift_vs_book,
  1 + (SELECT COUNT(*) FROM seg_all b WHERE b.n_loans >= 200 AND b.default_rate > a.default_rate) AS risk_rank
FROM seg_all a, (SELECT SUM(n_defaults) / SUM(n_loans) AS book_rate FROM seg_all)
WHERE n_loans >= 200
"""

DEFAULTED = """
SELECT grade, vintage_quarter, loan_amnt, loan_amnt - actual_total_pymnt - actual_recoveries AS shortfall,
  GREATEST(1, 12 * (year(last_pymnt_date) - year(issue_date)) + month(last_pymnt_date) - month(issue_date)) AS mob,
  last_pymnt_date IS NOT NULL AS dated
FROM features WHERE is_default = 1
"""

GRADES = """
WITH lost AS (SELECT grade, COUNT(*) AS n, SUM(shortfall) AS shortfall, SUM(loan_amnt) AS exposed FROM defaulted GROUP BY ALL)
SELECT lent.grade, n_loans, COALESCE(n, 0) / n_loans AS pd_observed, disbursed, COALESCE(shortfall, 0) AS net_loss,
  GREATEST(0, shortfall / NULLIF(exposed, 0)) AS lgd, COALESCE(shortfall, 0) / disbursed AS loss_rate
FROM (SELECT grade, COUNT(*) AS n_loans, SUM(loan_amnt) AS disbursed FROM features GROUP BY ALL) lent
LEFT JOIN lost ON lent.grade IS NOT DISTINCT FROM lost.grade
"""

COHORTS = "SELECT vintage_quarter, COUNT(*) AS cohort_n FROM features GROUP BY ALL"

DMOB = "SELECT vintage_quarter, mob, COUNT(*) AS n_defaults FROM defaulted WHERE dated AND mob <= 60 GROUP BY ALL"

CURVES = """
SELECT cur.vintage_quarter, cur.mob, any_value(cur.n_defaults) AS n_defaults, any_value(cohort_n) AS cohort_n,
  SUM(upto.n_defaults) / any_value(cohort_n) AS cum_default_rate
FROM dmob cur JOIN dmob upto ON upto.vintage_quarter = cur.vintage_quarter AND upto.mob <= cur.mob
JOIN cohorts ON cohorts.vintage_quarter = cur.vintage_quarter
GROUP BY cur.vintage_quarter, cur.mob
"""

# name -> CTE body, in dependency order
BASE_CTES = [
    ("raw", raw_view_sql("duckdb")),
    ("typed", TYPED),
    ("loans", LOANS),
    ("ranked", RANKED),
    ("features", FEATURES),
    ("seg_all", SEG_ALL),
    ("seg", SEG),
    ("defaulted", DEFAULTED),
    ("grades", GRADES),
    ("cohorts", COHORTS),
    ("dmob", DMOB),
    ("curves", CURVES),
]


def with_ctes(select: str, extra: list[tuple[str, str]] = (), rounding: dict | None = None) -> str:
    """Full query text: base CTEs, extra CTEs, the select, then output rounding."""
    ctes = list(BASE_CTES) + list(extra)
    body = ",\n".join(f"{n} AS ({t})" for n, t in ctes)
    if not rounding:
        return f"WITH {body}\n{select}"
    sel = f"WITH {body},\n__q AS ({select})\n"
    def conv(c, d):
        if d == "text":
            return f"CAST({c} AS VARCHAR)"
        if d == "double":
            return f"CAST({c} AS DOUBLE)"
        return gate_snap_sql(c, d)
    repl = ", ".join(f"{conv(c, d)} AS {c}" for c, d in rounding.items())
    return sel + f"SELECT * REPLACE ({repl}) FROM __q"


_DAYS = "date_diff('day', DATE '1970-01-01', issue_date)"

MODEL_CTES = [
    ("pol", """SELECT *, (COALESCE(dti > 60, false) OR COALESCE(fico < 640, false)
        OR COALESCE(revol_util > 120, false)
        OR COALESCE(annual_inc < 200000.0 / 83.0
                    AND (CASE WHEN annual_inc = 0 THEN loan_amnt > 0 ELSE loan_amnt / annual_inc > 0.8 END),
                    false)) AS declined
      FROM features"""),
    ("passing", "SELECT * FROM pol WHERE NOT declined"),
    ("cut", f"SELECT quantile_cont({_DAYS}, 0.8) AS cutoff_days FROM passing"),
    ("train", f"SELECT * FROM passing WHERE {_DAYS} <= (SELECT cutoff_days FROM cut)"),
    ("test", f"SELECT * FROM passing WHERE {_DAYS} > (SELECT cutoff_days FROM cut)"),
]


def _nn(c: str) -> str:
    return f"CASE WHEN isnan(CAST({c} AS DOUBLE)) THEN NULL ELSE CAST({c} AS DOUBLE) END"


def medians_sql(cols: list[str]) -> str:
    return "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, median({_nn(c)}) AS median FROM train" for c in cols)


def prep_stats_sql(cols: list[str]) -> tuple[list, str]:
    med = ", ".join(f"median({_nn(c)}) AS {c}" for c in cols)
    parts = [f"SELECT '{c}' AS feature, any_value(m.{c}) AS median, AVG(COALESCE({_nn('t.' + c)}, m.{c})) AS mean, "
             f"stddev_pop(COALESCE({_nn('t.' + c)}, m.{c})) AS std FROM train t, med m" for c in cols]
    return [("med", f"SELECT {med} FROM train")], "\nUNION ALL\n".join(parts)


SCORE_CTES = [
    ("sc", "SELECT loan_amnt, int_rate, grade, purpose, is_default, revol_util / 200.0 AS pd_hat FROM features"),
    ("scl", """SELECT s.*, g.lgd AS lgd0 FROM sc s LEFT JOIN grades g ON s.grade IS NOT DISTINCT FROM g.grade"""),
    ("scf", "SELECT *, COALESCE(lgd0, (SELECT AVG(lgd0) FROM scl)) AS lgd FROM scl"),
    ("grid", """SELECT i, CAST(0.05 AS DOUBLE) + i * ((CAST(0.05 AS DOUBLE) + CAST(0.01 AS DOUBLE))
                   - CAST(0.05 AS DOUBLE)) AS cutoff, CAST(i + 5 AS DOUBLE) / 100.0 AS label
                FROM range(56) t(i)"""),
    ("ctab", """SELECT any_value(label) AS pd_cutoff,
        COUNT(*) / (SELECT COUNT(*) FROM scf) AS approval_rate,
        AVG(is_default) AS default_rate,
        SUM(loan_amnt) / (SELECT SUM(loan_amnt) FROM scf) AS disbursed_share,
        SUM(CASE WHEN is_default = 1 THEN loan_amnt * lgd ELSE 0 END) / SUM(loan_amnt) * 100 AS loss_per_100cr_inr
      FROM grid JOIN scf ON scf.pd_hat < grid.cutoff GROUP BY i"""),
]


# ---------------------------------------------------------------- models
# Pooled scores: the largest over earlier starts of the smallest mean over later ends.
ISOTONIC_CTES = [
    ("ip", """SELECT pd_hat AS x, CAST(COUNT(*) AS DOUBLE) AS w, CAST(SUM(is_default) AS DOUBLE) AS t, row_number() OVER (ORDER BY pd_hat) AS i
              FROM sc WHERE pd_hat IS NOT NULL GROUP BY pd_hat"""),
    ("ic", "SELECT *, SUM(w) OVER (ORDER BY i) AS cw, SUM(t) OVER (ORDER BY i) AS ct FROM ip"),
    ("im", """SELECT a.i AS a, b.i AS b, (b.ct - a.ct + a.t) / (b.cw - a.cw + a.w) AS mean FROM ic a JOIN ic b ON a.i <= b.i"""),
    ("il", "SELECT a, b, MIN(mean) OVER (PARTITION BY a ORDER BY b DESC ROWS UNBOUNDED PRECEDING) AS least FROM im"),
    ("iv", "SELECT b AS i, MAX(least) AS value FROM il GROUP BY b"),
]

# Fixed values of the model queries: centre and width of the two logistic inputs, Newton steps in SQL.
LOGIT_INPUTS = {"fico": (700.0, 50.0), "int_rate": (12.0, 5.0)}
NEWTON_STEPS = 9


def newton_ctes() -> list[tuple[str, str]]:
    """Newton steps of the penalised logistic fit (ridge 1, free intercept) by Cramer's rule on 3 x 3 sums."""
    (c1, (m1, s1)), (c2, (m2, s2)) = LOGIT_INPUTS.items()
    out = [("lrows", f"SELECT ({c1} - {m1}) / {s1} AS u, ({c2} - {m2}) / {s2} AS v, CAST(is_default AS DOUBLE) AS y, COUNT(*) AS n "
                     f"FROM train WHERE {c1} IS NOT NULL AND {c2} IS NOT NULL GROUP BY ALL"),
           ("nw0", "SELECT CAST(0 AS DOUBLE) AS b0, CAST(0 AS DOUBLE) AS b1, CAST(0 AS DOUBLE) AS b2")]
    det = "({0} * ({4} * {8} - {5} * {7}) - {1} * ({3} * {8} - {5} * {6}) + {2} * ({3} * {7} - {4} * {6}))".format
    h = ["a00", "a01", "a02", "a01", "a11", "a12", "a02", "a12", "a22"]

    def column(k: int) -> str:
        return det(*[f"g{i // 3}" if i % 3 == k else h[i] for i in range(9)])

    for k in range(NEWTON_STEPS):
        out.append((f"ng{k}", f"""SELECT any_value(b0) AS b0, any_value(b1) AS b1, any_value(b2) AS b2,
  SUM(n * (p - y)) AS g0, SUM(n * (p - y) * u) + any_value(b1) AS g1, SUM(n * (p - y) * v) + any_value(b2) AS g2,
  SUM(n * q) AS a00, SUM(n * q * u) AS a01, SUM(n * q * v) AS a02, SUM(n * q * u * u) + 1 AS a11, SUM(n * q * u * v) AS a12,
  SUM(n * q * v * v) + 1 AS a22
FROM (SELECT *, p * (1 - p) AS q FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * u + b2 * v))) AS p FROM lrows, nw{k}))"""))
        out.append((f"nw{k + 1}", f"SELECT b0 - {column(0)} / {det(*h)} AS b0, b1 - {column(1)} / {det(*h)} AS b1, "
                                  f"b2 - {column(2)} / {det(*h)} AS b2 FROM ng{k}"))
    return out


# Fixed values of the boosting queries: edges of the numeric inputs, levels of the category.
GBT_EDGES = {
    "int_rate": [7.0, 9.0, 11.0, 13.0, 15.0, 17.0, 19.0],
    "fico": [640.0, 660.0, 680.0, 700.0, 720.0, 740.0, 760.0, 780.0, 800.0, 820.0],
    "dti": [5.0, 10.0, 20.0, 30.0, 40.0, 50.0],
    "loan_to_income": [0.05, 0.1, 0.2, 0.3, 0.5, 0.8, 1.2],
    "emp_length_yrs": [1.0, 3.0, 5.0, 6.0, 7.0, 9.0],
}
GBT_LEVELS = {"grade": list("ABCDEFG")}


def boosting_ctes() -> list[tuple[str, str]]:
    """Histograms and best splits of the root and of its two children, at the start score."""
    bins = ["CASE WHEN {0} IS NULL THEN 255 ELSE {1} END".format(c, " + ".join(f"CAST({c} > {e} AS INTEGER)" for e in edges))
            for c, edges in GBT_EDGES.items()]
    bins += ["CASE {0} {1} ELSE 255 END".format(c, " ".join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(levels))) for c, levels in GBT_LEVELS.items()]
    choices, k = [], 0
    for k, edges in enumerate(GBT_EDGES.values(), 1):
        choices += [(k, b, m, 0) for b in range(len(edges) + 1) for m in (0, 1)]
    for k, levels in enumerate(GBT_LEVELS.values(), k + 1):
        choices += [(k, b, 0, 1) for b in range(len(levels))]
    out = [
        ("gx", "SELECT CAST(is_default AS DOUBLE) AS y, [" + ", ".join(bins) + "] AS bins FROM train"),
        ("gp", "SELECT AVG(y) AS p FROM gx"),
        ("node0", "SELECT 0 AS node, bins, p - y AS g, p * (1 - p) AS h FROM gx, gp"),
        ("choices", "SELECT * FROM (VALUES " + ", ".join(map(str, choices)) + ") c(k, b, m, category)"),
    ]
    left = "CASE WHEN category = 1 THEN bin <> b WHEN bin = 255 THEN m = 1 ELSE bin <= b END"
    for r in (0, 1):
        out += [
            (f"hist{r}", f"SELECT node, k, bins[k] AS bin, SUM(g) AS g, SUM(h) AS h, COUNT(*) AS n FROM node{r}, range(1, {k + 1}) t(k) GROUP BY ALL"),
            (f"cand{r}", f"""SELECT node, k, b, m, category, gl * gl / hl + gr * gr / hr - g * g / h AS gain, nl, nr FROM (
  SELECT node, k, b, m, category, SUM(g) AS g, SUM(h) AS h, SUM(g) FILTER (WHERE {left}) AS gl, SUM(h) FILTER (WHERE {left}) AS hl,
    SUM(n) FILTER (WHERE {left}) AS nl, SUM(g) FILTER (WHERE NOT ({left})) AS gr, SUM(h) FILTER (WHERE NOT ({left})) AS hr,
    SUM(n) FILTER (WHERE NOT ({left})) AS nr, SUM(n) FILTER (WHERE bin = 255) AS missing
  FROM hist{r} JOIN choices USING (k) GROUP BY node, k, b, m, category)
WHERE nl >= 20 AND nr >= 20 AND hl >= 0.001 AND hr >= 0.001 AND (m = 0 OR missing > 0)"""),
            (f"split{r}", f"""SELECT * FROM (SELECT *, MAX(gain) OVER (PARTITION BY node) AS top FROM cand{r}) WHERE gain >= top * (1 - 1e-10)
QUALIFY row_number() OVER (PARTITION BY node ORDER BY k, b, m) = 1"""),
        ]
        if r == 0:
            side = left.replace("bin ", "bins[k] ")
            out.append(("node1", f"SELECT CASE WHEN {side} THEN 1 ELSE 2 END AS node, bins, g, h FROM node0, (SELECT * EXCLUDE (node) FROM split0)"))
    return out
