"""Threshold sweep and AUC against brute force on small frames."""

import random

import pytest
from pyspark.sql import functions as F

from lendlens.operators.metrics import exact_auc
from lendlens.operators.sweep import sweep_below
from lendlens.plans.cutoff import cutoff_grid


def test_grid_is_bit_exact():
    cuts, labels = cutoff_grid()
    assert len(cuts) == 56
    assert cuts[0] == 0.05 and labels[-1] == 0.6
    step = (0.05 + 0.01) - 0.05
    assert all(c == 0.05 + i * step for i, c in enumerate(cuts))


def test_sweep_matches_loop(spark):
    rnd = random.Random(7)
    cuts, labels = cutoff_grid()
    rows = []
    for i in range(2000):
        s = rnd.choice([rnd.random() * 0.7, cuts[rnd.randrange(56)], None, float("nan")])
        rows.append((s, rnd.random() * 1000, rnd.randint(0, 1)))
    df = spark.createDataFrame(rows, "s double, amt double, y int")
    out = {r["i"]: r for r in sweep_below(df, "s", cuts, {"amt": F.sum("amt"), "d": F.sum("y")}, labels).collect()}
    for i, c in enumerate(cuts):
        sel = [r for r in rows if r[0] is not None and r[0] == r[0] and r[0] < c]
        assert out[i]["n"] == len(sel)
        assert out[i]["total_n"] == len(rows)
        if sel:
            assert out[i]["amt"] == pytest.approx(sum(r[1] for r in sel), rel=1e-12)
            assert out[i]["d"] == sum(r[2] for r in sel)


def test_auc_rank_sum(spark):
    rnd = random.Random(11)
    rows = [(float(rnd.randint(0, 20)), rnd.randint(0, 1)) for _ in range(500)]
    df = spark.createDataFrame(rows, "s double, y int")
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    brute = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert exact_auc(df, "s", "y") == pytest.approx(brute, abs=1e-12)


def test_cutoff_table_fills_missing_lgd(spark):
    """Grades without an LGD (and a NULL grade) take the mean LGD over the joined rows."""
    from lendlens.plans.cutoff import cutoff_table
    rnd = random.Random(5)
    grades_rows = [("A", 0.3), ("B", 0.5), (None, 0.7)]
    lgd = dict(grades_rows)
    rows = [(rnd.uniform(100, 1000), rnd.choice(["A", "B", "C", None]), rnd.randint(0, 1), rnd.random() * 0.7)
            for _ in range(400)]
    scores = spark.createDataFrame(rows, "loan_amnt double, grade string, is_default int, pd_hat double")
    grades = spark.createDataFrame(grades_rows, "grade string, lgd double")
    got = {round(r["pd_cutoff"], 2): r for r in cutoff_table(scores, grades).collect()}
    known = [lgd[g] for _, g, _, _ in rows if g in lgd]
    fill = sum(known) / len(known)
    cuts, labels = cutoff_grid()
    total_amt = sum(r[0] for r in rows)
    for c, lab in zip(cuts, labels):
        ok = [r for r in rows if r[3] < c]
        if not ok:
            assert lab not in got
            continue
        amt = sum(r[0] for r in ok)
        el = sum(r[0] * lgd.get(r[1], fill) for r in ok if r[2] == 1)
        g = got[lab]
        assert g["approval_rate"] == pytest.approx(len(ok) / len(rows), rel=1e-12)
        assert g["default_rate"] == pytest.approx(sum(r[2] for r in ok) / len(ok), rel=1e-12)
        assert g["disbursed_share"] == pytest.approx(amt / total_amt, rel=1e-12)
        assert g["loss_per_100cr_inr"] == pytest.approx(el / amt * 100, rel=1e-9)


def test_cutoff_table_on_empty_scores(spark):
    from lendlens.plans.cutoff import cutoff_table
    scores = spark.createDataFrame([], "loan_amnt double, grade string, is_default int, pd_hat double")
    grades = spark.createDataFrame([("A", 0.3)], "grade string, lgd double")
    assert cutoff_table(scores, grades).count() == 0


def test_auc_undefined_for_one_class(spark):
    from lendlens.operators.metrics import score_metrics
    df = spark.createDataFrame([(0.1, 0), (0.4, 0)], "s double, y int")
    r = score_metrics(df, "s", "y").first()
    assert r["auc"] is None and r["gini"] is None and r["n"] == 2
