"""Invariants of the book built over the sf0.001 fixture."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paths import SF001
from lendlens.plans import cutoff, loss, policy, segments, vintage
from lendlens.plans.book import book


@pytest.fixture(scope="module")
def feats(spark):
    return book(spark, SF001).features


def test_ntile_sizes(feats):
    for col, k in (("income_decile", 10), ("fico_quintile", 5)):
        sizes = [r["count"] for r in feats.groupBy(col).count().collect()]
        assert len(sizes) == k and max(sizes) - min(sizes) <= 1


def test_percent_rank_range(feats):
    r = feats.agg(F.min("rate_rank_in_grade"), F.max("rate_rank_in_grade"),
                  F.min("dti_rank_in_grade"), F.max("dti_rank_in_grade")).first()
    assert 0.0 <= r[0] <= r[1] <= 1.0 and 0.0 <= r[2] <= r[3] <= 1.0


def test_vintage_curves_monotone(feats):
    c = vintage.vintage_curves(feats)
    w = W.partitionBy("vintage_quarter").orderBy("mob")
    bad = c.withColumn("prev", F.lag("cum_default_rate").over(w)).filter(
        (F.col("cum_default_rate") < F.col("prev")) | (F.col("cum_default_rate") > 1))
    assert bad.count() == 0


def test_lgd_floor_and_el_rows(feats):
    g = loss.grade_loss(feats)
    assert g.filter(F.col("lgd") < 0).count() == 0
    seg = segments.segment_risk(feats, min_loans=20)
    el = loss.segment_expected_loss(seg, g)
    assert el.count() == seg.filter(F.col("grade").isNotNull()).count()


def test_cutoff_monotone(feats):
    t = cutoff.cutoff_table(cutoff.deterministic_scores(feats), loss.grade_loss(feats)).orderBy("pd_cutoff")
    rates = [r["approval_rate"] for r in t.collect()]
    assert rates == sorted(rates) and rates[-1] <= 1.0


def test_segment_floor_and_rank(feats):
    seg = segments.segment_risk(feats, min_loans=20)
    assert seg.filter(F.col("n_loans") < 20).count() == 0
    top = seg.orderBy("risk_rank").first()
    assert top["risk_rank"] == 1


def test_blacklist_guard(monkeypatch, feats):
    cols = policy.model_frame(feats).columns
    assert not set(cols) & {"last_pymnt_date", "actual_total_pymnt", "actual_recoveries"}
    monkeypatch.setattr(policy, "NUMERIC", policy.NUMERIC + ["actual_recoveries"])
    with pytest.raises(ValueError):
        policy.model_frame(feats)
    for leak in ("hardship_type", "last_fico_range_low", policy.TARGET):
        with pytest.raises(ValueError):
            policy.check_inputs(["fico", leak])


def test_training_refuses_a_leaked_input(monkeypatch, feats):
    from lendlens.plans import model
    monkeypatch.setattr(policy, "NUMERIC", policy.NUMERIC + ["actual_total_pymnt"])
    with pytest.raises(ValueError):
        model.train_and_score(feats, gbt_iter=1)


def test_out_of_time_split(feats):
    train, test, cut = policy.oot_split(policy.passing(feats))
    assert train.agg(F.max("issue_date")).first()[0] < test.agg(F.min("issue_date")).first()[0]
