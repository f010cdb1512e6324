"""The one-scan risk layer equals the table-by-table functions."""

import pytest

from paths import SF001
from lendlens.plans import loss, segments, vintage
from lendlens.plans.book import book
from lendlens.plans.risk_layer import risk_layer


def _rows(df, keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def _same(a, b, keys):
    ra, rb = _rows(a, keys), _rows(b, keys)
    assert ra.keys() == rb.keys()
    for k in ra:
        for c, v in ra[k].items():
            w = rb[k][c]
            if isinstance(v, float):
                assert v == pytest.approx(w, rel=1e-12, abs=1e-9), (k, c)
            else:
                assert v == w, (k, c)


@pytest.mark.parametrize("limits", [{}, {"limit": 5, "stored_limit": 5}])
def test_risk_layer_matches(spark, limits):
    f = book(spark, SF001).features
    r = risk_layer(f, min_loans=20, **limits)
    _same(r["segment_risk"], segments.segment_risk(f, 20), ["grade", "purpose", "income_decile"])
    _same(r["grade_loss"], loss.grade_loss(f), ["grade"])
    _same(r["cohort_sizes"], vintage.cohort_sizes(f), ["vintage_quarter"])
    _same(r["vintage_curves"], vintage.vintage_curves(f), ["vintage_quarter", "mob"])
    assert r["segment_risk"].columns == segments.segment_risk(f, 20).columns
    assert r["grade_loss"].columns == loss.grade_loss(f).columns
    assert r["vintage_curves"].columns == vintage.vintage_curves(f).columns
