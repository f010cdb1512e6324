"""Isotonic merges, Newton logistic and histogram boosting against plain sequential versions."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendlens.operators import boosting as B
from lendlens.operators.isotonic import fit_isotonic, isotonic_value, pool
from lendlens.operators.logit import fit_logit, logit_gradient, logit_probability
from lendlens.operators.metrics import exact_auc


# ---------------------------------------------------------------- isotonic
def max_min(x, y, w):
    """Fitted values by the max-min formula over distinct x."""
    xs = np.unique(x)
    ws = np.array([w[x == v].sum() for v in xs])
    ts = np.array([(w * y)[x == v].sum() for v in xs])
    cw, ct = np.r_[0, np.cumsum(ws)], np.r_[0, np.cumsum(ts)]
    n = len(xs)
    return xs, np.array([max(min((ct[b + 1] - ct[a]) / (cw[b + 1] - cw[a]) for b in range(i, n)) for a in range(i + 1)) for i in range(n)])


@pytest.mark.parametrize("seed,shape", [(0, "noise"), (1, "rising"), (2, "falling"), (3, "low end"), (4, "ties")])
def test_isotonic_equals_sequential(spark, seed, shape):
    rng = np.random.RandomState(seed)
    n = 120
    x = rng.randint(0, 30 if shape == "ties" else 10 ** 6, n).astype(float)
    y = {"rising": x / x.max() + 0.1 * rng.randn(n), "falling": -x, "low end": np.where(x == x.max(), -100 * n, x)}.get(shape, rng.rand(n))
    w = rng.randint(1, 4, n).astype(float)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for a, b, c in zip(x, y, w)], "x double, y double, w double")
    xs, want = max_min(x, y, w)
    blocks = fit_isotonic(df, "x", "y", "w", rows=7)                     # about 17 ranges, three rounds of merges
    got = np.array([r["v"] for r in df.select("x").distinct().withColumn("v", isotonic_value(blocks, "x")).orderBy("x").collect()])
    np.testing.assert_allclose(got, want, rtol=1e-9, atol=1e-9)
    held = sorted(map(tuple, blocks.collect()))
    assert all(a[1] < b[0] and a[3] < b[3] for a, b in zip(held, held[1:])) and sum(h[2] for h in held) == pytest.approx(w.sum())


def test_pooling_is_associative():
    rng = np.random.RandomState(7)
    x, t, w = np.arange(60.0), rng.randn(60), rng.rand(60) + 0.1
    whole = pool(x, x, w, t)
    for cut in (1, 17, 30, 59):
        halves = [pool(x[s], x[s], w[s], t[s]) for s in (slice(0, cut), slice(cut, 60))]
        merged = pool(*[np.concatenate(c) for c in zip(*halves)])
        for a, b in zip(whole, merged):
            np.testing.assert_allclose(a, b)


def test_isotonic_odd_rows(spark):
    rows = [(0.2, 1.0), (None, 1.0), (float("nan"), 0.0), (0.4, None), (0.6, 0.0), (0.8, 3.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    blocks = fit_isotonic(df, "x", "y")
    assert sorted(map(tuple, blocks.collect())) == [(0.2, 0.6, 2.0, 0.5), (0.8, 0.8, 1.0, 3.0)]
    at = spark.createDataFrame([(-1.0,), (0.3,), (0.7,), (9.0,), (None,)], "x double")
    got = [r["v"] for r in at.withColumn("v", isotonic_value(blocks, "x")).collect()]
    assert got[:4] == pytest.approx([0.5, 0.5, 1.75, 3.0]) and got[4] is None
    empty = fit_isotonic(df.limit(0), "x", "y")
    assert empty.count() == 0 and at.withColumn("v", isotonic_value(empty, "x")).filter("v IS NOT NULL").count() == 0
    with pytest.raises(ValueError):
        isotonic_value(blocks, "x", limit=1)


# ---------------------------------------------------------------- logistic
def test_logit_reaches_the_optimum(spark):
    rng = np.random.RandomState(1)
    X = rng.randn(3000, 4) * [1, 5, 0.2, 1]
    y = (rng.rand(3000) < 1 / (1 + np.exp(-(0.3 + X @ [1, -0.5, 2, 0])))).astype(int)
    df = spark.createDataFrame([([float(v) for v in r], int(t)) for r, t in zip(X, y)] + [(None, 1), ([0.0] * 4, None)], "x array<double>, y int").repartition(5)
    m = fit_logit(df, "x", "y", ridge=2.0)
    beta = np.zeros(5)
    D = np.column_stack([np.ones(3000), X])
    for _ in range(30):
        p = 1 / (1 + np.exp(-D @ beta))
        pen = np.diag([0.0] + [2.0] * 4)
        beta -= np.linalg.solve((D * (p * (1 - p))[:, None]).T @ D + pen, D.T @ (p - y) + pen @ beta)
    np.testing.assert_allclose(m.coefficients, beta, atol=1e-8)
    assert m.converged and m.steps <= 10 and np.abs(logit_gradient(df, "x", "y", m, 2.0)).max() < 1e-6
    got = df.filter("y IS NOT NULL AND x IS NOT NULL").withColumn("p", logit_probability(m, "x")).select("x", "p").collect()
    for r in got[:20]:
        assert r["p"] == pytest.approx(1 / (1 + np.exp(-(beta[0] + np.dot(beta[1:], r["x"])))), abs=1e-9)


def test_logit_odd_inputs(spark):
    one = spark.createDataFrame([([1.0], 1), ([2.0], 1)], "x array<double>, y int")
    m = fit_logit(one, "x", "y", max_steps=8)
    assert np.isfinite(m.coefficients).all()
    assert fit_logit(one.limit(0), "x", "y").converged is False
    same = spark.createDataFrame([([1.0, 1.0], k % 2) for k in range(40)], "x array<double>, y int")       # collinear, constant
    assert fit_logit(same, "x", "y").converged


# ---------------------------------------------------------------- boosting
def plain_tree(codes, g, h, categories, leaves, depth, least, rate):
    """Leaf-wise tree by trying every split; returns the value of every row."""
    def best(rows):
        top = None
        for k in range(len(codes)):
            c = codes[k, rows]
            options = [(b, False) for b in np.unique(c) if b < 255] if categories[k] else [(b, m) for b in range(255) for m in (False, True)]
            for b, m in options:
                side = (c != b) if categories[k] else np.where(c == 255, m, c <= b)
                if m and not (c == 255).any():
                    continue
                s = [g[rows[side]].sum(), h[rows[side]].sum(), g[rows[~side]].sum(), h[rows[~side]].sum()]
                if min(side.sum(), (~side).sum()) < least or min(s[1], s[3]) < 1e-3:
                    continue
                gain = s[0] ** 2 / s[1] + s[2] ** 2 / s[3] - g[rows].sum() ** 2 / h[rows].sum()
                if gain > 1e-12 and (top is None or gain > top[0] * (1 + 1e-10)):
                    top = (gain, rows[side], rows[~side])
        return top

    done = [(np.arange(codes.shape[1]), 0)]
    found = {0: best(done[0][0])}
    while len(done) < leaves:
        ready = [i for i in range(len(done)) if found.get(i) and done[i][1] < depth]
        if not ready:
            break
        i = max(ready, key=lambda i: found[i][0])
        _, left, right = found[i]
        level = done[i][1] + 1
        done[i] = (left, level)
        done.append((right, level))
        found[i], found[len(done) - 1] = best(left), best(right)
    out = np.zeros(codes.shape[1])
    for rows, _ in done:
        out[rows] = -rate * g[rows].sum() / h[rows].sum()
    return out


def loans(n, seed=0):
    rng = np.random.RandomState(seed)
    a, b = rng.randn(n), rng.randint(0, 12, n).astype(float)
    a[rng.rand(n) < 0.1] = np.nan
    c = np.array(list("pqrs"))[rng.randint(0, 4, n)]
    z = np.where(np.isnan(a), 1.0, np.sin(2 * a)) * 1.5 + (b > 6) * (c == "q") * 2 - 0.7
    return a, b, c, (rng.rand(n) < 1 / (1 + np.exp(-z))).astype(int)


def frame(spark, a, b, c, y):
    return spark.createDataFrame([(int(i), None if np.isnan(u) else float(u), float(v), str(w), int(t)) for i, (u, v, w, t) in enumerate(zip(a, b, c, y))],
                                 "id long, a double, b double, c string, y int")


def test_boosting_equals_plain_trees(spark, monkeypatch):
    a, b, c, y = loans(900)
    binning = B.Binning({"a": [-1.5, -1.0, -0.5, 0.0, 0.5, 1.0, 1.5], "b": [float(k) for k in range(11)]}, {"c": list("pqrs")})
    df = frame(spark, a, b, c, y).repartition(4)
    monkeypatch.setattr(B, "STORE", 2)                                # scores are stored between rounds
    model = B.fit_boosting(df, binning, "y", rounds=5, leaves=6, depth=3, least_rows=15, patience=None)[0]
    import pyarrow as pa
    codes = binning.codes([pa.array(a, from_pandas=False), pa.array(b), pa.array(c)])
    raw = np.full(len(y), model.start)
    for _ in range(5):
        p = 1 / (1 + np.exp(-raw))
        raw += plain_tree(codes, p - y, p * (1 - p), [False, False, True], 6, 3, 15, 0.08)
    got = {r["id"]: r["s"] for r in df.select("id", B.boosted_score(model).alias("s")).collect()}
    np.testing.assert_allclose([got[i] for i in range(len(y))], raw, atol=1e-9)


def test_boosting_leaves_no_stored_scores(spark, tmp_path, monkeypatch):
    """F1, F2, F8: blocks with older scores are removed as soon as newer ones are stored, the last ones at the end."""
    kept = []

    def stored(df, name):
        path = str(tmp_path / f"{name}-{len(kept)}")
        df.write.parquet(path)
        kept.append(sum(os.path.isdir(tmp_path / d) for d in os.listdir(tmp_path)))
        return df.sparkSession.read.parquet(path)

    monkeypatch.setattr(B, "materialize", stored)
    a, b, c, y = loans(600)
    B.fit_boosting(frame(spark, a, b, c, y), B.Binning({"a": [-0.5, 0.5], "b": [3.0, 6.0]}, {"c": list("pqrs")}), "y", rounds=8, leaves=3, depth=2, patience=None)
    assert len(kept) == 4 and max(kept) == 2 and os.listdir(tmp_path) == []


def test_boosting_learns_and_stops(spark, monkeypatch):
    """Three folds at once: better than the linear model, rounds by patience, no row scored by a model that saw it needs to be used."""
    a, b, c, y = loans(6000, 3)
    df = frame(spark, a, b, c, y)
    binning = B.Binning(B.numeric_edges(df, ["a", "b"]), {"c": list("pqrs")})
    assert all(x == sorted(set(x)) and len(x) <= 254 for x in binning.edges.values())
    fold, held = F.pmod(F.xxhash64("id"), F.lit(3)), F.pmod(F.xxhash64("id", F.lit(9)), F.lit(10)) == 0
    models = B.fit_boosting(df, binning, "y", rounds=40, rate=0.3, fold=fold, folds=3, held=held, patience=3)
    for k, m in enumerate(models):
        assert 1 <= len(m.trees) == int(np.argmin(m.losses)) and m.losses[len(m.trees)] < m.losses[0]
        assert all(1 + len(t.left) <= 2 * 31 for t in m.trees)
        unseen = df.filter(fold == k).select(B.boosted_score(m).alias("s"), "y")
        assert exact_auc(unseen, "s", "y") > 0.72
    monkeypatch.setattr(B, "DRIVER_BYTES", 0)                                                # sums meet in a shuffle
    again = B.fit_boosting(df.repartition(3), binning, "y", rounds=40, rate=0.3, fold=fold, folds=3, held=held, patience=3)
    assert [len(m.trees) for m in again] == [len(m.trees) for m in models]


def test_boosting_ranks_as_well_as_the_ml_trees(spark):
    """Not below the library's depth-wise trees on unseen rows, at equal rounds, rate and depth."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    df = frame(spark, *loans(5000, 5)).fillna({"a": -9.0}).withColumns({f"c{x}": (F.col("c") == x).cast("double") for x in "pqrs"})
    part = F.pmod(F.xxhash64("id"), F.lit(3))
    seen, unseen = df.filter(part > 0), df.filter(part == 0)
    model = B.fit_boosting(seen, B.Binning(B.numeric_edges(seen, ["a", "b"]), {"c": list("pqrs")}), "y", rounds=12, rate=0.2, patience=None)[0]
    ours = exact_auc(unseen.select(B.boosted_score(model).alias("s"), "y"), "s", "y")
    x = VectorAssembler(inputCols=["a", "b", "cp", "cq", "cr", "cs"], outputCol="x")
    theirs = GBTClassifier(featuresCol="x", labelCol="y", maxIter=12, stepSize=0.2, maxDepth=6, maxBins=255, minInstancesPerNode=20, seed=42).fit(
        x.transform(seen)).transform(x.transform(unseen)).select(vector_to_array("probability")[1].alias("s"), "y")
    assert ours > exact_auc(theirs, "s", "y") - 0.005


def test_boosting_odd_rows(spark):
    df = frame(spark, *loans(30)).withColumn("y", F.lit(1))
    binning = B.Binning({"a": [0.0], "b": []}, {"c": ["p"]})
    assert B.fit_boosting(df, binning, "y", rounds=3, patience=None)[0].trees == []
    none = B.fit_boosting(df.limit(0), binning, "y", rounds=3, patience=None)[0]
    assert none.trees == [] and none.start == 0.0
    assert df.select(B.boosted_score(none).alias("s")).distinct().collect()[0]["s"] == 0.0
    with pytest.raises(ValueError):
        B.Binning({"a": [float(k) for k in range(300)]})
