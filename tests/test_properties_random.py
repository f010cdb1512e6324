"""Property tests on random small frames: distributed ranks and the sweep
against single-task windows and a brute-force loop."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendlens.operators.ordering import RankSpec, add_ranks
from lendlens.operators.quantile import exact_quantiles
from lendlens.operators.sweep import sweep_below

values = st.one_of(st.none(), st.just(float("nan")), st.sampled_from([0.0, 1.0, 2.5, -3.0]),
                   st.floats(-50, 50, allow_nan=False, allow_infinity=False))
rows = st.lists(st.tuples(st.integers(0, 40), st.sampled_from(["A", "B", None]), values),
                min_size=1, max_size=120)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(rows, st.integers(1, 12), st.sampled_from([4, 16]))
def test_ranks_match_native(spark, data, k, buckets):
    df = spark.createDataFrame([(f"id{i:03d}", g, x) for i, g, x in data], "loan_id string, grade string, x double")
    ours = add_ranks(df, [RankSpec("t", "x", "ntile", tiles=k, parts=("grade",)),
                          RankSpec("p", "x", "percent_rank", parts=("grade",))],
                     tie="loan_id", buckets=buckets)
    key = F.col("x").asc_nulls_last()
    native = df.select("loan_id", "grade", "x",
                       F.ntile(k).over(W.partitionBy("grade").orderBy(key, "loan_id")).cast("bigint").alias("t"),
                       F.percent_rank().over(W.partitionBy("grade").orderBy(key)).alias("p"))
    norm = lambda rs: sorted(tuple(repr(v) for v in r) for r in rs)
    assert norm(ours.collect()) == norm(native.collect())


@SETTINGS
@given(st.lists(st.tuples(values, st.floats(0, 100), st.integers(0, 1)), min_size=1, max_size=80),
       st.lists(st.floats(-60, 60, allow_nan=False), min_size=1, max_size=8, unique=True))
def test_sweep_matches_loop(spark, data, cuts):
    cuts = sorted(cuts)
    df = spark.createDataFrame(data, "s double, a double, y int")
    out = {r["i"]: r for r in sweep_below(df, "s", cuts, {"a": F.sum("a"), "d": F.sum("y")}).collect()}
    for i, c in enumerate(cuts):
        sel = [r for r in data if r[0] is not None and not math.isnan(r[0]) and r[0] < c]
        assert out[i]["n"] == len(sel) and out[i]["total_n"] == len(data)
        if sel:
            assert math.isclose(out[i]["a"], sum(r[1] for r in sel), rel_tol=1e-9, abs_tol=1e-9)
            assert out[i]["d"] == sum(r[2] for r in sel)


@SETTINGS
@given(st.lists(values, min_size=1, max_size=150), st.sampled_from([0.0, 0.25, 0.5, 0.8, 1.0]))
def test_exact_quantile_matches_percentile(spark, data, q):
    df = spark.createDataFrame([(x,) for x in data], "x double")
    ours = exact_quantiles(df, ["x"], q, buckets=3)["x"]
    ref = df.agg(F.percentile(F.when(~F.isnan("x"), F.col("x")), q)).first()[0]
    if ref is None:
        assert ours is None
    else:
        assert math.isclose(ours, ref, rel_tol=1e-12, abs_tol=1e-12)
