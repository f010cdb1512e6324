"""Size-checked joins, grouping-set pinning and column helpers."""

from pyspark.sql import functions as F

from lendlens.functions.cleaning import calendar_months, try_double
from lendlens.functions.numeric import gate_snap, round_half_away
from lendlens.operators.joins import join_small, pin_small, pinned_grouping_sets


def test_pin_small_limit(spark):
    df = spark.range(10)
    assert pin_small(df, 10).count() == 10
    assert pin_small(df, 9) is None


def test_join_small_broadcast_and_fallback(spark):
    big = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "x int, k string")
    small = spark.createDataFrame([("a", 10), (None, 20)], "k string, v int")
    for limit in (100, 1):                       # broadcast, then shuffle-join fallback
        out = {r["x"]: r["v"] for r in join_small(big, small, ["k"], how="left", limit=limit).collect()}
        assert out == {1: 10, 2: 20, 3: None}    # NULL key matches NULL key
        strict = {r["x"]: r["v"] for r in
                  join_small(big, small, ["k"], how="left", null_safe=False, limit=limit).collect()}
        assert strict == {1: 10, 2: None, 3: None}


def test_pinned_grouping_sets(spark):
    df = spark.createDataFrame([("A", 1, 2.0), ("A", 2, 4.0), ("B", None, 6.0)], "g string, t int, y double")
    a, b = pinned_grouping_sets(df, [["g", "t"], ["g"]], [F.avg("y").alias("m")])
    assert sorted((r["g"], r["t"], r["m"]) for r in a.collect()) == [("A", 1, 2.0), ("A", 2, 4.0), ("B", None, 6.0)]
    assert sorted((r["g"], r["m"]) for r in b.collect()) == [("A", 3.0), ("B", 6.0)]
    assert pinned_grouping_sets(df, [["g", "t"]], [F.count(F.lit(1))], limit=2) is None


def test_column_helpers(spark):
    df = spark.createDataFrame([("2015-01-31", "2015-02-01", "1d", "0.285", "-2.5")], "a string, b string, t string, r string, n string")
    r = df.select(calendar_months(F.to_date("a"), F.to_date("b")).alias("m"), try_double("t").alias("t"),
                  round_half_away(F.col("r").cast("double"), 2).alias("r"),
                  round_half_away(F.col("n").cast("double"), 0).alias("n"),
                  gate_snap(F.lit(0.5), 0).alias("g")).first()
    assert r["m"] == 1                 # calendar boundaries, not full months
    assert r["t"] is None              # Java suffix literal is not a number
    assert r["r"] == 0.28              # binary value 0.28499.. rounds down
    assert r["n"] == -3.0              # half away from zero
    assert r["g"] == 0.0
