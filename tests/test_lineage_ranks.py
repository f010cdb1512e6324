"""Leakage by lineage; ranks of keys that doubles cannot hold."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lendlens.operators.ordering import CUT_STEP, RankSpec, _sub_col, add_ranks
from lendlens.plans import policy
from lendlens.plans.lineage import ancestors


@pytest.fixture(scope="module")
def table(spark):
    names = [*policy.NUMERIC, *policy.CATEGORICAL, policy.TARGET, "recoveries", "total_pymnt", "extra"]
    kinds = [f"{c} {'string' if c in policy.CATEGORICAL else 'double'}" for c in names] + ["issue_date date"]
    return spark.createDataFrame([], ", ".join(kinds))


def test_derived_outcomes_are_refused(table):
    policy.model_frame(table)
    policy.model_frame(table.withColumn("fico", F.col("fico") + F.col("extra")))
    late = F.col("annual_inc") + F.col("recoveries")
    w = W.partitionBy("grade").orderBy("dti")
    leaks = [
        table.withColumn("fico", late),
        table.withColumnRenamed("total_pymnt", "paid").withColumn("x", F.col("paid") * 2).drop("dti").withColumnRenamed("x", "dti"),
        table.withColumn("dti", F.sum("recoveries").over(w)),
        table.withColumn("dti", F.avg(policy.TARGET).over(w)),                                  # target encoding
        table.drop("dti").join(table.groupBy("grade").agg(F.max("recoveries").alias("dti")), "grade"),
        table.unionByName(table.withColumn("dti", F.col("recoveries"))),
        table.drop("dti").withColumn("dti", F.explode(F.array("recoveries"))),
        table.mapInPandas(lambda x: x, table.schema),                                            # a function may use all it reads
    ]
    for k, df in enumerate(leaks):
        with pytest.raises(ValueError, match="computed from"):
            policy.model_frame(df)
            pytest.fail(f"leak {k} passed")


def test_ancestors(spark):
    a = spark.createDataFrame([], "x int, y int, z int")
    got = ancestors(a.select((F.col("x") + F.col("y")).alias("s"), "z").withColumn("t", F.col("s") * 2).filter("z > 1"))
    assert got["t"] >= {"x", "y", "s"} and "z" not in got["t"] and got["z"] == set()


@pytest.mark.parametrize("kind", ["bigint", "decimal(30,2)", "string", "date"])
def test_native_keys_equal_windows(spark, kind):
    rnd = random.Random(4)
    base = 2 ** 60
    make = {"bigint": lambda: base + rnd.randint(0, 300), "decimal(30,2)": lambda: Decimal(10) ** 25 + Decimal(rnd.randint(0, 300)) / 100,
            "string": lambda: rnd.choice(["ä", "a", "B", "", "zz"]) + str(rnd.randint(0, 60)), "date": lambda: f"20{rnd.randint(10, 24)}-0{rnd.randint(1, 9)}-11"}[kind]
    rows = [(f"id{i:05d}", rnd.choice("pqr"), None if rnd.random() < 0.1 else str(make() if rnd.random() < 0.65 else (base if kind == "bigint" else make())),
             rnd.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "id string, part string, k string, d double").withColumn("k", F.col("k").cast(kind)).repartition(5)
    key = F.col("k").asc_nulls_last()
    specs = [RankSpec("nt", "k", "ntile", tiles=7), RankSpec("ntp", "k", "ntile", tiles=4, parts=("part",)), RankSpec("rn", "k", "row_number"),
             RankSpec("pr", "k", "percent_rank", parts=("part",)), RankSpec("dn", "d", "ntile", tiles=5)]
    got = add_ranks(df, specs, tie="id", range_rows=400)
    want = df.withColumns({
        "nt": F.ntile(7).over(W.orderBy(key, "id")), "ntp": F.ntile(4).over(W.partitionBy("part").orderBy(key, "id")),
        "rn": F.row_number().over(W.orderBy(key, "id")), "pr": F.percent_rank().over(W.partitionBy("part").orderBy(key)),
        "dn": F.ntile(5).over(W.orderBy(F.col("d").asc_nulls_last(), "id"))})
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_two_level_cuts(spark):
    """The piece of a hot key is the number of cuts below the tie-break, whatever their number."""
    bounds = {0: [f"{i:06d}" for i in range(0, 20000, 3)], 2: ["b"], 5: [f"{i:06d}" for i in range(CUT_STEP)]}
    rnd = random.Random(1)
    rows = [(rnd.choice([0, 1, 2, 5]), None if rnd.random() < 0.05 else f"{rnd.randint(-5, 20005):06d}") for _ in range(500)] + [(0, "000000"), (5, "000064"), (5, "")]
    got = spark.createDataFrame(rows, "b int, t string").withColumn("p", _sub_col("b", "t", bounds)).collect()
    for r in got:
        cuts = bounds.get(r["b"], [])
        assert r["p"] == (len(cuts) if r["t"] is None else sum(c < r["t"] for c in cuts))
