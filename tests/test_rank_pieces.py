"""Ranks of large tables: rows whose piece has one answer take it without a window."""

import random

import pytest

from lendlens.operators import ordering as R


@pytest.mark.parametrize("apart", [0, 10 ** 9])
def test_rows_of_pieces_with_one_answer(spark, monkeypatch, apart):
    """hot keys across tile edges, equal rows and missing values; as the native window, from a window over fewer rows."""
    rnd = random.Random(5)
    monkeypatch.setattr(R, "APART_ROWS", apart)
    monkeypatch.setattr(R, "MIN_BUCKET_ROWS", 20)
    rows = [(rnd.choice([None, float("nan"), 1.0, 2.0, 2.0, 2.0, 3.0]), float(rnd.randint(0, 50)), rnd.choice([f"t{k:04d}", None])) for k in range(4000)]
    df = spark.createDataFrame(rows, "a double, b double, t string").repartition(4)
    specs = [R.RankSpec("qa", "a", "ntile", tiles=5), R.RankSpec("qb", "b", "ntile", tiles=10)]
    got = R.add_ranks(df, specs, tie="t", buckets=32)
    order = {x.name: f"ntile({x.tiles}) OVER (ORDER BY {x.key} ASC NULLS LAST, t ASC NULLS LAST)" for x in specs}
    want = df.selectExpr("a", "b", "t", *[f"{e} AS {n}" for n, e in order.items()])
    for x in specs:                                     # rows that agree in key and tie may swap their numbers
        told = lambda d: sorted(map(repr, d.select(x.key, "t", x.name).collect()))  # noqa: E731, B023
        assert told(got) == told(want)
    plan = got._jdf.queryExecution().analyzed().toString()
    assert ("isnull(coalesce(__bconst0" in plan) == (apart == 0)
