"""Mixing: targets against a plain water-filling loop, taken words against the target of every source."""

import collections
import re

import numpy as np
import pytest

from lendlens.llm import mixing
from lendlens.llm.common import table
from lendlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    """Shares reshared one source at a time until none is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, held = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in held]
        rest = total - sum(held.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > cap * sizes[s]]
        if not above:
            return {**held, **share}
        held.update({s: cap * sizes[s] for s in above})


def check(rows, got, slack=0.5):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, largest = collections.Counter(), collections.Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
        largest[s] = max(largest[s], size(t))
    want = brute_targets(sizes)
    source = collections.defaultdict(set)
    for i, t, s in rows:
        source[(i, size(t))].add(s)
    assert collections.Counter((r["doc_id"], r["size"]) for r in got) == collections.Counter((i, size(t)) for i, t, _ in rows)
    taken = collections.Counter()
    for r in got:
        (s,) = source[(r["doc_id"], r["size"])]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s], rel=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= slack * largest[s] + 1, s


def test_query(spark):
    docs = table(spark, SF, "documents")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    first = QUERIES["op13_mixing"](spark, SF)
    assert [t for _, t in first.dtypes] == ["bigint", "bigint", "bigint", "double", "bigint"]
    got = sorted(map(tuple, first.collect()))
    check(rows, first.collect())
    assert got == sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()))       # reruns and other layouts agree


def test_odd_rows(spark):
    """NULL and tiny sources, a source under its limit, a third of all rows equal, a giant text."""
    rng = np.random.RandomState(3)
    text = lambda n: " ".join(["w"] * n)
    rows = [(i, text(int(rng.randint(1, 40))), f"s{i % 4}") for i in range(400)]
    rows += [(None, "same text of six words here", "s1")] * 300 + [(1000, text(3), "tiny"), (1001, text(5000), None), (1002, None, "none"), (1003, " \n", "none"),
                                                                   (1004, text(2), ""), (1005, text(9000), "Ünder")]
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "doc_id long, text string, source string, u string, w int, left int").repartition(7)
    got = mixing.mix(docs).collect()
    check(rows, got)
    equal = [r["taken"] for r in got if r["doc_id"] is None]
    assert len(equal) == 300 and max(equal) - min(equal) <= 6


def test_equal_rows_are_cut(spark):
    """All rows of a source equal: the cut falls inside the tie."""
    rows = [(1, "a b c d", "a")] * 1000 + [(2, "x y", "b")] * 3000
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)).collect()
    check(rows, got)


def test_nested_budgets(spark):
    rows = spark.range(3000).selectExpr("'s' AS source", "1 + id % 7 AS size", "xxhash64(id) & 1152921504606846975 AS u", "id AS w")
    rows = mixing.materialize(rows, "test-mix")
    before = set()
    for left in (1.0, 500.0, 501.0, 6000.0, 11990.0):
        cut = mixing.thresholds(rows, spark.createDataFrame([("s", left)], "source string, left double")).first()
        now = {(r["u"], r["size"]) for r in rows.filter((rows["u"] < cut["cut_u"])).collect()}
        assert before <= now and abs(sum(s for _, s in now) - left) <= 3.5
        before = now


def test_salted_look_up(spark):
    big = spark.range(1000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE id % 5 END AS source", "id AS u", "id AS w")
    small = spark.createDataFrame([(None, "n"), (0, "a"), (1, "b"), (2, "c"), (3, "d"), (4, "e")], "_s long, name string")
    on = big["source"].eqNullSafe(small["_s"])
    assert mixing.look_up(big, small, on, salts=8, most=2).count() == 1000 == mixing.look_up(big, small, on).count()


def test_empty(spark, empty):
    assert mixing.mix(empty).collect() == []
    got = mixing.mix(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
