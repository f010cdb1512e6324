"""Families of the join: long texts that share phrases stay apart, and the visited lists lose no link."""

import itertools

import numpy as np

from lendlens.llm import jaccard_join as J
from lendlens.llm.common import materialize


def long_rows(n_texts=24, words=3000):
    """Long texts of words of their own that share a phrase with the next one, a near copy, and a subset at the limit of 80 percent."""
    rows = []
    for k in range(n_texts):
        t = [f"w{k}x{i}" for i in range(words + 40 * (k % 5))]
        for at in (k, (k + 1) % n_texts):
            t[100 * (at % 2):100 * (at % 2)] = [f"phrase{at}y{i}" for i in range(6)]
        rows.append((k, " ".join(t)))
    near = rows[0][1].split()
    near[50] = "changed"
    part = rows[1][1].split()
    return rows + [(100, " ".join(near)), (101, " ".join(part[:-(-(len(part) - 4) * 80 // 100) + 4]))]


def test_long_texts_stay_apart(spark):
    docs = spark.createDataFrame(long_rows(), "doc_id long, text string")
    empty = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    order = spark.sparkContext.broadcast(empty)
    rows = materialize(J.prefix_table(docs, 5, 80, order), "test-prefixes")
    sets = J.distinct_sets_of(rows)
    live = materialize(J.live_entries(sets, 80, 32, 64, order, 200_000), "test-live")
    lists = materialize(J.first_lists(live), "test-lists")
    held = {x: frozenset(r["set_id"] for r in g) for x, g in itertools.groupby(sorted(live.collect(), key=lambda r: r["sh"]), lambda r: r["sh"])}
    assert lists.select("sh").distinct().count() == len(set(held.values())) < len(held)
    edges = {frozenset((r["a"], r["b"])) for r in J.family_edges(lists, sets, 80, 32, 200_000).collect()}
    ids = {r["doc_id"]: r["set_id"] for r in rows.collect()}
    assert edges == {frozenset((ids[0], ids[100])), frozenset((ids[1], ids[101]))}
    got = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(docs).collect()}
    assert got == {**{k: k for k in range(24)}, 100: 0, 101: 1}


def test_bitmaps_bound_the_difference():
    """At any two widths differing bits are at most the shingles in one of the two sets only; equal sets have none."""
    rng = np.random.RandomState(3)
    base = rng.randint(0, 1 << 60, 30_000).astype(np.uint64)
    sets = [np.unique(base[lo:hi]) for lo, hi in ((0, 3), (0, 900), (10, 1100), (0, 2500), (0, 20_000), (30, 30_000))]
    n = np.array([len(s) for s in sets])
    raw = J.bitmaps(np.concatenate(sets), np.repeat(np.arange(len(n)), n), n)
    assert [8 * len(b) for b in raw] == [512, 512, 1024, 2048, 1 << 14, 1 << 14]
    i, j = np.array(list(itertools.product(range(len(n)), repeat=2))).T
    differ = J.Bitmaps(raw).differ(i, j)
    true = [len(set(sets[a].tolist()) ^ set(sets[b].tolist())) for a, b in zip(i, j)]
    assert (differ <= true).all() and (differ[i == j] == 0).all() and differ[(n[i] == 3) & (n[j] == n[1])][0] > 200


def test_copies_by_both_paths(spark, monkeypatch):
    rows = [(k, f"a text of some words {k // 3}") for k in range(30)] + [(99, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(str, J.jaccard_components(docs).collect()))
    monkeypatch.setattr(J, "REPEATED", 2)
    assert sorted(map(str, J.jaccard_components(docs).collect())) == want
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
