"""Katz scores of orders 1 to 4 against a recursion over plain dictionaries."""

import collections
import re
import zlib

import numpy as np
import pytest

from lendlens.llm import katz
from lendlens.llm.queries import QUERIES
from lendlens.llm.common import table
from test_operators import lower

K = katz.K


def discounts(counts):
    n = [0] * (K + 2)
    for c in counts:
        if c <= K + 1:
            n[c] += 1
    for k in range(K, 0, -1):
        if all(n[1:k + 2]):
            cut = (k + 1) * n[k + 1] / n[1]
            d = {r: ((r + 1) * n[r + 1] / n[r] / r - cut) / (1 - cut) if cut != 1 else 0 for r in range(1, k + 1)}
            if all(0 < x <= 1 for x in d.values()):
                return d
    return {}


def brute(rows, order):
    """(scores of the rows, p(word, context), words) by the textbook recursion."""
    texts = [["<s>", *re.findall(r"[^\x20\x09-\x0D]+", lower(t or "")), "</s>"] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    grams = [collections.Counter() for _ in range(order + 1)]
    for t, out in zip(texts, held):
        if not out:
            for k in range(1, order + 1):
                grams[k].update(tuple(t[s:s + k]) for s in range(1 if k == 1 else 0, len(t) - k + 1))
    d = [None] + [discounts(grams[k].values()) for k in range(1, order + 1)]
    followers = [collections.defaultdict(list) for _ in range(order + 1)]
    for k in range(1, order + 1):
        for g, c in grams[k].items():
            followers[k][g[:-1]].append((g[-1], c))

    def mass(k, h):
        total = sum(c for _, c in followers[k][h])
        kept = sum(d[k].get(c, 1) * c for _, c in followers[k][h])
        return kept, total if total - kept > 1e-9 * total else total + 1

    memo = {}

    def p(w, h):
        if (w, h) not in memo:
            k = len(h) + 1
            c = grams[k][h + (w,)]
            if h and h not in followers[k]:
                memo[w, h] = p(w, h[1:])
            else:
                kept, below = mass(k, h)
                if c:
                    memo[w, h] = d[k].get(c, 1) * c / below
                elif not h:
                    memo[w, h] = 1 - kept / below
                else:
                    memo[w, h] = (1 - kept / below) / (1 - sum(p(x, h[1:]) for x, _ in followers[k][h])) * p(w, h[1:])
        return memo[w, h]

    scores = [sum(np.log10(p(t[i], tuple(t[max(0, i - order + 1):i]))) for i in range(1, len(t))) for t in texts]
    return scores, p, [g[0] for g in grams[1]]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.RandomState(6)
    text = lambda n: " ".join(f"w{min(int(k), 60)}" for k in rng.geometric(0.12, n))
    out = [(i, text(int(rng.randint(0, 25)))) for i in range(160)] + [(500, None), (501, ""), (502, "Never seen WORDS at all w1 w2"), (None, "w1 w2 w3"), (None, text(300))]
    return out + [(600 + i, "w1 w2 w1 w2 one third of all rows") for i in range(70)]


@pytest.mark.parametrize("order,hot", [(1, None), (2, 20), (3, None), (4, 15)])
def test_scores(spark, rows, order, hot, monkeypatch):
    monkeypatch.setattr(katz, "BLOCK_TOKENS", 700)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, block string, levels int").repartition(3)
    got = katz.score_texts(df, order=order, hot=hot).collect()
    texts = {}
    for (i, t), s in zip(rows, brute(rows, order)[0]):
        texts.setdefault(i, []).append(s)
    mine = {}
    for r in got:
        mine.setdefault(r["doc_id"], []).append(r["score"])
    assert mine.keys() == texts.keys()
    for i in texts:
        np.testing.assert_allclose(sorted(mine[i]), sorted(texts[i]), rtol=1e-9, atol=1e-9)


def test_every_context_sums_to_one(rows):
    """The recursion that the scores equal is a distribution after every context, seen or not."""
    p, vocabulary = brute(rows, 3)[1:]
    for h in [(), ("<s>",), ("w1",), ("<s>", "w1"), ("w1", "w2"), ("w3", "never"), ("third", "of"), ("w60", "w2")]:
        assert sum(p(w, h) for w in vocabulary) + p("unknown", h) == pytest.approx(1, abs=1e-12)


def test_tables_are_dropped(spark):
    before = {t.name for t in spark.catalog.listTables()}
    assert QUERIES["op2_lm_scoring"](spark, "/root/testdata/sf0.001").count() == table(spark, "/root/testdata/sf0.001", "documents").count()
    assert {t.name for t in spark.catalog.listTables()} == before
