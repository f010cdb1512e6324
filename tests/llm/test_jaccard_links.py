"""Every link of the join is counted, also inside families of near copies."""

import numpy as np
import pytest

from lendlens.llm.jaccard_join import jaccard_components, join_blocks


def brute(sets, side, copies, percent):
    links = [0] * len(sets)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            both = len(x & y)
            if i != j and (side[i] < 0 or side[i] != side[j]) and both and 100 * both >= percent * len(x | y):
                links[i] += copies[j]
    return links


@pytest.mark.parametrize("two", [False, True])
def test_block_links(two):
    rng = np.random.RandomState(2)
    sets = []
    for family in range(4):
        base = set(range(1000 * family, 1000 * family + 60))
        for _ in range(25):
            sets.append((base - set(rng.choice(list(base), rng.randint(0, 12)).tolist())) | set(rng.randint(5000, 5040, rng.randint(0, 8)).tolist()))
    sets = [set(s) for s in {frozenset(s) for s in sets}]
    side = rng.randint(0, 2, len(sets)) if two else np.full(len(sets), -1)
    copies, ids = rng.randint(1, 4, len(sets)), rng.permutation(len(sets)) + 10
    child, root, links = join_blocks(ids, [np.array(sorted(s), np.uint64) for s in sets], side, 80, copies)
    assert links.tolist() == brute(sets, side, copies, 80) and links.max() > 5
    assert len(set(child)) == len(child) and (root < child).all()


@pytest.mark.parametrize("block_bytes", [1 << 23, 4000])
def test_links_per_document(spark, block_bytes):
    rng = np.random.RandomState(4)
    base, rows = [f"t{k}" for k in range(150)], [(0, None), (1, ""), (2, "short"), (3, "short"), (4, "alone here")]
    for i in range(40):
        t = list(base)
        for k in rng.randint(0, 150, rng.randint(0, 5)):
            t[k] = f"e{rng.randint(0, 4)}"
        rows.append((10 + i, " ".join(t)))
    rows += [(100, rows[-1][1]), (None, rows[-2][1])]
    words = [(t or "").split() for _, t in rows]
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set() for w in words]
    want = brute(sets, [-1] * len(sets), [1] * len(sets), 80)
    got = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=block_bytes).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r["doc_id"], r["n_links"]) for r in got), key=key) == sorted(((i, n) for (i, _), n in zip(rows, want)), key=key)
