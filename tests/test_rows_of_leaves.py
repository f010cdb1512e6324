"""Rows parted by a tree."""

import numpy as np
import pyarrow as pa

from lendlens.operators import boosting as B


def test_rows_of_leaves():
    """every node looks only at its own rows; a part of the rows is parted as all of them are."""
    rng, tree = np.random.RandomState(3), B.Tree()
    codes = rng.randint(0, 256, (4, 500)).astype(np.uint8)
    codes[3] = rng.choice([0, 1, 2, B.MISSING], 500)
    splits, ends = [(0, 100, False, True), (3, 1, True, False), (1, 30, False, False), (3, 2, True, False)], [0]
    for k, (at, cut, category, missing_left) in enumerate(splits):
        ends += tree.grow(ends.pop(0), B.Split(1.0, at, cut, category, missing_left, np.zeros(3), np.zeros(3)))
    tree.value = [float(k) for k in range(len(tree.left))]

    def leaf(row):
        node = 0
        while tree.left[node] >= 0:
            code = codes[tree.input[node], row]
            left = code != tree.at[node] if tree.category[node] else tree.missing_left[node] if code == B.MISSING else code <= tree.at[node]
            node = tree.left[node] if left else tree.right[node]
        return node

    want = [leaf(row) for row in range(500)]
    assert B.leaf_of(tree, codes).tolist() == want and len(set(want)) > 3
    some = np.flatnonzero(rng.rand(500) < 0.4)
    for node, rows in B.rows_at(tree, codes, some).items():
        assert rows.tolist() == [r for r in some if want[r] == node]
    binning = B.Binning({"a": [0.0]}, {"c": ["p", "q"]})
    assert binning.codes([pa.array([1.0, -1.0, None]), pa.array(["q", None, "z"])]).tolist() == [[1, 0, B.MISSING], [1, B.MISSING, B.MISSING]]
    assert B.Boosted(binning, 0.0, [tree, tree]).raw(codes, 1).tolist() == [float(k) for k in want]
