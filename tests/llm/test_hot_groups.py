"""Hot groups: equal rows, stars with most edges, long repeats: same results by every path."""

import collections
import random

from lendlens.llm.common import materialize, slots
from lendlens.llm.components import components


def test_slots_of_equal_rows(spark):
    """A third of all rows equal, ids NULL: numbered without gaps, by many tasks."""
    rows = spark.range(30_000).selectExpr("CAST(id % 2 AS INT) AS g", "CASE WHEN id % 3 = 0 THEN NULL ELSE id END AS doc_id", "'same' AS t")
    stored = materialize(rows.repartition(6), "test-slots")
    numbered = slots(stored, "g", ["doc_id", "t"], rows_per_piece=300, least=4)
    assert numbered.columns == ["g", "doc_id", "t", "slot"]
    by = collections.defaultdict(list)
    for r in numbered.collect():
        by[r["g"]].append(r["slot"])
    assert {g: sorted(s) == list(range(15_000)) for g, s in by.items()} == {0: True, 1: True}
    again = slots(stored, "g", ["doc_id", "t"], rows_per_piece=300, least=4)
    assert sorted(map(str, again.collect())) == sorted(map(str, numbered.collect()))


def test_components_by_every_path(spark):
    rnd = random.Random(8)
    edges = [(0, k) for k in range(1, 400)] + [(rnd.randint(500, 900), rnd.randint(500, 900)) for _ in range(250)] + [(k, k + 1) for k in range(2000, 2060)] + [(7, 7)]
    label = {}

    def root(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            label[max(x, y)] = min(x, y)
    want = {x: root(x) for x in label}
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    for few, frequent in ((500_000, 10_000), (3, 20)):
        assert {r["node"]: r["component"] for r in components(df, few, frequent).collect()} == want
