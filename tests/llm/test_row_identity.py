"""Stages that drop rows drop exactly the rows they found, also with NULL and repeated doc_ids."""

import numpy as np

import corpus_pipeline
from lendlens.llm.decontaminate import drop_contaminated
from lendlens.llm.jaccard_join import jaccard_components, keep_one_per_group, shingles
from lendlens.llm.line_dedup import dedup_lines

SCHEMA = "doc_id long, text string"


def texts(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in df.collect())


def test_decontamination_by_row(spark):
    bad = " ".join(f"leak{i}" for i in range(12))
    clean = [(None, "clean without an id"), (None, None), (7, "clean under a repeated id"), (8, "clean")]
    rows = [*clean, (None, "x " + bad), (7, bad + " y"), (9, bad)]
    bench = spark.createDataFrame([("q", bad)], "item_id string, text string")
    got = drop_contaminated(spark.createDataFrame(rows, SCHEMA), bench)
    assert texts(got) == sorted((i is None, i or 0, t or "") for i, t in clean)


def test_one_per_group_by_row(spark):
    near = " ".join(f"a{i}" for i in range(100))
    other = " ".join(f"b{i}" for i in range(100))
    orphan = " ".join(f"c{i}" for i in range(100))
    alone = [(5, "one text of its own, found nowhere else in here"), (None, "a text of its own without any id"), (None, None), (6, "")]
    rows = [*alone, (1, near), (5, near + " tail"), (None, near + " end"),          # 5 and NULL are copies here, unique above
            (3, other), (3, other + " more"),                                       # one id, two near texts
            (None, orphan), (None, orphan + " z"), (None, orphan + " z y")]         # a family without any id
    got = texts(keep_one_per_group(spark.createDataFrame(rows, SCHEMA)))
    assert (False, 1, near) in got and len(got) == len(alone) + 3
    assert all((i is None, i or 0, t or "") in got for i, t in alone)
    assert sum(t.startswith("b0") for _, _, t in got) == sum(t.startswith("c0") for _, _, t in got) == 1


def test_short_slices(spark):
    """Slices of none to six words in all, and short texts behind a batch-filling one."""
    for counts in ([0], [1], [2], [3], [2, 1], [4], [5], [6], [1, 0, 5]):
        got, rows = shingles(np.arange(sum(counts), dtype=np.uint64), np.array(counts), 5)
        assert [int((rows == r).sum()) for r in range(len(counts))] == [0 if n == 0 else max(1, n - 4) for n in counts] and len(got) == len(rows)
    rows = [(1, " ".join(f"v{i % 9973}" for i in range(400_000))), (2, "two words"), (3, "two words")]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_components(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()}
    assert got == {1: 1, 2: 2, 3: 2}


def test_rows_without_words_all_stay(spark):
    rows = [(None, ""), (None, ""), (None, None), (None, None), (5, " "), (5, " "), (6, "one text"), (6, "one text")]
    got = texts(keep_one_per_group(spark.createDataFrame(rows, SCHEMA)))
    assert got == sorted((i is None, i or 0, t or "") for i, t in rows[:-1])


def test_clashing_names(spark):
    """A caller's columns named like inner ones come back as they were."""
    names = ["_doc", "_key", "_text", "_lines", "_gone", "_row", "row", "doc", "key", "linked", "told", "lang_pred", "label", "n_lines", "slot"]
    schema = SCHEMA + ", lang string, source string, " + ", ".join(f"{c} string" for c in names)
    same = "\n".join(f"line {i} of eight words in every such line" for i in range(9))
    rows = [(i, t, "en", "s", *[f"{c}{i}" for c in names]) for i, t in enumerate([same, "start\n" + same, "a text of its own", "", None])]
    docs = spark.createDataFrame(rows, schema)
    bench = spark.createDataFrame([("q", "nothing of these ten words is found in any text")], "item_id string, text string")
    for stage in (lambda d: corpus_pipeline.language_stage(spark, d, "", None, 0.0), dedup_lines, keep_one_per_group, lambda d: drop_contaminated(d, bench)):
        got = stage(docs).select(docs.columns).collect()
        assert len(got) >= 3
        for r in got:
            assert [r[c] for c in names] == [f"{c}{r['doc_id']}" for c in names]
