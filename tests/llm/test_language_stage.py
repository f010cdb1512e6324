"""The language stage keeps rows by the predicted language and its score."""

import numpy as np
import pytest

import corpus_pipeline
from lendlens.llm import language_id

SCHEMA = "doc_id long, text string, lang string"
TEXTS = [(1, "the cat sat on the mat"), (2, "der hund und die katze"), (3, "12 34"), (4, None), (5, "zzz"), (None, "no id")]


def ids(df):
    return {r["doc_id"] for r in df.collect()}


def network(*bias):
    """Says the same for every text: the softmax of ``bias`` over de, en, xx."""
    net = language_id.Network(["de", "en", "xx"])
    net.p = {k: np.zeros_like(v) for k, v in net.p.items()}
    net.p["bias"] = np.array(bias, np.float32)
    return net


@pytest.mark.parametrize("bias, options, want", [
    ((0, 5, 0), {}, {1, 2, 5, None}),
    ((0, 0, 5), {}, set()),                                  # a language that is not wanted
    ((0, 0, 5), {"languages": None}, {1, 2, 5, None}),
    ((0, 5, 0), {"languages": ("de",)}, set()),
    ((0, 0.1, 0), {}, set()),                                # no language outweighs the others
    ((0, 0.1, 0), {"least_score": 0.34}, {1, 2, 5, None})])
def test_rejects_by_prediction(spark, monkeypatch, bias, options, want):
    monkeypatch.setattr(corpus_pipeline, "train", lambda docs: network(*bias))
    docs = spark.createDataFrame([(i, t, "en") for i, t in TEXTS], SCHEMA)
    assert ids(corpus_pipeline.language_stage(spark, docs, None, **options)) == want


@pytest.mark.parametrize("columns", [["doc_id", "text", "lang"], ["doc_id", "text"]])
def test_unlabelled_table_keeps_texts(spark, columns):
    docs = spark.createDataFrame([(i, t, None) for i, t in TEXTS], SCHEMA).select(columns)
    got = corpus_pipeline.language_stage(spark, docs, None)
    assert got.columns == columns and ids(got) == {1, 2, 5, None}
