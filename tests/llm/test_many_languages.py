"""Every label of the training rows can be predicted, however many there are."""

from lendlens.llm import language_id


def test_rare_labels_are_learned(spark):
    rows = [(i, f"some words of kind {i % 70}", f"l{i % 70:02d}") for i in range(700)] + [(i, "x y z", "l00") for i in range(700, 720)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    network = language_id.train(docs, hold_out=-1, steps=2)
    assert network.languages == [f"l{i:02d}" for i in range(70)]
    _, texts, labels = language_id.training_rows(docs, -1, 5, 3, 4)
    assert set(labels) == set(range(70)) and len(texts) == len(labels) == 70 * 3 * 4
    assert language_id.predict(docs, network, ["doc_id"]).filter("lang_pred = 'und'").count() == 0
