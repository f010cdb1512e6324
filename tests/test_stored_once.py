"""What the book and the models leave on disk, and that their rows are as before."""

import os

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lendlens.operators.isotonic import fit_isotonic
from lendlens.plans import model, policy, prep
from lendlens.plans.book import Book
from lendlens.plans.staging import LOANS_COLUMNS, stage_loans
from lendlens.session import remove_stored, shared_dir
from lendlens.sources.fixture import raw_loans
from test_landing_parts import counted, folder  # noqa: F401


def tables(spark):
    top = f"{shared_dir(spark).removeprefix('file:')}/tables"
    return set(os.listdir(top)) if os.path.isdir(top) else set()


@pytest.fixture(scope="module")
def made(spark, folder):  # noqa: F811
    before = tables(spark)
    book = Book(spark, raw_loans(spark, folder))
    return book, [name.rsplit("-", 1)[0] for name in tables(spark) - before]


def test_loans_are_not_stored_beside_the_features(spark, made):
    """one table of the book is left; the loans come from it."""
    book, left = made
    assert left == ["loan_features"]
    assert tuple(book.loans.columns) == LOANS_COLUMNS
    assert counted(book.loans) == counted(stage_loans(book.raw)) and book.loans.count() > 300


def test_design_is_not_stored(spark, made):
    """the encoded inputs are those of the library's encoder, without a table that holds them."""
    rows = policy.model_frame(made[0].features, keep=("loan_id",))
    train, test = rows.filter("loan_amnt < 6000"), rows.filter("loan_amnt >= 6000")
    before = tables(spark)
    tr, te, binning = model.design_tables(train, test)
    assert tables(spark) == before
    med = prep.medians(train)
    stats = prep.scale_stats(train, med)
    enc = Pipeline(stages=model._encoder_stages(model._numeric_inputs(med))).fit(model._standardise(train, med, stats))
    for ours, theirs in ((tr, train), (te, test)):
        want = enc.transform(model._standardise(theirs, med, stats)).select("loan_id", vector_to_array("x"))
        assert counted(ours.select("loan_key", "x")) == [r.replace("Row(loan_id", "Row(loan_key").replace("UDF(x)", "x") for r in counted(want.toDF("loan_id", "x"))]
    assert [list(x) for x in enc.stages[0].labelsArray] == list(binning.levels.values()) and te.count() > 50
    odd = spark.createDataFrame([(1.0, "a"), (float("nan"), "b")], "z double, c string")
    assert odd.filter("c = 'a'").select(model.encoded_inputs(["z"], {"c": ["a", "b"]}).alias("x")).first()["x"] == [1.0, 1.0, 0.0]
    with pytest.raises(Exception, match="missing or NaN"):
        odd.select(model.encoded_inputs(["z"], {"c": ["a", "b"]}).alias("x")).collect()


def test_isotonic_steps_go(spark):
    """of the fit's steps only the settled blocks stay, until they are removed too."""
    before = tables(spark)
    rng = np.random.RandomState(2)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(rng.rand(90), rng.rand(90))], "x double, y double")
    blocks = fit_isotonic(df, "x", "y", rows=9)
    assert {name.rsplit("-", 1)[0] for name in tables(spark) - before} == {"isotonic-marked"}
    assert blocks.count() > 0
    remove_stored(blocks)
    assert tables(spark) == before
