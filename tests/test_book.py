"""The layers of a loan book over a view of other tables."""

from lendlens.plans import book as B
from lendlens.session import DEFAULT_CONF, split_methods

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def test_methods_are_split_and_text_is_landed_once(spark, monkeypatch):
    """Loans are typed in methods that get compiled; the text is stored at the first use and only once."""
    limits = {}

    def stored(df, name):
        limits[name] = df.sparkSession.conf.get(LIMIT)
        return df

    monkeypatch.setattr(B, "materialize", stored)
    monkeypatch.setattr(B, "stage_loans", lambda raw: raw)
    monkeypatch.setattr(B, "loan_features", lambda loans: loans)
    monkeypatch.setattr(B, "raw_loans", lambda spark, sf_dir: spark.createDataFrame([("1",)], "id string"))
    monkeypatch.setattr(B, "_BOOKS", {})
    before = spark.conf.get(LIMIT)
    try:
        spark.conf.set(LIMIT, 65535)
        made = B.book(spark, "made up")
        assert limits == {"loans": DEFAULT_CONF[LIMIT], "loan_features": DEFAULT_CONF[LIMIT]}
        assert made.landed() is made.landed() and limits["loans_raw"] == "65535"
        assert made.features.count() == 1 and spark.conf.get(LIMIT) == "65535"
        with split_methods(spark):
            assert spark.conf.get(LIMIT) == DEFAULT_CONF[LIMIT]
        assert spark.conf.get(LIMIT) == "65535"
    finally:
        spark.conf.set(LIMIT, before)
