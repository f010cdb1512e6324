"""The materialised layers of one loan book, built once per session and source."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

from lendlens.session import materialize, remove_stored, shuffles_removed, split_methods
from lendlens.sources.fixture import raw_loans
from lendlens.plans.staging import stage_loans
from lendlens.plans.features import loan_features

_BOOKS: dict = {}
_LOCK = threading.Lock()


class Book:
    """Staged loans and the feature table of one source, written once.

    Four families of outputs read the feature table, so it is written to the
    shared folder (lineage cut, Parquet pruning for every reader).  The loans are a
    projection of it; their own table is there while the features are computed.
    """

    def __init__(self, spark: SparkSession, raw: DataFrame, land_raw: bool = False):
        self.spark = spark
        # A CSV source is landed once as Parquet (a gzip file is one split;
        # see ``jobs.build_warehouse``).  The fixture view already reads
        # splittable Parquet tables, so typing runs on it directly.
        self.raw = materialize(raw, "loans_raw") if land_raw else raw
        with split_methods(spark), shuffles_removed(spark):
            loans = materialize(stage_loans(self.raw), "loans")
            self.features = materialize(loan_features(loans), "loan_features")
        # the features hold every column of the loans, which need no second table
        self.loans = self.features.select(*loans.columns)
        remove_stored(loans)
        self.cache: dict = {}
        self._lock = threading.Lock()

    def landed(self) -> DataFrame:
        """The raw text as a stored table, for readers of all its columns (written once)."""
        with self._lock:
            if "landed" not in self.cache:
                self.cache["landed"] = materialize(self.raw, "loans_raw")
            return self.cache["landed"]

    def models(self, gbt_iter: int = 400, **kw):
        """Trained models and test scores for these settings (fitted once)."""
        from lendlens.plans.model import train_and_score
        key = ("models", gbt_iter, tuple(sorted(kw.items())))
        with self._lock:
            if key not in self.cache:
                self.cache[key] = train_and_score(self.features, gbt_iter=gbt_iter, **kw)
            return self.cache[key]


def book(spark: SparkSession, sf_dir: str) -> Book:
    """Book over the fixture view of the driver tables in ``sf_dir`` (memoised)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _LOCK:                      # concurrent callers share one build
        if key not in _BOOKS:
            _BOOKS[key] = Book(spark, raw_loans(spark, sf_dir))
        return _BOOKS[key]
