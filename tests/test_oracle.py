"""Every registered query against its DuckDB oracle (rows, columns, values)."""

import os
import sys

import pytest

from paths import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "tools"))
import __spark_entry__ as E  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SQL = E.oracle_sql()
SLOW = {"model_metrics", "model_scores", "model_cutoff_table"}


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    ref = con.execute(SQL[name]).fetchdf()
    r = compare(df, ref)
    assert r["rows_match"] and r["cols_match"] and r["hash_match"], r


def test_rows_only_queries_are_the_model_outputs():
    from lendlens import catalog
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == SLOW


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["vintage_quarter", "mob", "n_defaults", "cohort_n", "cum_default_rate"]
