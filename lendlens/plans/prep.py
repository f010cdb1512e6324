"""M3-M5: preparation statistics fitted on the training rows only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.functions.cleaning import nan_to_null
from lendlens.operators.quantile import exact_quantiles
from lendlens.plans.policy import NUMERIC

MISSING_LEVEL = "__missing__"


def medians(train: DataFrame, cols: list[str] = NUMERIC) -> dict[str, float]:
    """M3: exact (interpolated) median per column, NaN treated as missing.

    Radix selection (``exact_quantiles``): every pass is one aggregate over
    all columns, and no task holds a column's distinct values.
    """
    return exact_quantiles(train, list(cols), 0.5)


def long_table(spark, stats: dict[str, dict[str, float]], cols: list[str]) -> DataFrame:
    """Small statistics table (one row per feature) from driver-side scalars."""
    names = list(stats)
    rows = [(c, *[None if stats[k][c] is None else float(stats[k][c]) for k in names]) for c in cols]
    return spark.createDataFrame(rows, "feature string, " + ", ".join(f"{k} double" for k in names))


def impute(df: DataFrame, med: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(nan_to_null(c), F.lit(v)) if v is not None else nan_to_null(c)
                           for c, v in med.items()})


def scale_stats(train: DataFrame, med: dict[str, float]) -> dict[str, dict[str, float]]:
    """M4: mean and population std of the imputed training columns (one pass)."""
    imp = impute(train, med)
    cols = list(med)
    row = imp.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                  *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    return {"mean": {c: row[f"m_{c}"] for c in cols}, "std": {c: row[f"s_{c}"] for c in cols}}


def prep_stats_frame(train: DataFrame, cols: list[str] = NUMERIC) -> DataFrame:
    """Median, mean and population std per feature as a DataFrame."""
    med = medians(train, cols)
    sc = scale_stats(train, med)
    return long_table(train.sparkSession, {"median": med, "mean": sc["mean"], "std": sc["std"]}, cols)


def union_all(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)
