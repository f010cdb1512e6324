"""Read-side reports over the finished tables (book overview, KPIs, heatmap,
densities, sample).  None of them cleans data; all are aggregates of the
feature table or of the segment table."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.functions.numeric import round_half_away
from lendlens.operators.joins import pin_small
from lendlens.plans.export import REPORT_ORDER
from lendlens.sources.ordered import sort_keys

# Exchange rate and unit of the dashboard's money measures.
INR_PER_USD = 83
CRORE = 10_000_000


def _r(c: F.Column, digits: int, rounded: bool) -> F.Column:
    return round_half_away(c, digits) if rounded else c


def in_order(table: DataFrame, name: str) -> DataFrame:
    """O3: one of the stored report tables in its report order."""
    return table.orderBy(*sort_keys(REPORT_ORDER[name]))


def grade_overview(features: DataFrame, rounded: bool = False) -> DataFrame:
    """Loans, default %, mean rate / fico / dti and disbursed (bn) by grade."""
    return features.groupBy("grade").agg(
        F.count(F.lit(1)).alias("n_loans"),
        _r(F.avg("is_default") * 100, 1, rounded).alias("default_pct"),
        _r(F.avg("int_rate"), 1, rounded).alias("avg_rate_pct"),
        _r(F.avg("fico"), 0, rounded).alias("avg_fico"),
        _r(F.avg("dti"), 1, rounded).alias("avg_dti"),
        _r(F.sum("loan_amnt") / 1e9, 2, rounded).alias("disbursed_bn_usd"),
    ).orderBy(*sort_keys(["grade"]))


def verification_profile(features: DataFrame, rounded: bool = False) -> DataFrame:
    """Default %, income, dti and rate by income-verification status."""
    return features.groupBy("verification_status").agg(
        F.count(F.lit(1)).alias("n"),
        _r(F.avg("is_default") * 100, 1, rounded).alias("default_pct"),
        _r(F.avg("annual_inc"), 0, rounded).alias("avg_income"),
        _r(F.avg("dti"), 1, rounded).alias("avg_dti"),
        _r(F.avg("int_rate"), 1, rounded).alias("avg_rate"),
    ).orderBy(*sort_keys(["-default_pct", "verification_status"]))


def heatmap_long(seg_risk: DataFrame) -> DataFrame:
    """A10: loan-weighted default rate and bad-money share by grade x income decile,
    over the volume-filtered segments (suppressed segments are absent)."""
    return seg_risk.groupBy("grade", "income_decile").agg(
        (F.sum(F.col("n_loans") * F.col("default_rate")) / F.sum("n_loans")).alias("default_rate"),
        F.try_divide(F.sum("defaulted_amount"), F.sum("disbursed")).alias("bad_share"),
    ).orderBy(*sort_keys(["grade", "income_decile"]))


def heatmap_pivot(seg_risk: DataFrame, deciles: int = 10) -> DataFrame:
    """Grade rows x decile columns ``d1..d10`` of the weighted default rate."""
    longf = heatmap_long(seg_risk)
    wide = longf.groupBy("grade").pivot("income_decile", list(range(1, deciles + 1))).agg(
        F.first("default_rate"))
    return wide.select("grade", *[F.col(str(i)).alias(f"d{i}") for i in range(1, deciles + 1)]).orderBy(*sort_keys(["grade"]))


def sliced(features: DataFrame, term_months: int | None = None, grades=None, purposes=None,
           vintage_year: int | None = None) -> DataFrame:
    """dashboard slicers as optional filters (pushed into the scan)."""
    df = features
    if term_months is not None:
        df = df.filter(F.col("term_months") == term_months)
    if grades:
        df = df.filter(F.col("grade").isin(list(grades)))
    if purposes:
        df = df.filter(F.col("purpose").isin(list(purposes)))
    if vintage_year is not None:
        # a date range (not year(...)) is pushed into the scan; the same range on
        # the quarter column prunes partitions of a quarter-partitioned fact
        lo, hi = F.lit(f"{vintage_year}-01-01").cast("date"), F.lit(f"{vintage_year + 1}-01-01").cast("date")
        df = df.filter((F.col("issue_date") >= lo) & (F.col("issue_date") < hi))
        if "vintage_quarter" in df.columns:
            df = df.filter((F.col("vintage_quarter") >= lo) & (F.col("vintage_quarter") < hi))
    return df


def portfolio_kpis(features: DataFrame, **slicers) -> DataFrame:
    """Disbursed (USD and INR crore), loans, default rate, loss rate, mean FICO."""
    df = sliced(features, **slicers)
    net = F.col("loan_amnt") - F.col("actual_total_pymnt") - F.col("actual_recoveries")
    return df.agg(
        F.sum("loan_amnt").alias("disbursed"),
        (F.sum("loan_amnt") * INR_PER_USD / CRORE).alias("disbursed_cr"),
        F.count(F.lit(1)).alias("n_loans"),
        F.try_divide(F.sum("is_default"), F.count(F.lit(1))).alias("default_rate"),
        F.try_divide(F.sum(F.when(F.col("is_default") == 1, net).otherwise(F.lit(0.0))),
                     F.sum("loan_amnt")).alias("loss_rate"),
        F.avg("fico").alias("avg_fico"),
    )


def default_by(features: DataFrame, by: str | F.Column, name: str | None = None) -> DataFrame:
    """Loans and default rate per group."""
    key = F.col(by) if isinstance(by, str) else by
    return features.groupBy(key.alias(name or str(by))).agg(
        F.count(F.lit(1)).alias("n_loans"),
        F.try_divide(F.sum("is_default"), F.count(F.lit(1))).alias("default_rate"))


def default_by_year(features: DataFrame) -> DataFrame:
    return default_by(features, F.year("issue_date").cast("int"), "yr")


def disbursed_by_purpose(features: DataFrame) -> DataFrame:
    """R2: money disbursed per purpose."""
    return features.groupBy("purpose").agg(F.sum("loan_amnt").alias("disbursed"),
                                           F.count(F.lit(1)).alias("n_loans"))


def default_lift(features: DataFrame, by: str = "grade", **slicers) -> DataFrame:
    """Default rate of each (sliced) group over the unsliced book rate."""
    book_rate = features.agg(F.avg("is_default")).first()[0]
    grp = default_by(sliced(features, **slicers), by)
    return grp.withColumn("lift", F.col("default_rate") / F.nullif(F.lit(book_rate), F.lit(0.0)))


def bad_share(features: DataFrame, by: str = "grade") -> DataFrame:
    """Share of money, not loans, that went bad, per group."""
    return features.groupBy(by).agg(
        F.try_divide(F.sum(F.when(F.col("is_default") == 1, F.col("loan_amnt"))),
                     F.sum("loan_amnt")).alias("bad_share"))


def worst_pocket(seg_risk: DataFrame, grades, purpose: str, max_decile: int) -> DataFrame:
    """The segments of some grades x one purpose x the lowest income deciles."""
    return seg_risk.filter(F.col("grade").isin(list(grades)) & (F.col("purpose") == purpose)
                           & (F.col("income_decile") <= max_decile))


# ---------------------------------------------------------------- M15 density
def class_density(features: DataFrame, col: str, by: str = "is_default", gridsize: int = 200,
                  cut: float = 3.0) -> DataFrame:
    """Gaussian KDE of ``col`` per class on each class's own grid, each class
    normalised to 1 (Scott bandwidth, sample std; grid from min - cut*h to
    max + cut*h).

    Exact: rows are first reduced to (class, value, count) by a partial
    aggregation; each task then adds its values' kernels onto the (small,
    per class) grid with numpy and emits ``gridsize`` partial sums per class;
    a last aggregation adds the partials.  No row x grid product is emitted.
    """
    x = F.col(col).cast("double")
    valid = features.filter(x.isNotNull() & ~F.isnan(x))
    st = valid.groupBy(by).agg(F.count(F.lit(1)).alias("n"), F.stddev_samp(x).alias("sd"),
                               F.min(x).alias("lo"), F.max(x).alias("hi")).collect()
    grids = {}
    for r in st:
        if r["n"] < 2 or not r["sd"]:
            continue
        h = r["sd"] * r["n"] ** (-1.0 / 5.0)
        a, b = r["lo"] - cut * h, r["hi"] + cut * h
        step = (b - a) / (gridsize - 1)
        grid = [a + k * step for k in range(gridsize)]
        grid[-1] = b                       # as linspace: the last point is the upper end
        grids[r[by]] = (h, r["n"], grid)
    distinct = valid.groupBy(by, x.alias("v")).agg(F.count(F.lit(1)).alias("c"))

    def partial(batches):
        for pdf in batches:
            out = []
            for cls, g in pdf.groupby(by):
                if cls not in grids:
                    continue
                h, _, gx = grids[cls]
                z = (np.asarray(gx)[None, :] - g["v"].to_numpy()[:, None]) / h
                s = (g["c"].to_numpy()[:, None] * np.exp(-0.5 * z * z)).sum(axis=0)
                out.append(pd.DataFrame({by: cls, "grid_index": np.arange(len(gx), dtype="int64"), "s": s}))
            if out:
                yield pd.concat(out, ignore_index=True)

    schema = f"{by} {distinct.schema[by].dataType.simpleString()}, grid_index bigint, s double"
    sums = distinct.mapInPandas(partial, schema).groupBy(by, "grid_index").agg(F.sum("s").alias("s"))
    spark = features.sparkSession
    grid_rows = [(cls, k, gx[k], 1.0 / (n * h * math.sqrt(2 * math.pi)))
                 for cls, (h, n, gx) in grids.items() for k in range(len(gx))]
    grid = pin_small(spark.createDataFrame(
        grid_rows, f"{by} {distinct.schema[by].dataType.simpleString()}, grid_index bigint, x double, norm double"))
    return (sums.join(F.broadcast(grid), [by, "grid_index"])
            .select(by, "grid_index", "x", (F.col("s") * F.col("norm")).alias("density")))


def sample_loans(features: DataFrame, n: int = 150_000, seed: int = 42,
                 cols=("is_default", "int_rate", "fico", "dti", "loan_to_income")) -> DataFrame:
    """A fixed-size pseudo-random sample, repeatable for a seed.

    The sample is the ``n`` rows with the smallest ``md5(loan_id || seed)``
    (ties by ``loan_id``) -- a digest SQL engines compute identically.  A
    plain ``orderBy().limit(n)`` ships every task's top ``n`` to one task;
    here an approximate quantile of the digest's 60-bit prefix gives a
    threshold, an exact count checks that at least ``n`` rows fall at or
    below it (else it is raised), and only those rows reach the final top-n.
    A NULL id is digested as the empty text, so it is placed alike at every size.
    """
    digest = F.md5(F.concat(F.coalesce(F.col("loan_id"), F.lit("")), F.lit(str(seed))))
    keyed = features.select("loan_id", *cols, digest.alias("__k"),
                            F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint").alias("__p"))
    total = features.count()
    if total > 4 * n:
        frac = n / total
        for margin in (0.01, 0.05, 0.25):
            p = min(1.0, frac * (1 + margin) + 2e-4)
            t = keyed.agg(F.percentile_approx("__p", p, 10_000)).first()[0]
            if keyed.filter(F.col("__p") <= t).count() >= n:
                keyed = keyed.filter(F.col("__p") <= F.lit(t))
                break
    return keyed.orderBy("__k", "loan_id").limit(n).drop("__k", "__p")
