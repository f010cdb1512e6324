"""C4: vintage curves, cumulative default rate by months on book per quarter."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendlens.functions.cleaning import calendar_months
from lendlens.operators.joins import join_small


def cohort_sizes(features: DataFrame) -> DataFrame:
    """A4: loans per issue quarter (all completed loans, the denominator)."""
    return features.groupBy("vintage_quarter").agg(F.count(F.lit(1)).alias("cohort_n"))


def defaults_by_mob(features: DataFrame, max_mob: int = 60) -> DataFrame:
    """A5: charge-offs per quarter x months on book (at least 1, at most ``max_mob``).

    Charge-offs with no last-payment month have no timing and are left out
    of the numerator (they stay in the cohort size).
    """
    mob = F.greatest(F.lit(1).cast("bigint"), calendar_months("issue_date", "last_pymnt_date"))
    return (features
            .filter((F.col("is_default") == 1) & F.col("last_pymnt_date").isNotNull())
            .select("vintage_quarter", mob.alias("mob"))
            .filter(F.col("mob") <= max_mob)
            .groupBy("vintage_quarter", "mob")
            .agg(F.count(F.lit(1)).alias("n_defaults")))


def vintage_curves(features: DataFrame, max_mob: int = 60) -> DataFrame:
    """Running sum of defaults over months on book, divided by cohort size.

    Both inputs are aggregates (quarters x months); the cohort table is
    joined by size-checked broadcast and the running sum is a window over
    the aggregate partitioned by quarter.
    """
    d = defaults_by_mob(features, max_mob)
    joined = join_small(d, cohort_sizes(features), ["vintage_quarter"], null_safe=False)
    w = (Window.partitionBy("vintage_quarter").orderBy("mob")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (joined
            .withColumn("cum_default_rate",
                        F.sum("n_defaults").over(w).cast("double") / F.col("cohort_n").cast("double"))
            .select("vintage_quarter", "mob", "n_defaults", "cohort_n", "cum_default_rate"))


def vintage_by_year(curves: DataFrame, year_from: int | None = None, year_to: int | None = None,
                    max_mob: int = 48) -> DataFrame:
    """Unweighted mean of quarter curves per issue year and month on book.

    Quarters with no default at a month have no row there, so each mean is
    over the quarters that do.
    """
    yr = F.year("vintage_quarter").cast("int")
    c = curves.withColumn("yr", yr).filter(F.col("mob") <= max_mob)
    if year_from is not None:
        c = c.filter(F.col("yr") >= year_from)
    if year_to is not None:
        c = c.filter(F.col("yr") <= year_to)
    return c.groupBy("yr", "mob").agg(F.avg("cum_default_rate").alias("cum_dr")).orderBy("yr", "mob")


def vintage_at_mob(curves: DataFrame, mob: int = 36) -> DataFrame:
    """The by-year curve read at one month on book."""
    return (vintage_by_year(curves, max_mob=mob).filter(F.col("mob") == mob)
            .select("yr", "cum_dr"))


def observed_curves(curves: DataFrame, features: DataFrame, min_months: int = 36,
                    as_of=None) -> DataFrame:
    """curves of quarters observed for at least ``min_months`` months.

    ``as_of`` defaults to the last payment month in the book (one scalar).
    """
    if as_of is None:
        as_of = features.agg(F.max("last_pymnt_date")).first()[0]
    return curves.filter(calendar_months("vintage_quarter", F.lit(as_of).cast("date")) >= min_months)
