"""Connected components of an edge table by alternating large-star / small-star rounds.

Public algorithm (Kiveris et al., "Connected Components in MapReduce and
Beyond").  Every round is written to the shared folder, so a lost executor
re-reads it.  A star's centre may hold any share of the edges: minima are
partially aggregated and go back to the edges by broadcast, all of them when
they are few (checked), else those of frequent centres.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import materialize


FREQUENT = 10_000          # neighbours from which a centre is met apart when the table of centres is large
FEW = 500_000              # centres that may be broadcast


def _lowest(pairs: DataFrame) -> DataFrame:
    """(a, m, n): least neighbour and number of neighbours of every node."""
    return materialize(pairs.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), "component-centres")


def _with_lowest(pairs: DataFrame, low: DataFrame, few: int, frequent: int) -> DataFrame:
    """``pairs`` with m; a centre of any size stays spread: its neighbours are never shuffled to it."""
    small = low.select("a", "m")
    if low.limit(few + 1).count() <= few:
        return pairs.join(F.broadcast(small), "a")
    hot = F.broadcast(small.filter(F.col("n") >= frequent))                # at most pairs / frequent
    cold = small.filter(F.col("n") < frequent)
    return pairs.join(hot, "a").unionByName(pairs.join(hot, "a", "left_anti").join(cold, "a"))


def _large_star(edges: DataFrame, few: int = FEW, frequent: int = FREQUENT) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _lowest(both).withColumn("m", F.least("m", "a"))
    return _with_lowest(both.filter("b > a"), low, few, frequent).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame, few: int = FEW, frequent: int = FREQUENT) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a > b")
    low = _lowest(down)
    moved = _with_lowest(down, low, few, frequent).filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, few: int = FEW, frequent: int = FREQUENT) -> DataFrame:
    """node, component (its smallest node) for every node of an edge (columns a, b)."""
    def fingerprint(df: DataFrame):
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    seen = fingerprint(now)
    if not seen[0]:
        return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    while True:                                            # every round lowers some label until none is left to lower
        now = materialize(_small_star(materialize(_large_star(now, few, frequent), "component-stars"), few, frequent), "components")
        after = fingerprint(now)
        if after == seen:
            break
        seen = after
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
