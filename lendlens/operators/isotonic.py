"""Isotonic regression as merges of monotone block stacks over range partitions.

Pooling adjacent violators is associative: a block is (lowest and highest x, weight,
weighted sum), a stack of blocks with rising means is the fit of its range, and
two neighbouring stacks merge by pooling at their junction.  So:

1. rows are summed per distinct x and range-partitioned by x (``ROWS`` a range),
2. every range is pooled into its own stack,
3. a block is *settled* when its mean is at least the largest mean of all earlier
   ranges and at most the smallest mean of all later ranges: nothing
   that is left can pool with it.  Only the others go on; settled
   blocks part them into independent stretches.  ``FAN`` neighbouring ranges then
   become one and step 2 repeats, until no unsettled blocks are left.

Per range only its least and largest mean are compared (one row a range); no
step sees all blocks.  Rounds: log(ranges) / log(FAN).

Predictions are linear between blocks and constant outside (as the analysed
calibration interpolates).  NULL and NaN x or y and weights that are not
positive are left out; no rows give an empty fit and NULL predictions.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lendlens.session import materialize, remove_stored

ROWS, FAN = 100_000, 8
MODEL_ROWS = 500_000          # blocks of a fit that may be collected for scoring
BLOCKS = "part bigint, lo double, hi double, weight double, total double"

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def pool(lo: np.ndarray, hi: np.ndarray, weight: np.ndarray, total: np.ndarray) -> list[np.ndarray]:
    """The stack of blocks (lo, hi, weight, total) with strictly rising means of blocks in ascending x."""
    a, b, w, t = (np.empty(len(lo)) for _ in range(4))
    k = 0
    for i in range(len(lo)):
        a[k], b[k], w[k], t[k] = lo[i], hi[i], weight[i], total[i]
        k += 1
        while k > 1 and t[k - 2] * w[k - 1] >= t[k - 1] * w[k - 2]:
            b[k - 2] = b[k - 1]
            w[k - 2] += w[k - 1]
            t[k - 2] += t[k - 1]
            k -= 1
    return [x[:k] for x in (a, b, w, t)]


def _pooled(ranges: DataFrame, by: list[str]) -> DataFrame:
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lo")
        lo, hi, w, t = pool(*[pdf[c].to_numpy(float) for c in ("lo", "hi", "weight", "total")])
        return pd.DataFrame({"part": int(pdf["part"].iloc[0]), "lo": lo, "hi": hi, "weight": w, "total": t})

    return ranges.groupBy(*by).applyInPandas(fit, BLOCKS)


def fit_isotonic(df: DataFrame, x: str, y: str, weight: str | None = None, rows: int = ROWS) -> DataFrame:
    """(lo, hi, weight, value): the blocks of the non-decreasing least-squares fit of ``y`` on ``x``."""
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    points = df.select(F.nanvl(F.col(x).cast("double"), F.lit(None)).alias("lo"), F.nanvl(F.col(y).cast("double"), F.lit(None)).alias("y"), w.alias("w"))
    points = points.filter("lo IS NOT NULL AND y IS NOT NULL AND w > 0").groupBy("lo").agg(F.sum("w").alias("weight"), F.sum(F.expr("w * y")).alias("total"))
    points = materialize(points, "isotonic-points")
    ranges = max(1, -(-points.count() // rows))
    ranged = points.repartitionByRange(ranges, "lo").select(F.spark_partition_id().cast("bigint").alias("part"), "lo", F.col("lo").alias("hi"), "weight", "total")
    ranged = materialize(ranged, "isotonic-ranges")
    remove_stored(points)
    open_ = materialize(_pooled(ranged, ["part"]), "isotonic-stacks")
    remove_stored(ranged)
    done = []
    while True:
        mean = F.col("total") / F.col("weight")
        sides = open_.groupBy("part").agg(F.min(mean).alias("least"), F.max(mean).alias("most"))
        order = Window.orderBy("part")                                  # one row a range
        sides = sides.select(F.col("part").alias("_part"), F.max("most").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("floor"),
                             F.min("least").over(order.rowsBetween(1, Window.unboundedFollowing)).alias("ceiling"))
        settled = F.coalesce(mean > F.col("floor"), F.lit(True)) & F.coalesce(mean < F.col("ceiling"), F.lit(True))
        marked = materialize(open_.join(F.broadcast(sides), F.col("part") == F.col("_part")).withColumn("settled", settled), "isotonic-marked")
        remove_stored(open_)
        done.append(marked.filter("settled"))
        if ranges == 1 or marked.filter("NOT settled").isEmpty():
            break
        ranges = -(-ranges // FAN)
        rest = marked.filter("NOT settled").select(F.floor(F.col("part") / FAN).cast("bigint").alias("part"), "lo", "hi", "weight", "total")
        open_ = materialize(_pooled(rest, ["part"]), "isotonic-stacks")
    blocks = done[0]
    for more in done[1:]:
        blocks = blocks.unionByName(more)
    return blocks.select("lo", "hi", "weight", (F.col("total") / F.col("weight")).alias("value"))


def isotonic_value(blocks: DataFrame, x: str, limit: int = MODEL_ROWS) -> Column:
    """The fit at column ``x``, linear between blocks.  The fit has as many blocks as steps; more than ``limit`` are refused."""
    held = blocks.select("lo", "hi", "value").limit(limit + 1).toPandas().sort_values("lo")
    if len(held) > limit:
        raise ValueError(f"a fit of more than {limit} steps cannot be shared with every task")
    at = np.column_stack([held["lo"], held["hi"]]).ravel().astype(float)
    value = np.repeat(held["value"].to_numpy(float), 2)

    def look_up(xs: pa.Array) -> pa.Array:
        v = xs.to_numpy(zero_copy_only=False).astype(float)
        return pa.array(np.interp(v, at, value) if len(at) else np.full(len(v), np.nan), pa.float64(), from_pandas=True)

    return F.arrow_udf(look_up, "double")(F.col(x).cast("double"))
