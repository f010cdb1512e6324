"""Exact interpolated quantiles of many columns by radix selection.

``percentile`` / ``median`` are exact but merge every distinct value of a
column in one task, which fails for continuous columns at scale.  Here an
order statistic is found digit by digit:

* the first pass counts all columns by (column, magnitude bucket); the bucket
  is a rising function of the value (64 a factor of e, by sign), so running
  counts inside the cluster give the bucket of every wanted rank,
* each further pass looks only at values of those buckets, cut in ``buckets``
  equal widths between the least and greatest value they really hold,
* a bucket whose least and greatest value agree is an answer.

A double has 52 bits of mantissa: with 2^16 widths a pass three passes after the
first always end it, whatever the data; most columns end after one or two.  Every pass
is one aggregate over all columns with partial aggregation; only the buckets
that hold a wanted rank (two a column and quantile) reach the driver.

The answer is linear interpolation between the two order statistics around
``q * (n - 1)`` (NULL and NaN ignored), i.e. SQL ``quantile_cont``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lendlens.functions.cleaning import nan_to_null

PER_E, OFFSET, INFINITE = 64, 50_000, 100_000


def _magnitude(v: Column) -> Column:
    """Bucket of a double: rising with the value, one for zero, one for each infinity."""
    size = F.abs(v)
    level = F.when(size == float("inf"), F.lit(INFINITE).cast("bigint")).otherwise(F.floor(F.log(size) * PER_E) + OFFSET)
    return F.when(v == 0, F.lit(0).cast("bigint")).when(v > 0, level).otherwise(-level)


def _hits(sums: DataFrame, group: str, wanted: Column) -> list:
    """Buckets of each group that hold a wanted rank: (group, total, before, lo, hi, at: the ranks)."""
    whole = Window.partitionBy(group)
    running = sums.withColumns({"total": F.sum("n").over(whole),
                                "upto": F.sum("n").over(whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))})
    inside = F.filter(F.array_distinct(wanted), lambda k: (k >= F.col("upto") - F.col("n")) & (k < F.col("upto")))
    found = running.withColumn("at", inside).filter(F.size("at") > 0)
    return found.select(group, "total", (F.col("upto") - F.col("n")).alias("before"), "lo", "hi", "at").collect()


def _counted(entries: DataFrame, group: str) -> DataFrame:
    return entries.groupBy(group, "bucket").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))


def quantile_table(df: DataFrame, cols: list[str], qs: list[float], buckets: int = 1 << 16) -> dict[str, list[float] | None]:
    """Column -> its quantiles ``qs``, or None for a column without values."""
    values = [nan_to_null(c) for c in cols]
    entry = F.array(*[F.struct(F.lit(i).alias("col"), v.alias("v")) for i, v in enumerate(values)])
    entries = df.select(F.explode(entry).alias("e")).select("e.col", "e.v").filter("v IS NOT NULL").withColumn("bucket", _magnitude(F.col("v")))
    first = [F.floor(F.lit(float(q)) * (F.col("total") - 1)) for q in qs]
    wanted = F.array(*first, *[F.least(k + 1, F.col("total") - 1) for k in first])
    total, known, open_ = {}, {}, []

    def sort_out(hits, columns):
        for h in hits:
            col = columns(h)
            if h["lo"] == h["hi"]:
                known.update({(col, k): h["lo"] for k in ranks(h)})
            else:
                open_.append((col, h["lo"], h["hi"], base(h) + h["before"], ranks(h)))

    ranks, base = lambda h: list(h["at"]), lambda h: 0                                   # noqa: E731
    hits = _hits(_counted(entries, "col"), "col", wanted)
    total = {h["col"]: h["total"] for h in hits}
    sort_out(hits, lambda h: h["col"])
    while open_:
        targets, open_ = open_, []
        inside = []
        for t, (col, lo, hi, _, _) in enumerate(targets):
            v = values[col]
            place = F.least(F.floor((v - F.lit(lo)) / F.lit(hi - lo) * buckets), F.lit(buckets - 1))
            inside.append(F.when((v >= F.lit(lo)) & (v <= F.lit(hi)), F.struct(F.lit(t).alias("target"), v.alias("v"), place.alias("bucket"))))
        entries = df.select(F.explode(F.array_compact(F.array(*inside))).alias("e")).select("e.*")
        at = F.element_at(F.array(*[F.array(*[F.lit(k - before).cast("bigint") for k in ks]) for _, _, _, before, ks in targets]), F.col("target") + 1)
        ranks = lambda h: [k + targets[h["target"]][3] for k in h["at"]]                  # noqa: E731
        base = lambda h: targets[h["target"]][3]                                          # noqa: E731
        sort_out(_hits(_counted(entries, "target"), "target", at), lambda h: targets[h["target"]][0])
    out = {}
    for i, c in enumerate(cols):
        out[c] = None
        if i in total:
            out[c] = []
            for q in qs:
                pos = q * (total[i] - 1)
                k = int(math.floor(pos))
                v0, v1 = known[i, k], known[i, min(k + 1, total[i] - 1)]
                out[c].append(v0 if pos == k or v0 == v1 else v0 + (v1 - v0) * (pos - k))
    return out


def exact_quantiles(df: DataFrame, cols: list[str], q: float = 0.5, buckets: int = 1 << 16) -> dict[str, float | None]:
    """Column -> its quantile ``q``."""
    return {c: None if v is None else v[0] for c, v in quantile_table(df, cols, [q], buckets).items()}
