"""Exact dedup by a tree-merge of sorted digest runs (DataFrame functions only).

Rows become narrow entries (digest, length of the original text, doc_id) and
are dealt into ``runs`` runs.  In each round runs are merged ``fan_in`` at a
time: run r goes to run r // fan_in, entries with the same digest meet and
only the best one and the count survive.  Rounds go on until one run is left,
spread over all tasks by digest.  Texts themselves never move.

Verification: beside SHA-256 each entry carries a second, unrelated digest
(xxhash64) and the byte length of the normalised text.  All three are part of
the merge key at every level, so entries are merged only when they agree.

Defined cases: NULL text counts as empty; texts of white space only equal the
empty text; NULL doc_id sorts after every other id; repeated rows (same
doc_id and text) are members like any other and, when they win, share
``kept``; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import column, materialize

BLANKS = "[\\x20\\x09-\\x0D]+"
KEY = ["sha", "check", "bytes"]


def entries(docs: DataFrame, runs: int) -> DataFrame:
    text = F.coalesce(column(docs, "text", "string"), F.lit(""))
    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), F.length(text).cast("long").alias("points"),
                       F.regexp_replace(text, BLANKS, "").alias("_norm"))
    return rows.select("doc_id", "points", F.sha2("_norm", 256).alias("sha"), F.xxhash64("_norm").alias("check"),
                       F.octet_length("_norm").alias("bytes"),
                       F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(runs)).cast("int").alias("run"))


def merge_runs(rows: DataFrame, runs: int, fan_in: int) -> DataFrame:
    """Winner and size of each digest class, through ceil(log_fan_in(runs)) merge rounds."""
    # the largest struct wins: longest text, then smallest id (a NULL id loses)
    best = F.struct("points", F.col("doc_id").isNotNull().alias("has_id"), (-F.col("doc_id")).alias("minus_id"))
    level = (rows.select(*KEY, "run", best.alias("best"), F.lit(1).cast("long").alias("n"))
             .groupBy("run", *KEY).agg(F.max("best").alias("best"), F.sum("n").alias("n")))
    while runs > 1:
        runs = -(-runs // fan_in)
        level = (level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
                 .groupBy("run", *KEY).agg(F.max("best").alias("best"), F.sum("n").alias("n")))
    return level.select(*KEY, (-F.col("best.minus_id")).alias("keep_id"), F.col("best.points").alias("keep_points"),
                        F.col("n").alias("group_size"))


def exact_dedup(docs: DataFrame, runs: int = 64, fan_in: int = 8) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per input row."""
    rows = materialize(entries(docs, runs), "dedup-entries")
    classes = materialize(merge_runs(rows, runs, fan_in), "dedup-classes")
    mine = rows.join(classes, KEY)
    return mine.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points"))).alias("kept"),
        F.col("sha").alias("text_sha256"))
