"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lendlens.llm.shipping import ship
from lendlens.session import materialize

__all__ = ["materialize", "table", "column", "slots", "pinned", "lower_ascii", "small_enough", "few_elements"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def column(df: DataFrame, name: str, kind: str) -> Column:
    """``df[name]`` cast to ``kind``, or a typed NULL when the column is missing."""
    return df[name].cast(kind) if name in df.columns else F.lit(None).cast(kind)


def pinned(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` plus ``columns``, evaluated once per row.

    The optimizer merges neighbouring projections and repeats an expression for
    every use, inside lambdas even for every element; a one-row ``explode``
    between them keeps each value computed once.
    """
    held = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_pinned")
    return df.select("*", held).select(*[F.col(c) for c in df.columns if c not in columns], *[F.col("_pinned")[n].alias(n) for n in columns])


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only, as every token contract of this package asks."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slots(df: DataFrame, group: str, order: list[str], rows_per_piece: int = 20_000, least: int = 64) -> DataFrame:
    """``df`` with ``slot``: 0, 1, 2 ... within each value of ``group``, without gathering a group in one task.

    Each group is cut into pieces by a hash of the ordering columns; rows are
    numbered inside (group, piece) and shifted by the counts of the earlier
    pieces.  The number of pieces follows the row count, so a piece stays
    near ``rows_per_piece`` rows whatever share of the table one group holds.
    Rows equal in the ordering columns fall into one piece; a piece of many times that size is
    dealt further by the rows' places in the stored files.
    ``df`` must be a stored table: it is read several times.
    """
    pieces = max(least, -(-df.count() // rows_per_piece))
    place = F.xxhash64(F.col("_metadata.file_name"), F.col("_metadata.row_index"))
    cut = df.select("*", F.pmod(F.xxhash64(*order), F.lit(pieces)).cast("int").alias("_piece"), place.alias("_place"))
    counts = cut.groupBy(group, "_piece").agg(F.count(F.lit(1)).alias("_n"))
    big = materialize(counts.filter(F.col("_n") > 4 * rows_per_piece).select(
        F.col(group).alias("_bg"), F.col("_piece").alias("_bp"), F.ceil(F.col("_n") / rows_per_piece).alias("_parts")), "slot-big-pieces")
    cut = cut.join(F.broadcast(big), F.col(group).eqNullSafe(F.col("_bg")) & (F.col("_piece") == F.col("_bp")), "left")     # at most rows / (4 * rows_per_piece)
    cut = cut.withColumn("_part", F.when(F.col("_parts").isNotNull(), F.pmod("_place", F.col("_parts"))).otherwise(F.lit(0)).cast("int")).drop("_bg", "_bp", "_parts")
    counts = cut.groupBy(group, "_piece", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_piece", "_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(group).alias("_g"), F.col("_piece").alias("_p"), F.col("_part").alias("_q"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    ranked = cut.withColumn("_i", F.row_number().over(Window.partitionBy(group, "_piece", "_part").orderBy(*order)))
    joined = ranked.join(starts, F.col(group).eqNullSafe(F.col("_g")) & (F.col("_piece") == F.col("_p")) & (F.col("_part") == F.col("_q")), "left")
    return joined.withColumn("slot", (F.col("_start") + F.col("_i") - 1).cast("long")).drop("_piece", "_part", "_place", "_i", "_g", "_p", "_q", "_start")


def small_enough(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` marked for broadcast when it has at most ``max_rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def few_elements(df: DataFrame, array: str, most: int) -> DataFrame:
    """``df`` marked for broadcast when its ``array`` column holds at most ``most`` elements in all, else as it is."""
    held = df.agg(F.sum(F.size(array).cast("long") + 1)).first()[0] or 0
    return F.broadcast(df) if held <= most else df


LONG, STRING, BINARY = T.LongType(), T.StringType(), T.BinaryType()
