"""O2: tables whose files carry an order, and a reader that tells each row its place.

A sorted write cuts the rows into ranges of the sort key, sorts each range and
writes it as one file; file names follow the ranges.  Reading back, the place of a row is the number of
rows in earlier files (one count a file) plus its index in its own file, so no sort
and no single task is needed to number them.  NULLs sort last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANGE_ROWS = 1_000_000


def sort_keys(order: list[str]) -> list[Column]:
    """``"x"`` ascending, ``"-x"`` descending, NULLs last in both."""
    return [F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last() for c in order]


def write_ordered(df: DataFrame, path: str, order: list[str], ranges: int | None = None) -> None:
    """Write ``df`` in the order of ``order`` as one Parquet file per range of rows."""
    if ranges is None:
        ranges = max(1, -(-df.count() // RANGE_ROWS))
    keys = sort_keys(order)
    df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """The rows with their place 1, 2, 3 ... in the written order."""
    rows = spark.read.parquet(path)
    columns = rows.columns
    placed = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    sizes = placed.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    number = F.regexp_extract("_file", "part-(\\d+)", 1).try_cast("bigint")
    before = F.sum("_n").over(Window.orderBy(number, "_file").rowsBetween(Window.unboundedPreceding, -1))           # one row a file
    starts = sizes.select(F.col("_file").alias("_name"), F.coalesce(before, F.lit(0)).alias("_before"))
    joined = placed.join(F.broadcast(starts), F.col("_file") == F.col("_name"))
    return joined.select(*columns, (F.col("_before") + F.col("_row") + 1).alias(position))
