"""Landing of the raw loan file: every column as text, nothing inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_raw_csv(spark: SparkSession, path: str, min_partitions: int | None = None, multi_line: bool = True) -> DataFrame:
    """Read a (possibly gzipped) CSV with header, all columns ``string``.

    Empty fields (quoted or not) become NULL.  Quoted fields may hold line
    breaks; ``multi_line=False`` lets Spark split large uncompressed files
    that are known to hold none.  A ``.gz`` file is a single
    split, so pass ``min_partitions`` to spread the typed work, or better
    land the file once with :func:`land_raw` and read the Parquet copy.
    """
    df = (spark.read.option("header", True).option("inferSchema", False)
          .option("multiLine", multi_line).option("escape", '"').csv(path))
    if min_partitions:
        df = df.repartition(min_partitions)
    return df


def land_raw(df: DataFrame, path: str, files: int | None = None) -> None:
    """Write the raw text table once as Parquet so later scans split and prune."""
    (df.repartition(files) if files else df).write.mode("overwrite").parquet(path)
