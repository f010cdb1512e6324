"""Session construction and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # HotSpot does not JIT methods over 8000 bytes of bytecode; wider fused
    # stages (staging types 29 columns) run faster split per expression.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "lendlens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE, ANSI mode and a UTC clock."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def split_methods(spark: SparkSession):
    """Stages whose fused method HotSpot would not compile run split per expression inside the block, in any session."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, DEFAULT_CONF[key])
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Queries run inside the block remove their shuffle files at their end, not when the driver next collects garbage.

    For jobs of many steps whose DataFrames are each run once.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``.  Only when it is unset and
    the master is local (tests, laptops) is a private folder created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
        conf = tempfile.mkdtemp(prefix="lendlens-ckpt-")
        # a private folder of this process (local master only): removed at exit
        atexit.register(shutil.rmtree, conf, True)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir()


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder on whatever file system its path names; False when there was none."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True))


# folders written by ``materialize`` inside open ``scratch`` blocks, innermost last
_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Intermediate tables written inside the block are removed at its end, also after a failure.

    For jobs that write their results: a DataFrame that still reads an
    intermediate table must be written before the block ends.
    """
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            remove_folder(spark, path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Cuts lineage (a lost executor re-reads files instead of recomputing the
    upstream joins) and keeps column pruning / filter pushdown for readers.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), "tables", f"{name}-{uuid.uuid4().hex[:12]}")
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def remove_stored(df: DataFrame) -> None:
    """Delete the table of a DataFrame that ``materialize`` returned and that nothing reads any more."""
    for folder in {os.path.dirname(file) for file in df.inputFiles()}:
        remove_folder(df.sparkSession, folder)
