"""Sharding with jump consistent hashing (DataFrame functions only).

A key starts in bucket 0 and jumps ahead: from bucket b the next bucket is
floor((b + 1) / u) for a uniform draw u in (0, 1] that only the key and the
number of the jump decide; the last bucket below the shard count is the
shard.  Growing from n to n + 1 shards changes a row's shard only if its next
jump lands exactly on n, so 1 / (n + 1) of the rows move, all into the new shard.
No ring table exists, and two runs or two clusters agree without talking.

The draws are the first 13 hex digits (52 bits) of md5("id:jump"), which
every SQL engine has, in place of a 64-bit linear congruential generator.

Law: ``key``.  Slots number the rows of a shard from 0 without gathering a
shard in one task.

Defined cases: NULL doc_id is the key "" (such rows share a shard); NULL text
has no bytes (size 8, crc32 0); repeated rows share a shard and get separate
slots; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.llm.common import column, materialize, slots

DRAWS = float(2 ** 52)


def _draw(key: Column, jump: Column) -> Column:
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(":"), jump.cast("string")).cast("binary")), 1, 13), 16, 10)
    return (bits.cast("double") + 1.0) / DRAWS


def jump_path(key: Column, shards: int) -> Column:
    """Struct (at, next): the bucket below ``shards`` the key ends in, and the bucket it would jump to from there."""
    start = F.struct(F.lit(0).cast("double").alias("at"), F.floor(1.0 / _draw(key, F.lit(0))).cast("double").alias("next"))

    def step(state: Column, i: Column) -> Column:
        onward = F.struct(state["next"].alias("at"), F.floor((state["next"] + 1.0) / _draw(key, i)).cast("double").alias("next"))
        return F.when(state["next"] < shards, onward).otherwise(state)

    # a key jumps at most shards - 1 times
    return F.aggregate(F.sequence(F.lit(1), F.lit(max(shards - 1, 1))), start, step)


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard: one row per input row."""
    text = column(docs, "text", "string")
    doc_id = column(docs, "doc_id", "long")
    key = F.coalesce(doc_id.cast("string"), F.lit(""))
    rows = docs.select(
        doc_id.alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), key.alias("_key"))
    rows = rows.withColumn("_path", jump_path(F.col("_key"), shards))
    rows = rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("_path.at").cast("int").alias("shard"),
                       F.when(F.col("_path.next") == shards, F.lit(shards)).otherwise(F.col("_path.at")).cast("int").alias("grown_shard"))
    stored = materialize(rows, "shards")
    return slots(stored, "shard", ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int = 24) -> None:
    """Write ``docs`` as one folder per shard (``shard=0`` ...), routed by the same jump path."""
    key = F.coalesce(column(docs, "doc_id", "long").cast("string"), F.lit(""))
    at = jump_path(key, shards)["at"].cast("int")
    docs.withColumn("shard", at).write.partitionBy("shard").mode("errorifexists").parquet(path)
