"""Packing documents into sequences of a fixed length by cutting-stock column generation.

1. Tasks turn texts into token ids and cut them into pieces: full sequences
   and one last piece each (``token_pieces``).  Only lengths and checksums
   leave the tasks.
2. The histogram of piece lengths, at most ``capacity`` rows however many
   documents there are, goes to the driver; ``cutting_stock`` finds patterns
   of length classes and how often each is used.
3. Pieces are ranked within their class without gathering a class in one
   task; the plan (a few rows per class and pattern, broadcast) maps a range of
   ranks to a pattern's sequences.  Offsets are running sums inside each
   sequence, whose size is bounded by the capacity.

Defined cases: NULL and empty texts are the end id alone; repeated rows are
packed row by row; NULL doc_ids are kept; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lendlens.llm import cutting_stock
from lendlens.llm.common import materialize, slots
from lendlens.llm.token_pieces import pieces

CAPACITY = 4096


def plan_rows(histogram: dict[int, int], capacity: int) -> tuple[list[tuple], dict[int, int]]:
    """(rows (class, first rank, last rank + 1, items per sequence, first sequence), class of each length)."""
    sizes, index = cutting_stock.length_classes(histogram)
    demand = [0] * len(sizes)
    for length, n in histogram.items():
        demand[index[length]] += n
    rows, used, sequence = [], [0] * len(sizes), 0
    for times, content in cutting_stock.solve(sizes, demand, capacity):
        for c, items in content.items():
            rows.append((c, used[c], used[c] + times * items, items, sequence))
            used[c] += times * items
        sequence += times
    if used != demand:
        raise AssertionError("the plan does not hold every piece")
    return rows, index


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece."""
    spark = docs.sparkSession
    cut = materialize(pieces(docs, tokenizer_path, capacity), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows, index = plan_rows(histogram, capacity)
    # the class of a length: at most ``capacity`` pairs
    of = spark.createDataFrame(sorted(index.items()) or [(0, 0)], "length bigint, class int")
    classed = materialize(cut.join(F.broadcast(of), "length"), "pieces-classed")
    ranked = slots(classed, "class", ["doc_id", "start", "ids_crc32"])
    plan = spark.createDataFrame(rows or [(-1, 0, 0, 1, 0)], "class int, lo bigint, hi bigint, items bigint, base bigint")
    placed = (ranked.withColumnRenamed("slot", "rank").join(F.broadcast(plan), "class")
              .filter((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
              .withColumn("sequence_id", F.col("base") + F.floor((F.col("rank") - F.col("lo")) / F.col("items")).cast("long")))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "class", "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
