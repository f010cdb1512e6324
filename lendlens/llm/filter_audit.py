"""Filter interaction audit: what each of five text filters removes, in every order they can be applied.

A row gets one bit for each failure condition:
  A  fewer than 200 words,                B  100 * distinct words < 50 * words,
  C  100 * [A-Z] > 2 * code points,       D  holds any of # $ % & * |,
  E  its text is also that of a row with a smaller doc_id, table-wide.
Counts of rows by (part, five bits) are all that the audit of an order needs:
what is kept after the filters S is the sum over the masks that avoid S.  A part has
at most 32 such counts, from which its 600 rows follow.

E by a counting-Bloom prepass.  Every task counts the 4 cells of its texts'
hashes in sketches (sorted cells with counters that stop at 2, cut in
segments); sketches of a segment are added up and kept as one bit a cell, "hit
twice or more".  The bits are broadcast: 8 cells a row, at most ``max_cells``
(64 MB).  A text with a cell of count one is unique and cleared; beyond the
bound fewer are cleared and nothing else changes.  Only texts of possible
repeats are shuffled, to group equal full texts and take the smallest doc_id.
Repeated texts meet the narrow rows again by two 64-bit hashes of the text;
hashes shared by different texts are settled by the texts themselves.

Skew: equal texts combine before the shuffle; repeated texts are broadcast
when few (checked), else the frequent ones are and the rest is joined;
labels meet rows already counted by (doc_id, part, mask).

Defined cases: NULL text is empty; NULL source is the part ''; a row with NULL
doc_id counts as larger than any number, so it fails E when its text has an
id, and never otherwise; rows equal in doc_id and text do not fail E by
each other; repeated label rows of a doc_id count once, as 1 if any row says 1; rows
without a label are neither good nor toxic; an empty table has no parts and
gives no rows; extra columns are ignored; missing ones are NULL.
"""

from __future__ import annotations

import itertools
from math import factorial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.llm import bytetext as B
from lendlens.llm.common import column, materialize, pinned, small_enough
from lendlens.llm.katz import pack, unpack

FILTERS = "ABCDE"
SPACES = "[\\x20\\x09-\\x0D]+"
HASHES, CELLS_A_ROW = 4, 8
SEGMENT = 1 << 20                     # cells of a segment
MAX_CELLS = 1 << 29                   # 64 MB of bits
WAITING = 1 << 20                     # hashes counted together in a task
FREQUENT = 50_000                     # rows of a text from which it is told apart
U64 = np.uint64


def text_mask(text: Column, words: Column) -> Column:
    """Bits A to D of a text (not NULL) and its words."""
    n, fails = F.size(words), []
    fails.append(n < 200)
    fails.append(F.size(F.array_distinct(words)).cast("long") * 100 < n.cast("long") * 50)
    fails.append(F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") * 100 > F.length(text).cast("long") * 2)
    fails.append(text.rlike("[#$%&*|]"))
    bits = [F.when(fail, F.lit(1 << k)).otherwise(F.lit(0)) for k, fail in enumerate(fails)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def text_keys(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h"), F.xxhash64(text, F.lit(1)).alias("h2")]


def flagged_rows(docs: DataFrame) -> DataFrame:
    """doc_id, part, h, h2, mask (bits A to D) of every row."""
    text = F.coalesce(column(docs, "text", "string"), F.lit(""))
    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), F.coalesce(column(docs, "source", "string"), F.lit("")).alias("part"),
                       text.alias("text"))
    rows = pinned(rows, words=F.array_remove(F.split("text", SPACES), ""))
    return rows.select("doc_id", "part", *text_keys(F.col("text")), text_mask(F.col("text"), F.col("words")).alias("mask"))


def cells_of(hashes: np.ndarray, cells: int) -> list[np.ndarray]:
    return [(B.mix(hashes + U64(j * 0x9E3779B97F4A7C15 % 2 ** 64)) % U64(cells)).astype(np.int64) for j in range(HASHES)]


def sketches(rows: DataFrame, cells: int) -> DataFrame:
    """(segment, cells, counts): the counters a task's rows touched, at most 2 each."""
    def build(batches):
        held, waiting = [], 0

        def flush():
            at, n = np.unique(np.concatenate(cells_of(np.concatenate(held).view(U64), cells)), return_counts=True)
            n = np.minimum(n, 2).astype(np.uint8)
            segment = at // SEGMENT
            first = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
            parts = list(zip(first, np.r_[first[1:], len(at)]))
            return pa.RecordBatch.from_arrays(
                [pa.array(segment[first].astype(np.int32)), pa.array([pack((at[a:b] % SEGMENT).astype(np.uint32)) for a, b in parts], pa.binary()),
                 pa.array([pack(n[a:b]) for a, b in parts], pa.binary())], names=["segment", "cells", "counts"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch.column(0).to_numpy())
                waiting += batch.num_rows
            if waiting >= WAITING:
                yield flush()
                held, waiting = [], 0
        if held:
            yield flush()

    return rows.select("h").mapInArrow(build, "segment int, cells binary, counts binary")


def merged(parts: DataFrame) -> DataFrame:
    """(segment, bits): one bit a cell, set when its merged counter is 2 or more."""
    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        counters = np.zeros(SEGMENT, np.uint8)
        for cells, counts in zip(pdf["cells"], pdf["counts"]):
            at = unpack(cells, np.uint32)
            counters[at] = np.minimum(counters[at] + unpack(counts, np.uint8), 2)
        return pd.DataFrame({"segment": [pdf["segment"].iloc[0]], "bits": [np.packbits(counters >= 2).tobytes()]})

    return parts.groupBy("segment").applyInPandas(add, "segment int, bits binary")


def possible_repeats(rows: DataFrame, max_cells: int = MAX_CELLS):
    """Column function of ``h``: False only for hashes that occur once in ``rows``."""
    segments = max(1, min(max_cells, CELLS_A_ROW * rows.count()) // SEGMENT + 1)
    cells = segments * SEGMENT
    bits = np.zeros(cells // 8, np.uint8)
    for r in materialize(merged(sketches(rows, cells)), "audit-sketch").toLocalIterator():
        at = r["segment"] * (SEGMENT // 8)
        bits[at:at + SEGMENT // 8] = np.frombuffer(r["bits"], np.uint8)
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def twice(h: pa.Array) -> pa.Array:
        hashes, seen = h.to_numpy(zero_copy_only=False).view(U64), np.ones(len(h), bool)
        for at in cells_of(hashes, cells):
            seen &= (shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
        return pa.array(seen)

    return F.arrow_udf(twice, "boolean")


def repeated_texts(docs: DataFrame, rows: DataFrame, max_cells: int = MAX_CELLS) -> tuple[DataFrame, DataFrame]:
    """(h, h2, first, n) of texts that occur more than once, and the (h, h2, text, first) of hashes shared by different texts."""
    possible = possible_repeats(rows, max_cells)
    text = F.coalesce(column(docs, "text", "string"), F.lit(""))
    texts = docs.select(column(docs, "doc_id", "long").alias("doc_id"), text.alias("text")).select("*", *text_keys(F.col("text")))
    equal = texts.filter(possible("h")).groupBy("text").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    keyed = equal.select(*text_keys(F.col("text")), "first", "n")
    by_hash = materialize(keyed.groupBy("h", "h2").agg(F.count(F.lit(1)).alias("texts"), F.min("first").alias("first"), F.max("n").alias("n")), "audit-texts")
    shared = by_hash.filter("texts > 1").select(F.col("h").alias("_h"), F.col("h2").alias("_h2"))
    clashes = equal.select("text", "first").limit(0).select(F.lit(0).cast("long").alias("h"), F.lit(0).cast("long").alias("h2"), "text", "first")
    if not shared.isEmpty():
        some = texts.join(small_enough(shared, 100_000), (F.col("h") == F.col("_h")) & (F.col("h2") == F.col("_h2")), "left_semi")
        clashes = materialize(some.groupBy("h", "h2", "text").agg(F.min("doc_id").alias("first")), "audit-clashes")
    return by_hash.filter("texts = 1 AND n > 1").select("h", "h2", "first", "n"), clashes


def _later(first: str) -> Column:
    """Condition E against the smallest doc_id ``first`` of the row's text."""
    return F.coalesce(F.col("doc_id") > F.col(first), F.col("doc_id").isNull() & F.col(first).isNotNull(), F.lit(False))


def with_repeats(docs: DataFrame, rows: DataFrame, repeats: DataFrame, clashes: DataFrame, frequent: int = FREQUENT, most: int = 500_000) -> DataFrame:
    """doc_id, part, mask (bits A to E)."""
    on = (F.col("h") == F.col("_h")) & (F.col("h2") == F.col("_h2"))
    keys = [F.col("h").alias("_h"), F.col("h2").alias("_h2")]
    if not clashes.isEmpty():           # rows of these hashes take the path over the texts
        text = F.coalesce(column(docs, "text", "string"), F.lit(""))
        few = small_enough(clashes.select(*keys).distinct(), 100_000)
        told = docs.select(text.alias("text"), column(docs, "doc_id", "long").alias("doc_id"),
                           F.coalesce(column(docs, "source", "string"), F.lit("")).alias("part")).select("*", *text_keys(F.col("text"))).join(few, on, "left_semi")
        told = pinned(told, words=F.array_remove(F.split("text", SPACES), "")).join(
            small_enough(clashes.select(F.col("text").alias("_text"), "first"), 100_000), F.col("text") == F.col("_text"))
        told = told.select("doc_id", "part", (text_mask(F.col("text"), F.col("words")) + _later("first").cast("int") * 16).alias("mask"))
        rows = rows.join(few, on, "left_anti")
    small = repeats.select(*keys, "first", "n")
    if small.limit(most + 1).count() <= most:
        joined = rows.join(F.broadcast(small), on, "left")
    else:
        hot = F.broadcast(materialize(small.filter(F.col("n") >= frequent), "audit-frequent"))     # at most rows / frequent
        joined = rows.join(hot, on).unionByName(rows.join(hot, on, "left_anti").join(small.filter(F.col("n") < frequent), on, "left"))
    out = joined.select("doc_id", "part", (F.col("mask") + _later("first").cast("int") * 16).alias("mask"))
    return out if clashes.isEmpty() else out.unionByName(told)


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): additive counts."""
    says = lambda name: F.max(F.when(column(labels, name, "long") == 1, 1).otherwise(0)).alias(name)
    told = labels.groupBy(column(labels, "doc_id", "long").alias("_id")).agg(says("quality"), says("toxic"))
    counted = rows.groupBy("doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    joined = counted.join(told, F.col("doc_id") == F.col("_id"), "left")
    total = lambda c: F.sum(F.when(F.col(c) == 1, F.col("n")).otherwise(0))
    return joined.groupBy("part", "mask").agg(F.sum("n").alias("n"), total("quality").alias("good"), total("toxic").alias("toxic"))


def every_order(counts: DataFrame) -> DataFrame:
    """The audit rows of each part from its mask counts: 120 orders of 5 steps."""
    parts = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("held"))
    everything = (1 << len(FILTERS)) - 1

    def kept(c: str) -> Column:
        """Rows kept after every set of filters."""
        return F.transform(F.sequence(F.lit(0), F.lit(everything)), lambda s: F.aggregate(
            F.filter("held", lambda x: x["mask"].bitwiseAND(s) == 0), F.lit(0).cast("long"), lambda a, x: a + x[c]))

    parts = pinned(parts, **{f"kept_{c}": kept(c) for c in ("n", "good", "toxic")})
    n = lambda s: F.get("kept_n", s)
    shares = []
    for k in range(len(FILTERS)):
        before = [s for s in range(everything + 1) if not s >> k & 1]
        times = [factorial(s.bit_count()) * factorial(len(FILTERS) - 1 - s.bit_count()) for s in before]
        shares.append(sum(((n(F.lit(s)) - n(F.lit(s | 1 << k))) * t for s, t in zip(before, times)), F.lit(0).cast("long")))
    parts = pinned(parts, shares=F.array(*shares))
    steps = []
    for order in itertools.permutations(range(len(FILTERS))):
        name, done = "".join(FILTERS[k] for k in order), 0
        for step, k in enumerate(order, 1):
            steps.append((name, step, k, 1 << k, done, done | 1 << k))
            done |= 1 << k
    kinds = "array<struct<filter_order:string,step:int,at:int,bit:int,before:int,after:int>>"
    table = F.from_json(F.lit(str([dict(zip(("filter_order", "step", "at", "bit", "before", "after"), s)) for s in steps]).replace("'", '"')), kinds)
    rows = parts.select("*", F.explode(table).alias("s"))
    bit = F.col("s.bit")
    lost = lambda c: F.get(c, F.col("s.before")) - F.get(c, F.col("s.after"))
    return rows.select(
        "part", "s.filter_order", "s.step", n(F.col("s.after")).alias("kept"), lost("kept_n").alias("removed"),
        (n(F.lit(0)) - n(bit) - lost("kept_n")).alias("redundant"), (n(F.lit(everything) - bit) - n(F.lit(everything))).alias("unique_fails"),
        lost("kept_good").alias("good_lost"), lost("kept_toxic").alias("toxic_lost"), F.get("shares", F.col("s.at")).alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    rows = materialize(flagged_rows(docs), "audit-rows")
    repeats, clashes = repeated_texts(docs, rows, max_cells)
    counts = mask_counts(with_repeats(docs, rows, repeats, clashes), labels)
    return every_order(materialize(counts, "audit-counts"))
