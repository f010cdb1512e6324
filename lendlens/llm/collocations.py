"""Phrase collocation mining by direct-address tiling.

Phrases of 2 to 5 words that occur at least ``least`` times, per language, with
the score 1000 * a * n / (l * r) of their worst cut.  A phrase can only be
frequent when its parts are, so counting goes level by level: frequent words
get ids by rank, and a block of texts becomes a sequence of ids (-1 for
rare words and at the ends of pieces).  Neighbouring ids are a pair; frequent pairs get
ids by rank in turn, and the sequence of pairs is the input of the next level,
where two neighbouring pairs are three words, and so on.

Counting a level.  The id square is cut in tiles of TILE x TILE pairs.  Ids go by
rank, so the pairs of frequent words lie in few tiles: a block counts those
with a dense ``bincount`` over the tile's cells, all other tiles as sorted coordinates (COO).  Every
distinct pair of a block is then sent once, with its count, to the bucket of its
tile and cell; a bucket adds up the sorted lists, ranks its frequent pairs and
answers each block with their ids.  Rank r of bucket b has the id
r * buckets + b: small ids are frequent ones all over, without a global sort.
Words are counted the same way by their bytes and language, never by a hash.

Memory and skew: a block holds BLOCK_TOKENS words, a bucket about
BUCKET_ENTRIES distinct entries (their number follows the data); a hot pair
is one entry a block.  Texts are cut into blocks at ends of pieces, so a
giant text is many blocks.  The driver sees sizes only.  Levels are stored.

Phrase rows carry the counts of all their beginnings and ends, taken over from
the phrases of one word less that they were paired from, so cuts need no search.
A phrase inside a longer one of the same count has a phrase of one word more around it
with that count, so only the next level is looked at to drop it.
The first ``top`` of a language are taken within hashed parts of its
phrases first, in rounds, so no task orders more than ``part`` of them.

Defined cases: NULL and empty texts have no words; NULL language is ``und``
(together with a language of that name); repeated rows count each; ties of
the score go by a, then by the phrase's bytes; an empty table gives an
empty result; extra columns are ignored; missing ones are NULL.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lendlens.llm import bytetext as B
from lendlens.llm.common import column, materialize, small_enough
from lendlens.llm.katz import pack, unpack

MOST_WORDS = 5
TILE = 1024
DENSE = TILE * TILE // 32                  # pairs of a block in a tile from which it is counted densely
BLOCK_TOKENS = 1 << 20
BUCKET_ENTRIES = 2_000_000
SLICE = 1 << 22
U64 = np.uint64
ENDS = np.zeros(256, bool)                 # bytes that end a piece
ENDS[[ord(c) for c in ".,;:!?"]] = True
ENDS[0x0A:0x0E] = True
WORD = ~ENDS                               # bytes of words
WORD[[0x20, 0x09]] = False

BLOCKS = "block string, pairs bigint, seq binary, lengths binary, words binary, counts binary, totals array<struct<lang:string,n:bigint>>"
COUNTED = "block string, answer binary, id bigint, a bigint, left bigint, right bigint, lang binary, word binary"


def packed(binary: pa.Array) -> tuple[bytes, bytes]:
    """(lengths, bytes) of a large_binary array."""
    offsets = np.frombuffer(binary.buffers()[1], np.int64)[binary.offset:binary.offset + len(binary) + 1]
    raw = np.frombuffer(binary.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if len(binary) else np.zeros(0, np.uint8)
    return pack(np.diff(offsets).astype(np.int32)), pack(raw)


def binaries(lengths: np.ndarray, raw: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))])


def slices(data: np.ndarray):
    """Ranges of about SLICE bytes that end behind a piece (or with the data)."""
    at, n = 0, len(data)
    while at < n:
        end = min(at + SLICE, n)
        while end < n:
            window = ENDS[data[at:end]]
            if window.any():
                end -= int(np.argmax(window[::-1]))
                break
            end = min(end + SLICE, n)
        yield at, end
        at = end


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, bytes one after the other, is first of its piece) of the words of some bytes."""
    flags = WORD[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    starts, stops = edges[::2], edges[1::2]
    piece = np.cumsum(ENDS[data])[starts]
    return starts, stops - starts, data[flags], np.r_[True, piece[1:] != piece[:-1]][:len(starts)]


def word_blocks(docs: DataFrame) -> DataFrame:
    """Blocks: the local vocabulary (word, space, language) with counts, and the sequence of its positions."""
    def build(batches):
        part, number, held, waiting = TaskContext.get().partitionId(), 0, [], 0
        langs: dict[str, int] = {}

        def flush():
            nonlocal number
            names = pa.array([x.encode() for x in langs], pa.large_binary())
            lengths, raw, lang, first = (np.concatenate(x) for x in zip(*held))
            coded = binaries(lengths, raw).dictionary_encode()
            both, local, counts = np.unique(coded.indices.to_numpy().astype(np.int64) * len(names) + lang, return_inverse=True, return_counts=True)
            keys = pc.binary_join_element_wise(coded.dictionary.take(pa.array(both // len(names))), names.take(pa.array(both % len(names))), pa.scalar(b" ", pa.large_binary()))
            seq = np.full(len(local) + int(first.sum()), -1, np.int32)
            seq[np.arange(len(local)) + np.cumsum(first)] = local
            totals = np.bincount(both % len(names), weights=counts, minlength=len(names)).astype(np.int64)
            block, number = f"{part}-{number}", number + 1
            return pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([len(both)], pa.int64()), pa.array([pack(seq)], pa.binary()), *[pa.array([x], pa.binary()) for x in packed(keys)],
                 pa.array([pack(counts.astype(np.int64))], pa.binary()),
                 pa.array([[{"lang": x, "n": int(n)} for x, n in zip(langs, totals) if n]], pa.list_(pa.struct([("lang", pa.string()), ("n", pa.int64())])))],
                names=["block", "pairs", "seq", "lengths", "words", "counts", "totals"])

        for batch in batches:
            data, offsets = B.texts_of(batch.column(1))
            of = np.array([langs.setdefault(x, len(langs)) for x in batch.column(0).to_pylist()], np.int32)
            for lo, hi in B.split_rows(offsets, 2 * SLICE):
                cuts = offsets[lo:hi + 1] - offsets[lo]
                joined = np.insert(B.FOLD[data[offsets[lo]:offsets[hi]]], cuts[1:-1], 0x0A)       # a text ends a piece
                begins = cuts[:-1] + np.arange(hi - lo)
                for a, z in slices(joined):
                    starts, lengths, raw, first = words_of(joined[a:z])
                    if len(starts):
                        row = np.searchsorted(begins, starts + a, "right") - 1
                        held.append((lengths, raw, of[lo:hi][row], first))
                        waiting += len(starts)
                    if waiting >= BLOCK_TOKENS:
                        yield flush()
                        held, waiting = [], 0
        if held:
            yield flush()

    rows = docs.select(F.coalesce(column(docs, "lang", "string"), F.lit("und")).alias("lang"), column(docs, "text", "string").alias("text"))
    return rows.mapInArrow(build, BLOCKS)


def dealt(df: DataFrame, key: str, groups: int) -> DataFrame:
    """``df`` dealt by ``key`` over enough partitions for its number of groups: a task's share does not grow with the input."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-groups // 4)), key)


def groups(to: np.ndarray):
    """(bucket, ascending positions) for each bucket met."""
    order = np.argsort(to, kind="stable")
    used, begin = np.unique(to[order], return_index=True)
    return list(zip(used.tolist(), np.split(order, begin[1:])))


def answers(pdf: pd.DataFrame, codes: np.ndarray, ids: np.ndarray) -> list[tuple]:
    """For every block of a bucket: places and ids of its frequent entries.  ``codes``: all entries in order of the rows."""
    rows, at = [], 0
    for block, places in zip(pdf["block"], pdf["places"]):
        places = unpack(places, np.int32)
        got = ids[codes[at:at + len(places)]]
        at += len(places)
        if (got >= 0).any():
            front = pack(places[got >= 0])
            rows.append((block, len(front).to_bytes(8, "little") + front + pack(got[got >= 0]), *[None] * 6))
    return rows


def ranked(totals: np.ndarray, least: int, bucket: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(entries by falling count, id of every entry or -1): ids interleave the buckets' ranks."""
    frequent = np.flatnonzero(totals >= least)
    frequent = frequent[np.argsort(-totals[frequent], kind="stable")]
    ids = np.full(len(totals), -1, np.int64)
    ids[frequent] = np.arange(len(frequent), dtype=np.int64) * buckets + bucket
    return frequent, ids


def count_words(blocks: DataFrame, least: int, buckets: int) -> DataFrame:
    """Answers to blocks (block, answer) and the frequent words (id, a, lang, word)."""
    def ask(pdfs):
        for pdf in pdfs:
            for r in pdf.itertuples():
                keys, counts = binaries(unpack(r.lengths, np.int32), unpack(r.words, np.uint8)), unpack(r.counts, np.int64)
                to = pd.util.hash_array(np.array(keys.to_pylist(), object), categorize=False) % U64(buckets)
                yield pd.DataFrame([(int(u), r.block, pack(g.astype(np.int32)), *packed(keys.take(pa.array(g))), pack(counts[g])) for u, g in groups(to)],
                                   columns=["bucket", "block", "places", "lengths", "words", "counts"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        coded = pa.chunked_array([binaries(unpack(n, np.int32), unpack(w, np.uint8)) for n, w in zip(pdf["lengths"], pdf["words"])]).combine_chunks().dictionary_encode()
        codes = coded.indices.to_numpy()
        totals = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(totals, codes, np.concatenate([unpack(c, np.int64) for c in pdf["counts"]]))
        frequent, ids = ranked(totals, least, int(pdf["bucket"].iloc[0]), buckets)
        rows = answers(pdf, codes, ids)
        for k in frequent.tolist():
            word, lang = coded.dictionary[k].as_py().split(b" ", 1)
            rows.append((None, None, int(ids[k]), int(totals[k]), None, None, lang, word))
        return pd.DataFrame(rows, columns=["block", "answer", "id", "a", "left", "right", "lang", "word"]).astype(
            {c: "Int64" for c in ("id", "a", "left", "right")})

    asked = blocks.select("block", "lengths", "words", "counts").mapInPandas(ask, "bucket int, block string, places binary, lengths binary, words binary, counts binary")
    return dealt(asked, "bucket", buckets).groupBy("bucket").applyInPandas(answer, COUNTED)


def local_pairs(seq: np.ndarray, tiles: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(tile, cell, count) of the distinct neighbours in a sequence, and (places of all pairs, which distinct pair each is)."""
    a, b = seq[:-1], seq[1:]
    at = np.flatnonzero((a >= 0) & (b >= 0))
    a, b = a[at], b[at]
    used, which, size = np.unique((a // TILE) * tiles + b // TILE, return_inverse=True, return_counts=True)
    cell = (a % TILE) * TILE + b % TILE
    out, back, n = [], np.zeros(len(at), np.int64), 0
    for t in np.flatnonzero(size >= DENSE).tolist():                 # dense tiles
        mine = np.flatnonzero(which == t)
        counts = np.bincount(cell[mine], minlength=TILE * TILE)
        live = np.flatnonzero(counts)
        number = np.cumsum(counts > 0) - 1 + n
        back[mine] = number[cell[mine]]
        out.append((np.full(len(live), used[t]), live, counts[live]))
        n += len(live)
    rest = np.flatnonzero(size[which] < DENSE)                       # all others as sorted coordinates
    code, inverse, counts = np.unique(which[rest].astype(np.int64) * TILE * TILE + cell[rest], return_inverse=True, return_counts=True)
    back[rest] = inverse + n
    out.append((used[code // (TILE * TILE)], code % (TILE * TILE), counts))
    tile, cells, counts = (np.concatenate(x) for x in zip(*out))
    return tile.astype(np.int64), cells.astype(np.int32), counts.astype(np.int64), at, back


def count_pairs(level: DataFrame, least: int, buckets: int, tiles: int) -> DataFrame:
    """As ``count_words`` for the pairs of neighbours of a level's sequences: frequent ones as (id, a, left, right)."""
    def ask(pdfs):
        for pdf in pdfs:
            for block, seq in zip(pdf["block"], pdf["seq"]):
                tile, cell, counts, _, _ = local_pairs(unpack(seq, np.int64), tiles)
                to = B.mix(tile.astype(U64) * U64(0x9E3779B97F4A7C15) + cell.astype(U64)) % U64(buckets)
                rows = [(int(u), block, pack(g.astype(np.int32)), pack(tile[g]), pack(cell[g]), pack(counts[g])) for u, g in groups(to)]
                yield pd.DataFrame(rows, columns=["bucket", "block", "places", "tiles", "cells", "counts"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        tile = np.concatenate([unpack(t, np.int64) for t in pdf["tiles"]])
        used, which = np.unique(tile, return_inverse=True)
        cell = np.concatenate([unpack(c, np.int32) for c in pdf["cells"]])
        code, codes = np.unique(which * np.int64(TILE * TILE) + cell, return_inverse=True)
        totals = np.zeros(len(code), np.int64)
        np.add.at(totals, codes, np.concatenate([unpack(c, np.int64) for c in pdf["counts"]]))
        frequent, ids = ranked(totals, least, int(pdf["bucket"].iloc[0]), buckets)
        t, c = used[code[frequent] // (TILE * TILE)], code[frequent] % (TILE * TILE)
        told = pd.DataFrame({"block": None, "answer": None, "id": ids[frequent], "a": totals[frequent], "left": (t // tiles) * TILE + c // TILE,
                             "right": (t % tiles) * TILE + c % TILE, "lang": None, "word": None})
        asked = pd.DataFrame(answers(pdf, codes, ids), columns=told.columns)
        kinds = {k: "Int64" for k in ("id", "a", "left", "right")}
        return pd.concat([asked.astype(kinds), told.astype(kinds)])

    asked = level.select("block", "seq").mapInPandas(ask, "bucket int, block string, places binary, tiles binary, cells binary, counts binary")
    return dealt(asked, "bucket", buckets).groupBy("bucket").applyInPandas(answer, COUNTED)


def next_level(blocks: DataFrame, counted: DataFrame, tiles: int | None) -> DataFrame:
    """(block, pairs, seq): every block's sequence of the ids it was answered; ``tiles`` None: the blocks are of words."""
    def apply(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"block": pd.Series(dtype=str), "pairs": pd.Series(dtype="int64"), "seq": pd.Series(dtype=object)})
        if not len(left) or not len(right):
            return none
        held = unpack(left["seq"].iloc[0], np.int32 if tiles is None else np.int64)
        if tiles is None:
            size, at, back = int(left["pairs"].iloc[0]), np.flatnonzero(held >= 0), held[held >= 0]
        else:
            _, cells, _, at, back = local_pairs(held, tiles)
            size = len(cells)
        ids = np.full(size, -1, np.int64)
        for blob in right["answer"]:
            n = int.from_bytes(blob[:8], "little")
            ids[unpack(blob[8:8 + n], np.int32)] = unpack(blob[8 + n:], np.int64)
        seq = np.full(len(held), -1, np.int64)
        seq[at] = ids[back]
        seq = seq[(seq >= 0) | np.r_[False, seq[:-1] >= 0]]          # one -1 between runs is enough
        pairs = int(((seq[:-1] >= 0) & (seq[1:] >= 0)).sum())
        return pd.DataFrame({"block": [left["block"].iloc[0]], "pairs": [pairs], "seq": [pack(seq)]}) if pairs else none

    held = blocks.select("block", "pairs", "seq")
    n = held.count()
    told = dealt(counted.filter("block IS NOT NULL").select("block", "answer"), "block", n)
    return dealt(held, "block", n).groupBy("block").cogroup(told.groupBy("block")).applyInPandas(apply, "block string, pairs bigint, seq binary")


def phrase_levels(docs: DataFrame, least: int, most_words: int = MOST_WORDS) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n) and per number of words the frequent phrases: id, lang, phrase, last, a, heads, tails (counts of beginnings and ends), left, right."""
    blocks = materialize(word_blocks(docs), "phrase-blocks")
    words = blocks.select(F.explode("totals").alias("t")).groupBy("t.lang").agg(F.sum("t.n").alias("n"))
    buckets = lambda df: max(16, -(-(df.agg(F.sum("pairs")).first()[0] or 0) // BUCKET_ENTRIES))
    counted = materialize(count_words(blocks, least, buckets(blocks)), "phrase-words")
    text = F.col("word").cast("string")
    levels = [counted.filter("id IS NOT NULL").select("id", F.col("lang").cast("string").alias("lang"), text.alias("phrase"), text.alias("last"), "a",
                                                      F.array("a").alias("heads"), F.array("a").alias("tails"), "left", "right")]
    sequence = materialize(next_level(blocks, counted, None), "phrase-level")
    for size in range(2, most_words + 1):
        if sequence.isEmpty():
            break
        tiles = (levels[-1].agg(F.max("id")).first()[0] or 0) // TILE + 1
        counted = materialize(count_pairs(sequence, least, buckets(sequence), tiles), "phrase-pairs")
        shorter = levels[-1]
        begins = small_enough(shorter.select(F.col("id").alias("_l"), "lang", F.col("phrase").alias("head"), "heads"), 200_000)
        ends = small_enough(shorter.select(F.col("id").alias("_r"), "last", "tails"), 200_000)
        found = counted.filter("id IS NOT NULL").select("id", "a", "left", "right")
        found = found.join(begins, F.col("left") == F.col("_l")).join(ends, F.col("right") == F.col("_r"))
        levels.append(materialize(found.select(
            "id", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last", "a", F.concat("heads", F.array("a")).alias("heads"),
            F.concat("tails", F.array("a")).alias("tails"), "left", "right"), "phrases"))
        if size < most_words:
            sequence = materialize(next_level(sequence, counted, tiles), "phrase-level")
    return words, levels


SCORED = """array_min(transform(sequence(1, size(heads) - 1), k -> named_struct(
  'score', (cast(a * 1000 AS decimal(19, 0)) * cast(n AS decimal(18, 0)))
           div (cast(heads[k - 1] AS decimal(18, 0)) * cast(tails[size(tails) - k - 1] AS decimal(18, 0))),
  'cut', k, 'l', heads[k - 1], 'r', tails[size(tails) - k - 1])))"""


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, most_words: int = MOST_WORDS, part: int = 100_000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language."""
    words, levels = phrase_levels(docs, least, most_words)
    kept = levels[0].filter("false")
    for level, longer in zip(levels[1:], [*levels[2:], None]):
        if longer is not None:
            around = longer.select(F.explode(F.array("left", "right")).alias("_in"), F.col("a").alias("_a")).groupBy("_in").agg(F.max("_a").alias("_a"))
            level = level.join(small_enough(around, 200_000), F.col("id") == F.col("_in"), "left").filter("_a IS NULL OR _a < a").drop("_in", "_a")
        kept = kept.unionByName(level)
    totals = small_enough(materialize(words, "phrase-totals"), 10_000).withColumnRenamed("lang", "_lang")
    scored = kept.join(totals, F.col("lang") == F.col("_lang")).withColumn("best", F.expr(SCORED))
    scored = materialize(scored.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score"), "phrase-scores")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    most = lambda df: df.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    held, rounds = most(scored), 0
    while held > part:                     # the first of each part of a language, until the rest of a language is one part
        parts, rounds = -(-held // part), rounds + 1
        place = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
        scored = scored.withColumn("part", F.pmod(F.xxhash64("phrase", F.lit(rounds)), F.lit(parts))).withColumn("place", place)
        scored = materialize(scored.filter(F.col("place") <= top).drop("part", "place"), "phrase-first")
        held, before = most(scored), held
        if held == before:                 # parts smaller than the top: one more could not shorten it
            break
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return scored.withColumn("rank", rank).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
