"""N-gram Jaccard self-join with set-relation skipping, with link counts and link components.

A document's set is its distinct word shingles (64-bit hashes).  Two sets
link when 100 * |A & B| >= percent * |A | B|.

1. Documents with equal sets collapse to one set id (128-bit digest folded to
   64 bits), so copies never meet as pairs.
2. Every set lists its shingles in one global order and puts its prefix
   (n - ceil(t * n) + 1 shingles) into an inverted index; linked sets share a
   prefix shingle.  The order is "weight, then hash".  The weight of a shingle
   is its count over all documents, as far as it repeats among a few thousand
   neighbours, for the ``heavy`` most frequent shingles, else 0.  Any order gives the same links; this one
   keeps boilerplate out of prefixes, and its table has a fixed bound.
3. Index lists are sorted by set size; for a set only the block of lengths
   that can still link is visited, and the positions left after the shared
   one must suffice (length and position skipping).  Entries that survive
   meet again with a parity bitmap of their set, whose differing bits bound
   the overlap from above.  What survives is joined into *families* by a
   forest of at most one edge per entry and task, never by all pairs.  Lists
   longer than ``DENSE_LIST`` are chained through neighbours in length, which
   can only make a family larger; a list longer than ``hot_entries`` is dealt
   to several tasks, each sends on one entry per set size, and these are
   chained in a small round.  Of lists that hold the same sets only the first in
   the global order is visited: the first common shingle of two sets decides.
   Bitmaps grow with the set (a bit for one or two shingles), so that long
   texts which share a phrase do not grow into one family.
4. Families above ``block_bytes`` are split again by whole prefixes: common
   shingles lie in both prefixes or behind one of them, so a pair must share
   a good part of its prefixes.
5. Inside a family the exact join runs in tasks over blocks of about
   ``block_bytes`` of sets: every task takes one pair of blocks.  A set's
   answers (its overlaps with every set of the block) are derived from the
   answers of the most similar set done before, reading only the lists of
   shingles in which the two differ.  Every link is found; tasks return the
   number of links of each set, copies included, and a forest, so output is
   linear in the sets.
6. Forests of several blocks meet in connected components by alternating
   large-star / small-star rounds.

Defined cases: texts of fewer words than a shingle are one shingle; NULL and
word-free texts have an empty set and link with nothing, not with each other;
repeated rows are one set; NULL doc_id ranks after all others as component
id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm import bytetext as B
from lendlens.llm import memory  # noqa: F401 (workers give freed memory back)
from lendlens.llm.common import column, materialize, small_enough
from lendlens.llm.components import components
from lendlens.session import remove_stored, shuffles_removed

BATCH_BYTES = 1 << 20
BITS = 512                 # least parity bitmap of a set: bit b tells whether oddly many shingles fall on b
MOST_BITS = 1 << 14        # largest parity bitmap
PAIR_BYTES = 1 << 22       # bitmaps compared together
REPEATED = 1_000_000       # ids of sets with copies that may be broadcast
DENSE_LIST = 4096          # lists up to this length are compared pair by pair in memory
COUNTED = 1_000_000        # shingles counted together
U64 = np.uint64


def shingles(hashes: np.ndarray, counts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes, row of each) of texts given as token hashes; short texts are one shingle."""
    ends = np.cumsum(counts)
    starts = ends - counts
    rows = np.repeat(np.arange(len(counts)), counts)
    n = len(hashes)
    rolled = np.zeros(n, U64)
    for k in range(words):
        m = max(n - k, 0)
        rolled[:m] = B.mix(rolled[:m] * U64(0x100000001B3) + hashes[k:k + m])
    whole = np.arange(n) + words <= ends[rows]
    out, of = rolled[whole], rows[whole]
    short = np.flatnonzero((counts > 0) & (counts < words))
    if len(short):
        one = []
        for r in short.tolist():
            h = U64(counts[r])
            with np.errstate(over="ignore"):
                for x in hashes[starts[r]:ends[r]]:
                    h = B.mix(np.array([h * U64(0x100000001B3) + x], U64))[0] ^ U64(0x5bd1e995)
            one.append(h)
        out, of = np.concatenate([out, np.array(one, U64)]), np.concatenate([of, short])
    return out, of


def distinct_sets(column_: pa.Array, words: int):
    """Yield (first row, row count, shingles, row of each): distinct per row, sorted by (row, hash)."""
    data, offsets = B.texts_of(column_)
    for lo, hi in B.split_rows(offsets, BATCH_BYTES):
        part = offsets[lo:hi + 1] - offsets[lo]
        sh, of = shingles(*B.tokens(data[offsets[lo]:offsets[hi]], part, B.SPACED), words)
        order = np.lexsort((sh, of))
        sh, of = sh[order], of[order]
        fresh = np.ones(len(sh), bool)
        fresh[1:] = (sh[1:] != sh[:-1]) | (of[1:] != of[:-1])
        yield lo, hi - lo, sh[fresh], of[fresh]


def heavy_shingles(docs: DataFrame, words: int, heavy: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``heavy`` frequent shingles (sorted) and their weights; only the order of prefixes depends on it."""
    def count(batches):
        seen, waiting = [], 0

        def flush():
            values, n = np.unique(np.concatenate(seen), return_counts=True)
            more = n > 3
            return pa.RecordBatch.from_arrays([pa.array(values[more].view(np.int64)), pa.array(n[more].astype(np.int64))],
                                              names=["shingle", "n"])

        for batch in batches:
            for _, _, sh, _ in distinct_sets(batch.column(0), words):
                seen.append(sh)
                waiting += len(sh)
                if waiting >= COUNTED:
                    yield flush()
                    seen, waiting = [], 0
        if seen:
            yield flush()

    found = (docs.select(column(docs, "text", "string").alias("text")).mapInArrow(count, "shingle bigint, n bigint")
             .groupBy("shingle").agg(F.sum("n").alias("n")).filter(F.col("n") >= 16)
             .orderBy(F.desc("n"), "shingle").limit(heavy).toArrow())
    values = found.column("shingle").to_numpy().view(U64)
    order = np.argsort(values)
    return values[order], found.column("n").to_numpy()[order]


def _weights(sh: np.ndarray, values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    if not len(values):
        return np.zeros(len(sh), np.int64)
    at = np.minimum(np.searchsorted(values, sh), len(values) - 1)
    return np.where(values[at] == sh, counts[at], 0)


def bitmap_bits(n: np.ndarray) -> np.ndarray:
    """Bits of the parity bitmap of sets of ``n`` shingles: a power of two of at least n / 2, within the bounds."""
    bits, w = np.full(len(n), BITS, np.int64), BITS
    while w < MOST_BITS:
        bits[n > 2 * w] = 2 * w
        w *= 2
    return bits


def bitmaps(sh: np.ndarray, of: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Parity bitmap of each set, given the shingles of all and the row of each; wider ones fold to narrower ones by XOR."""
    bits = bitmap_bits(n)
    ends = np.cumsum(bits)
    code = (ends - bits)[of] + (B.mix(sh ^ U64(0x2545F4914F6CDD1D)) % bits.astype(U64)[of]).astype(np.int64)
    raw = np.packbits((np.bincount(code, minlength=bits.sum()) & 1).astype(np.uint8)).tobytes()
    return [raw[(e - b) // 8:e // 8] for e, b in zip(ends.tolist(), bits.tolist())]


class Bitmaps:
    """Parity bitmaps of index entries, those of one width as the rows of a matrix."""

    def __init__(self, raw: list[bytes]):
        self.width = np.array([len(b) for b in raw], np.int64)
        self.place, self.rows = np.zeros(len(raw), np.int64), {}
        for w in np.unique(self.width).tolist():
            at = np.flatnonzero(self.width == w)
            self.place[at] = np.arange(len(at))
            self.rows[w] = np.frombuffer(b"".join([raw[k] for k in at.tolist()]), U64).reshape(len(at), w // 8)

    def part(self, at: slice) -> "Bitmaps":
        some = Bitmaps([])
        some.width, some.place, some.rows = self.width[at], self.place[at], self.rows
        return some

    def _folded(self, k: np.ndarray, width: int) -> np.ndarray:
        out = np.empty((len(k), width // 8), U64)
        own = self.width[k]
        for w in np.unique(own).tolist():
            at = np.flatnonzero(own == w)
            out[at] = np.bitwise_xor.reduce(self.rows[w][self.place[k[at]]].reshape(len(at), w // width, width // 8), axis=1)
        return out

    def differ(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Differing bits of the pairs (i, j) at the narrower of their widths: shingles in one of the two only are at least as many."""
        width = np.minimum(self.width[i], self.width[j])
        out = np.zeros(len(i), np.int64)
        for w in np.unique(width).tolist():
            pairs = np.flatnonzero(width == w)
            step = PAIR_BYTES // w
            for lo in range(0, len(pairs), step):
                at = pairs[lo:lo + step]
                out[at] = np.bitwise_count(self._folded(i[at], w) ^ self._folded(j[at], w)).sum(1)
        return out


def prefix_table(docs: DataFrame, words: int, percent: int, order) -> DataFrame:
    """doc_id, text_key, set_id, n, prefix (64-bit shingles in the global order, as bytes), bits (parity bitmap)."""

    def build(batches):
        for batch in batches:
            for lo, rows, sh, of in distinct_sets(batch.column(1), words):
                n = np.bincount(of, minlength=rows)
                ends = np.cumsum(n)
                mixed = B.mix(sh) + U64(1)
                sums = np.concatenate([[U64(0)], np.cumsum(sh)])
                sums2 = np.concatenate([[U64(0)], np.cumsum(mixed)])
                with np.errstate(over="ignore"):
                    ids = B.mix((sums[ends] - sums[ends - n]) * U64(0x9E3779B97F4A7C15) ^ B.mix(sums2[ends] - sums2[ends - n]) ^ n.astype(U64))
                rank = np.lexsort((sh, _weights(sh, *order.value), of))
                ranked = sh[rank]
                keep = n - -(-percent * n // 100) + 1
                prefixes = [ranked[e - k:e - k + p].tobytes() if k else b"" for e, k, p in zip(ends.tolist(), n.tolist(), keep.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, rows), batch.column(2).slice(lo, rows), pa.array(np.where(n > 0, ids.view(np.int64), 0)), pa.array(n.astype(np.int64)),
                     pa.array(prefixes, pa.binary()), pa.array(bitmaps(sh, of, n), pa.binary())],
                    names=["doc_id", "text_key", "set_id", "n", "prefix", "bits"])

    text = column(docs, "text", "string")
    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_key"))
    return rows.mapInArrow(build, "doc_id bigint, text_key bigint, set_id bigint, n bigint, prefix binary, bits binary")


def distinct_sets_of(rows: DataFrame) -> DataFrame:
    """set_id, n, prefix, bits of every set that is not empty; only rows with copies are shuffled while their ids can be broadcast."""
    filled = rows.filter("n > 0").select("set_id", "n", "prefix", "bits")
    one = lambda df: df.groupBy("set_id").agg(*[F.first(c).alias(c) for c in ("n", "prefix", "bits")])
    copied = filled.groupBy("set_id").agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").select("set_id")
    copied = materialize(copied, "jaccard-copied")
    if copied.limit(REPEATED + 1).count() > REPEATED:
        return one(filled)
    copied = F.broadcast(copied)
    return filled.join(copied, "set_id", "left_anti").unionByName(one(filled.join(copied, "set_id", "left_semi")))


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the edges: (node, smallest node of its tree) for nodes that are not the smallest."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[:len(a)], flat[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        new = new[new]
        if (new == label).all():
            break
        label = new
    child = label != np.arange(len(nodes))
    return nodes[child], nodes[label[child]]


def live_entries(sets: DataFrame, percent: int, buckets: int, long_list: int, order, hot_entries: int) -> DataFrame:
    """Index entries (sh, set_id, n, pos) that some other entry of their list survives with, by length and position."""
    def scatter(batches):
        for batch in batches:
            size = np.array([len(p) // 8 for p in batch.column("prefix").to_pylist()], np.int64)
            sh = np.frombuffer(b"".join(batch.column("prefix").to_pylist()), U64)
            ids = np.repeat(batch.column("set_id").to_numpy(), size)
            n = np.repeat(batch.column("n").to_numpy(), size).astype(np.int32)
            pos = (np.arange(len(sh)) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32)
            parts = 1 + _weights(sh, *order.value) // hot_entries
            part = (B.mix(ids.view(U64)) % parts.astype(U64)).astype(np.int64)
            to = (((sh >> U64(32)) % U64(buckets)).astype(np.int64) + part) % buckets
            rank = np.lexsort((sh, to))
            sh, ids, n, pos, to = sh[rank], ids[rank], n[rank], pos[rank], to[rank]
            used, begin = np.unique(to, return_index=True)
            cuts = list(zip(used.tolist(), begin.tolist(), np.append(begin[1:], len(to)).tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([u for u, _, _ in cuts], pa.int32())]
                + [pa.array([v[s:e].tobytes() for _, s, e in cuts], pa.binary()) for v in (sh, ids, n, pos)],
                names=["bucket", "sh", "ids", "n", "pos"])

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        sh, ids, n, pos = (np.frombuffer(b"".join(pdf[c]), t) for c, t in (("sh", U64), ("ids", np.int64), ("n", np.int32), ("pos", np.int32)))
        hot = _weights(sh, *order.value) >= hot_entries        # its list is spread: every entry goes on
        _, flat, size = np.unique(sh, return_inverse=True, return_counts=True)
        some = hot | (size[flat] > 1)
        sh, flat, ids, n, pos, hot = sh[some], flat[some], ids[some], n[some].astype(np.int64), pos[some].astype(np.int64), hot[some]
        rank = np.lexsort((ids, n, flat))
        sh, flat, ids, n, pos, hot = sh[rank], flat[rank], ids[rank], n[rank], pos[rank], hot[rank]
        long = size[flat] > long_list
        live = hot.copy()
        for step in range(1, min(long_list, len(ids))):
            same = flat[step:] == flat[:-step]
            if step > 1:
                same &= ~long[step:]
            i = np.flatnonzero(same)
            if not len(i):
                break
            j = i + step
            most = 1 + np.minimum(n[i] - pos[i] - 1, n[j] - pos[j] - 1)
            fits = (100 * n[i] >= percent * n[j]) & (long[i] | (100 * most >= percent * (n[i] + n[j] - most)))
            live[i[fits]] = live[j[fits]] = True
        return pd.DataFrame({"sh": sh[live].view(np.int64), "set_id": ids[live], "n": n[live], "pos": pos[live]})

    blobs = sets.mapInArrow(scatter, "bucket int, sh binary, ids binary, n binary, pos binary")
    return blobs.groupBy("bucket").applyInPandas(gather, "sh bigint, set_id bigint, n bigint, pos bigint")


def _surviving(n, pos, bits, i, j, percent):
    """Which pairs (i, j) may still link: lengths, positions left after the shared shingle, parity bitmaps."""
    most = 1 + np.minimum(n[i] - pos[i] - 1, n[j] - pos[j] - 1)
    ok = (100 * n[i] >= percent * n[j]) & (100 * most >= percent * (n[i] + n[j] - most))
    i, j = i[ok], j[ok]
    # shingles in one of the two sets only are at least the differing parity bits
    both = (n[i] + n[j] - bits.differ(i, j)) // 2
    ok = 100 * both >= percent * (n[i] + n[j] - both)
    return i[ok], j[ok]


def list_forest(n: np.ndarray, pos: np.ndarray, bits: Bitmaps, ids: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest of the surviving pairs of one index list, entries sorted by length; very long lists are chained by length."""
    m = len(n)
    if m > DENSE_LIST:
        fits = np.flatnonzero(100 * n[:-1] >= percent * n[1:])
        return _forest(ids[fits], ids[fits + 1])
    a, b = [], []
    reach = np.searchsorted(n, 100 * n // percent, "right")           # length skipping: last partner of each entry
    for lo in range(0, m, 256):
        i, j = np.meshgrid(np.arange(lo, min(lo + 256, m)), np.arange(lo, int(reach[min(lo + 256, m) - 1])), indexing="ij")
        ok = (j > i) & (j < reach[i])
        i, j = _surviving(n, pos, bits, i[ok], j[ok], percent)
        a.append(ids[i])
        b.append(ids[j])
    return _forest(np.concatenate(a), np.concatenate(b))


def first_lists(live: DataFrame) -> DataFrame:
    """``live`` without the lists that hold the same sets as an earlier one of the global order (told by 128 bits and their number)."""
    lists = live.groupBy("sh").agg(
        F.count(F.lit(1)).alias("entries"), F.bit_xor(F.xxhash64("set_id")).alias("x"), F.bit_xor(F.xxhash64("set_id", F.lit("lists"))).alias("y"),
        F.min(F.struct("set_id", "pos")).alias("first"))                # in a set shingles follow the global order
    kept = lists.groupBy("entries", "x", "y").agg(F.min(F.struct(F.col("first.pos").alias("pos"), F.col("sh"))).alias("at"))
    return live.join(kept.select(F.col("at.sh").alias("sh")), "sh", "left_semi")


def family_edges(live: DataFrame, sets: DataFrame, percent: int, buckets: int, hot_entries: int) -> DataFrame:
    """Forest edges (a, b) of the pairs that share a list and survive length, position and bitmap skipping."""
    hot = live.groupBy("sh").agg(F.count(F.lit(1)).alias("entries")).filter(F.col("entries") > min(DENSE_LIST, hot_entries))
    hot = materialize(hot.select("sh", F.lit(True).alias("long"), F.when(
        F.col("entries") > hot_entries, F.ceil(F.col("entries") / hot_entries)).cast("int").alias("parts")), "jaccard-hot-lists")
    # lists that get chained need no bitmaps
    dealt = (live.join(small_enough(hot, 100_000), "sh", "left").join(sets.select("set_id", "bits"), "set_id")
             .withColumn("bits", F.when(F.col("long").isNull(), F.col("bits"))).drop("long")
             .withColumn("bucket", F.pmod(F.xxhash64("sh", F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("set_id"), F.col("parts")))), F.lit(buckets)).cast("int"))
             .withColumn("spread", F.col("parts").isNotNull()))

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["sh", "n", "set_id"])
        sh, n, pos, ids = (pdf[c].to_numpy() for c in ("sh", "n", "pos", "set_id"))
        bits = Bitmaps([b or b"" for b in pdf["bits"]])
        _, begin, size = np.unique(sh, return_index=True, return_counts=True)
        flat = np.repeat(np.arange(len(begin)), size)
        a, b = [], []
        spread = pdf["spread"].to_numpy()                               # part of a dealt list: chained, see ``chain``
        i = np.flatnonzero(spread[1:] & (flat[1:] == flat[:-1]))
        i = i[100 * n[i] >= percent * n[i + 1]]
        a.append(ids[i])
        b.append(ids[i + 1])
        short = (size[flat] <= 16) & ~spread
        for step in range(1, 16):                                      # all short lists at once
            i = np.flatnonzero((flat[step:] == flat[:-step]) & short[step:])
            if not len(i):
                break
            i, j = _surviving(n, pos, bits, i, i + step, percent)
            a.append(ids[i])
            b.append(ids[j])
        for k in np.flatnonzero((size > 16) & ~spread[begin]).tolist():
            at = slice(begin[k], begin[k] + size[k])
            x, y = list_forest(n[at], pos[at], bits.part(at), ids[at], percent)
            a.append(x)
            b.append(y)
        a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a, b))
        x, y = _forest(a, b) if len(a) else (a, b)
        spots = pdf[pdf["spread"]].drop_duplicates(["sh", "n"])
        return pd.DataFrame({"a": np.concatenate([x, spots["set_id"]]), "b": np.concatenate([y, np.zeros(len(spots), np.int64)]),
                             "sh": pd.array([None] * len(x) + spots["sh"].tolist(), "Int64"),
                             "n": pd.array([None] * len(x) + spots["n"].tolist(), "Int64")})

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("n")
        fits = 100 * pdf["n"].to_numpy()[:-1] >= percent * pdf["n"].to_numpy()[1:]
        return pd.DataFrame({"a": pdf["a"].to_numpy()[1:][fits], "b": pdf["a"].to_numpy()[:-1][fits]})

    found = dealt.groupBy("bucket").applyInPandas(gather, "a bigint, b bigint, sh bigint, n bigint")
    found = materialize(found, "jaccard-lists")
    across = found.filter("sh IS NOT NULL").groupBy("sh").applyInPandas(chain, "a bigint, b bigint")
    return found.filter("sh IS NULL").select("a", "b").unionByName(across).distinct()


def join_blocks(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray, percent: int, copies: np.ndarray):
    """All links among ``sets``, as (forest child, its root, links per set in the order of ``ids``).

    ``side`` 0 / 1 asks for links across the two sides only, all -1 for all.  A linked set counts ``copies`` times.
    A set's answers are its overlaps with every set of the block.  They are derived from those of the set done
    before, chosen as the most similar one left: only lists of shingles that one of the two holds alone are read.
    """
    m = len(sets)
    n = np.array([len(s) for s in sets], np.int64)
    copies = np.asarray(copies, np.int64)
    _, code, freq = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    code = code.astype(np.int32)                                    # a block holds far fewer than 2^31 shingles
    owner = np.repeat(np.arange(m, dtype=np.int32), n)
    lists = owner[np.argsort(code, kind="stable")]
    begin = np.concatenate([[0], np.cumsum(freq)])
    ends = np.cumsum(n)
    marked = np.zeros(len(freq), bool)

    def overlaps(codes: np.ndarray) -> np.ndarray:
        parts = [lists[s:e] for s, e in zip(begin[codes].tolist(), begin[codes + 1].tolist())]
        return np.bincount(np.concatenate(parts), minlength=m) if parts else np.zeros(m, np.int64)

    def without(some: np.ndarray, others: np.ndarray) -> np.ndarray:
        marked[others] = True
        left = some[~marked[some]]
        marked[others] = False
        return left

    label = np.arange(m)
    links = np.zeros(m, np.int64)
    todo = side <= 0                                                # links across: asked from side 0, told to both
    waiting = iter(np.argsort(n, kind="stable").tolist())
    x, both, last = None, None, None
    for _ in range(int(todo.sum())):
        if x is None:
            x = next(k for k in waiting if todo[k])
        mine = code[ends[x] - n[x]:ends[x]]
        if last is not None:
            less, more = without(last, mine), without(mine, last)
        if last is None or freq[less].sum() + freq[more].sum() >= freq[mine].sum():
            both = overlaps(mine)
        else:
            both = both - overlaps(less) + overlaps(more)
        last = mine
        todo[x] = False
        linked = (both > 0) & (100 * both >= percent * (n[x] + n - both))
        linked[x] = False
        if side[x] >= 0:
            linked &= side != side[x]
            links[linked] += copies[x]
        links[x] += copies[linked].sum()
        joined = np.unique(label[linked])
        joined = joined[joined != label[x]]
        if len(joined):
            label[np.isin(label, joined)] = label[x]
        near = np.flatnonzero(todo & (both > 0))
        x = int(near[np.argmax(both[near] / (n[x] + n[near] - both[near]))]) if len(near) else None
    low = np.full(m, np.iinfo(np.int64).max)
    np.minimum.at(low, label, ids)
    root = low[label]
    child = root != ids
    return ids[child], root[child], links


def prefix_forest(ids: np.ndarray, n: np.ndarray, prefixes: list[np.ndarray], side: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest of the pairs whose prefixes share enough: common shingles are in both prefixes or behind one of them."""
    by_size = np.argsort(n, kind="stable")
    ids, n, side = ids[by_size], n[by_size], side[by_size]
    size = np.array([len(prefixes[k]) for k in by_size.tolist()], np.int64)
    owner = np.repeat(np.arange(len(n)), size)
    _, code = np.unique(np.concatenate([prefixes[k] for k in by_size.tolist()]), return_inverse=True)
    order = np.argsort(code, kind="stable")
    begin = np.searchsorted(code[order], np.arange(code.max() + 2))
    spot = np.empty(len(code), np.int64)
    spot[order] = np.arange(len(order))
    ends = np.cumsum(size)
    a, b = [], []
    for x in range(len(n)):
        mine = np.arange(ends[x] - size[x], ends[x])
        lists = [owner[order[begin[c]:e]] for c, e in zip(code[mine].tolist(), spot[mine].tolist()) if e > begin[c]]
        if not lists:
            continue
        y, both = np.unique(np.concatenate(lists), return_counts=True)
        most = both + np.maximum(n[x] - size[x], n[y] - size[y])
        fits = (100 * n[y] >= percent * n[x]) & (100 * most >= percent * (n[x] + n[y] - most))
        if side[x] >= 0:
            fits &= side[y] != side[x]
        a.append(np.full(int(fits.sum()), ids[x]))
        b.append(ids[y[fits]])
        if sum(map(len, a)) > 1_000_000:                     # keep a forest only
            x_, y_ = _forest(np.concatenate(a), np.concatenate(b))
            a, b = [x_], [y_]
    return _forest(np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _block_pairs(sets: DataFrame) -> DataFrame:
    """Block b of a family goes to the tasks (b, other) and (other, b)."""
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return sets.withColumn("other", others).withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))


def refine(families: DataFrame, sets: DataFrame, percent: int, block_bytes: int) -> DataFrame:
    """Split families of more than ``block_bytes`` by what their sets' whole prefixes share; the others stay."""
    sized = families.join(sets, "set_id")
    total = materialize(sized.groupBy("family").agg(F.sum("n").alias("size")).filter(F.col("size") * 8 > block_bytes), "jaccard-large")
    if total.isEmpty():
        return families
    large = sized.join(F.broadcast(total) if total.limit(100_001).count() <= 100_000 else total, "family")
    large = large.withColumn("blocks", F.ceil(F.col("size") * 8 / (5 * block_bytes)).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        low, high = pdf["low"].iloc[0], pdf["high"].iloc[0]
        side = np.full(len(pdf), -1) if low == high else (pdf["block"] == high).to_numpy().astype(int)
        a, b = prefix_forest(pdf["set_id"].to_numpy(), pdf["n"].to_numpy(), [np.frombuffer(s, U64) for s in pdf["prefix"]], side, percent)
        return pd.DataFrame({"a": a, "b": b})

    edges = materialize(_block_pairs(large.select("family", "set_id", "n", "prefix", "block", "blocks"))
                        .groupBy("family", "low", "high").applyInPandas(join, "a bigint, b bigint"), "jaccard-refined")
    parts = components(edges).select(F.col("node").alias("set_id"), F.col("component").alias("family"))
    return families.join(total.select("family"), "family", "left_anti").select("set_id", "family").unionByName(parts)


def link_forest(members: DataFrame, docs: DataFrame, words: int, percent: int, block_bytes: int) -> DataFrame:
    """Exact links inside families: forest edges (a, b) and, with NULL b, shares of the links of set a.

    ``members``: family, set_id, n, copies and the row (doc_id, text_key) of one holder.
    """
    sizes = members.groupBy("family").agg(F.sum("n").alias("size"))
    blocks = members.join(sizes, "family").withColumn("blocks", F.ceil(F.col("size") * 8 / block_bytes).cast("int"))
    blocks = materialize(blocks.withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")), "jaccard-blocks")

    def rebuild(batches):
        for batch in batches:
            for lo, rows, sh, of in distinct_sets(batch.column("text"), words):
                ends = np.searchsorted(of, np.arange(rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(lo, rows) for c in ("family", "block", "blocks", "set_id", "copies")]
                    + [pa.array([sh[ends[k]:ends[k + 1]].tobytes() for k in range(rows)], pa.binary())],
                    names=["family", "block", "blocks", "set_id", "copies", "shingles"])

    holders = small_enough(blocks.select("family", "block", "blocks", "set_id", "copies", F.col("doc_id").alias("_holder"),
                                         F.col("text_key").alias("_key")), 500_000)
    text = column(docs, "text", "string")
    held = docs.select(column(docs, "doc_id", "long").alias("_doc"), text.alias("text"), F.xxhash64(text).alias("_own")).join(
        holders, F.col("_doc").eqNullSafe(F.col("_holder")) & (F.col("_own") == F.col("_key")))
    sets = materialize(held.select("family", "block", "blocks", "set_id", "copies", "text").mapInArrow(
        rebuild, "family bigint, block int, blocks int, set_id bigint, copies bigint, shingles binary"), "jaccard-sets")

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("set_id")             # repeated rows hold the same set
        low, high = pdf["low"].iloc[0], pdf["high"].iloc[0]
        side = np.full(len(pdf), -1) if low == high else (pdf["block"] == high).to_numpy().astype(int)
        ids = pdf["set_id"].to_numpy()
        a, b, links = join_blocks(ids, [np.frombuffer(s, U64) for s in pdf["shingles"]], side, percent, pdf["copies"].to_numpy())
        some = links > 0
        return pd.DataFrame({"a": np.concatenate([a, ids[some]]), "b": pd.array(b.tolist() + [None] * int(some.sum()), "Int64"),
                             "links": pd.array([None] * len(a) + links[some].tolist(), "Int64")})

    return _block_pairs(sets).groupBy("family", "low", "high").applyInPandas(join, "a bigint, b bigint, links bigint")


def linked_rows(docs: DataFrame, words: int = 5, percent: int = 80, heavy: int = 1_000_000,
                long_list: int = 64, block_bytes: int = 1 << 23, bucket_mb: int = 8,
                hot_entries: int = 200_000) -> DataFrame:
    """doc_id, text_key, set_id, n, n_links, label (one value per link component, NULL for empty sets): one stored row per document."""
    with shuffles_removed(docs.sparkSession):
        return _linked_rows(docs, words, percent, heavy, long_list, block_bytes, bucket_mb, hot_entries)


def _linked_rows(docs: DataFrame, words: int, percent: int, heavy: int, long_list: int, block_bytes: int, bucket_mb: int, hot_entries: int) -> DataFrame:
    order = docs.sparkSession.sparkContext.broadcast(heavy_shingles(docs, words, heavy))
    rows = materialize(prefix_table(docs, words, percent, order), "jaccard-prefixes")
    sets = distinct_sets_of(rows)
    total = rows.agg(F.sum(F.octet_length("prefix"))).first()[0] or 0
    buckets = max(32, int(total) // (bucket_mb << 20))
    live = materialize(live_entries(sets, percent, buckets, long_list, order, hot_entries), "jaccard-live")
    lists = materialize(first_lists(live), "jaccard-first-lists")
    edges = materialize(family_edges(lists, sets, percent, buckets, hot_entries), "jaccard-family-edges")
    remove_stored(live)
    remove_stored(lists)
    families = components(edges).select(F.col("node").alias("set_id"), F.col("component").alias("family"))
    families = materialize(refine(materialize(families, "jaccard-families"), sets, percent, block_bytes), "jaccard-families")
    members = (rows.select("doc_id", "text_key", "set_id", "n").join(families, "set_id").groupBy("set_id", "family", "n")
               .agg(F.min(F.struct("doc_id", "text_key")).alias("holder"), F.count(F.lit(1)).alias("copies"))
               .select("set_id", "family", "n", "copies", "holder.*"))
    forest = materialize(link_forest(members, docs, words, percent, block_bytes), "jaccard-links")
    linked = materialize(components(forest.filter("b IS NOT NULL").select("a", "b")), "jaccard-components")
    counted = forest.filter("links IS NOT NULL").groupBy(F.col("a").alias("set_id")).agg(F.sum("links").alias("links"))
    answers = (rows.filter("n > 0").groupBy("set_id").agg(F.count(F.lit(1)).alias("copies"))
               .join(linked.withColumnRenamed("node", "set_id"), "set_id", "left").join(counted, "set_id", "left"))
    # empty sets stay alone: each row is its own class
    labelled = rows.select("doc_id", "text_key", "set_id", "n").join(materialize(answers, "jaccard-answers"), "set_id", "left").select(
        "doc_id", "text_key", "set_id", "n",
        F.when(F.col("n") > 0, F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n") > 0, F.coalesce("component", "set_id")).alias("label"))
    return materialize(labelled, "jaccard-labels")


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80, **options: int) -> DataFrame:
    """doc_id, n_shingles, set_id, component_id (smallest linked doc_id), n_links (other rows it links to): one row per document."""
    labelled = linked_rows(docs, words, percent, **options)
    smallest = materialize(labelled.filter("n > 0").groupBy("label").agg(F.min("doc_id").alias("component_id")), "jaccard-smallest")
    return labelled.join(smallest, "label", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), "set_id",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "n_links")


def keep_one_per_group(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of every link component: the smallest doc_id (NULL last), then the smallest text hash.

    Rows are told apart by (doc_id, text), so NULL and repeated ids take part like any other.  Of rows
    repeated in both the one with the smallest JSON of all columns stays.  Rows without a word have an
    empty set, link with nothing and all stay.  Columns of any name are kept as they are.
    """
    rows = linked_rows(docs, words, percent).filter("n > 0").select("label", F.struct(
        F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc"), F.col("text_key").alias("key")).alias("at"))
    first = materialize(rows.groupBy("label").agg(F.min("at").alias("first")), "jaccard-first")
    found = rows.join(first, "label").filter(~F.col("at").eqNullSafe(F.col("first")))
    found = found.select(F.col("at.doc").alias("gone_doc"), F.col("at.key").alias("gone_key")).distinct()
    gone = small_enough(materialize(found, "near-duplicates"), 500_000)
    text = column(docs, "text", "string")
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), column(docs, "doc_id", "long").alias("doc"),
                       F.xxhash64(text).alias("key"), F.coalesce(text.rlike("[^\\x20\\x09-\\x0D]"), F.lit(False)).alias("linked"))
    same = lambda doc, key: F.col("doc").eqNullSafe(F.col(doc)) & (F.col("key") == F.col(key))
    kept = held.join(gone, same("gone_doc", "gone_key"), "left_anti")
    twice = held.filter("linked").groupBy("doc", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    twice = materialize(twice.select(F.col("doc").alias("twice_doc"), F.col("key").alias("twice_key")), "near-repeated")
    if not twice.isEmpty():
        twice = small_enough(twice, 500_000)
        repeated = kept.filter("linked").join(twice, same("twice_doc", "twice_key"), "left_semi")
        single = repeated.groupBy("doc", "key").agg(F.min_by("row", F.to_json("row")).alias("row"))
        others = kept.filter("NOT linked").unionByName(kept.filter("linked").join(twice, same("twice_doc", "twice_key"), "left_anti"))
        kept = others.select("row").unionByName(single.select("row"))
    return kept.select("row.*")
