"""Benchmark decontamination with a distributed positional inverted index.

Build: each task turns blocks of training texts into a positional index.  A
block holds, per test term, the sorted list of the block's token positions
(texts laid one after the other with a gap between them), and the row, first
position and token count of each text.  Blocks are bounded in bytes and are
stored as rows of a Parquet table, so any number of them is searched in
parallel and a lost executor re-reads only its own blocks.  Terms that no
test text uses are left out: no phrase can contain them.

Search: every block is probed with every test window.  A window starts from
its rarest term in that block; the term's positions, shifted back by the
term's offset in the window, are the candidates, and each further list
(rarest first) keeps those candidates that it confirms at its own offset.
Windows sharing the same term sequence are probed once.  ``proximity`` keeps
the order of the terms but lets each step skip up to that many tokens.

The test texts are read in chunks bounded in bytes (``chunk_bytes``); each
chunk is one broadcast and one pass, so a test set of any size stays within
that bound.

Defined cases: NULL or word-free texts have no words and match nothing; a test
text shorter than the window is one window; repeated test texts all report;
NULL item ids take part and count, but print nothing in the id list; repeated
documents are separate rows; an empty table on either side gives no hits;
extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm import bytetext as B
from lendlens.llm import memory  # noqa: F401 (workers give freed memory back)
from lendlens.llm.common import column, materialize, small_enough

WINDOW = 10
BLOCK_BYTES = 1 << 22
GAP = 64            # empty positions between two texts
STARTS = 1 << 20    # places of rarest terms followed together
INDEX = ("firsts", "lengths", "terms", "sizes", "positions")


class TestSet:
    """Test windows as term-id rows; small enough to ship to every task."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        texts = pa.array([t for _, t in items], pa.string())
        data, offsets = B.texts_of(texts)
        hashes, counts = B.tokens(data, offsets, B.WORDS)
        self.terms = np.unique(hashes)
        ids = np.searchsorted(self.terms, hashes)
        self.names = [i for i, _ in items]
        owners: dict[tuple[int, ...], set[int]] = {}
        at = 0
        for item, n in enumerate(counts.tolist()):
            row = ids[at:at + n].tolist()
            at += n
            for k in range(max(n - window, 0) + 1 if n else 0):
                owners.setdefault(tuple(row[k:k + window]), set()).add(item)
        self.windows = [np.array(w, np.int64) for w in owners]
        self.owners = [sorted(o) for o in owners.values()]
        sizes = np.array([len(w) for w in owners], np.int64)
        # windows of one length as the rows of a matrix, with their numbers
        self.by_length = [(k, np.array([self.windows[i] for i in k])) for k in (np.flatnonzero(sizes == n) for n in np.unique(sizes))]


def index_blocks(docs: DataFrame, tests: TestSet) -> DataFrame:
    """Positional index of ``docs`` restricted to the terms of ``tests``, one row per block."""
    shared = docs.sparkSession.sparkContext.broadcast(tests.terms)

    def build(batches):
        terms = shared.value
        for batch in batches:
            data, offsets = B.texts_of(batch.column(1))
            ids, keys = batch.column(0), batch.column(2)
            for lo, hi in B.split_rows(offsets, BLOCK_BYTES):
                part = offsets[lo:hi + 1] - offsets[lo]
                hashes, counts = B.tokens(data[offsets[lo]:offsets[hi]], part, B.WORDS)
                first = np.concatenate([[0], np.cumsum(counts + GAP)[:-1]]).astype(np.int64)
                position = np.arange(len(hashes)) + np.repeat(first - (np.cumsum(counts) - counts), counts)
                if len(terms):
                    near = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
                    known = np.flatnonzero(terms[near] == hashes)
                    near = near[known]
                    order = np.argsort(near, kind="stable")
                    near, position = near[order], position[known[order]]
                else:
                    near, position = np.zeros(0, np.int64), np.zeros(0, np.int64)
                used, begin = np.unique(near, return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids.slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64())),
                     pa.array([keys.slice(lo, hi - lo).to_pylist()], pa.list_(pa.int64())),
                     pa.array([first], pa.list_(pa.int64())), pa.array([counts.astype(np.int64)], pa.list_(pa.int64())),
                     pa.array([used.astype(np.int32)], pa.list_(pa.int32())),
                     pa.array([np.diff(np.append(begin, len(near))).astype(np.int32)], pa.list_(pa.int32())),
                     pa.array([position.astype(np.int32)], pa.list_(pa.int32()))],
                    names=["doc_ids", "text_keys", "firsts", "lengths", "terms", "sizes", "positions"])

    rows = docs.select(column(docs, "doc_id", "long").alias("doc_id"), column(docs, "text", "string").alias("text"),
                       F.xxhash64(column(docs, "text", "string")).alias("text_key"))
    return rows.mapInArrow(build, "doc_ids array<bigint>, text_keys array<bigint>, firsts array<bigint>, lengths array<bigint>, "
                                  "terms array<int>, sizes array<int>, positions array<int>")


def _follow(starts: np.ndarray, lists: list[np.ndarray], proximity: int) -> list[tuple[int, int]]:
    """Ordered matches with gaps: (first, last) positions, each term the nearest one after the previous."""
    found = []
    for s in starts.tolist():
        last = s
        for terms in lists[1:]:
            k = int(np.searchsorted(terms, last + 1))
            if k == len(terms) or terms[k] > last + 1 + proximity:
                break
            last = int(terms[k])
        else:
            found.append((s, last + 1))
    return found


def search_block(block, tests: TestSet, proximity: int = 0):
    """(window number, first position, end position) arrays of all matches of one block."""
    terms, sizes, positions = (np.asarray(block[c], np.int64) for c in ("terms", "sizes", "positions"))
    ends = np.cumsum(sizes)
    place = np.full(len(tests.terms) + 1, -1, np.int64)
    place[terms] = np.arange(len(terms))
    present = lambda w: positions[ends[place[w]] - sizes[place[w]]:ends[place[w]]]
    top = int(positions.max()) + 2 if len(positions) else 1
    term_at = np.full(top + GAP, -1, np.int32)     # the lists as one positional array: a list's membership test
    term_at[positions] = np.repeat(terms, sizes)
    out = [np.zeros((0, 3), np.int64)]
    if proximity:
        for number, window in enumerate(tests.windows):
            if (place[window] >= 0).all():
                found = _follow(present(window[0]), [present(w) for w in window], proximity)
                out.append(np.array([(number, s, e) for s, e in found], np.int64).reshape(-1, 3))
        return np.concatenate(out)
    for numbers, windows in tests.by_length:                       # all windows of a length together
        where = place[windows]
        known = (where >= 0).all(1)
        numbers, windows, where = numbers[known], windows[known], where[known]
        by_rarity = np.argsort(sizes[where], axis=1, kind="stable")
        rows = np.arange(len(where))
        rarest = where[rows, by_rarity[:, 0]]
        chunk = np.cumsum(sizes[rarest]) // STARTS
        for c in np.unique(chunk):
            mine = np.flatnonzero(chunk == c)
            many = sizes[rarest[mine]]
            row = np.repeat(mine, many)
            offset = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            starts = positions[(ends - sizes)[rarest[row]] + offset] - by_rarity[row, 0]
            row, starts = row[starts >= 0], starts[starts >= 0]
            for j in range(1, windows.shape[1]):                   # the next rarest term must stand at its distance
                k = by_rarity[row, j]
                hit = term_at[np.minimum(starts + k, top)] == windows[row, k]
                row, starts = row[hit], starts[hit]
            out.append(np.column_stack([numbers[row], starts, starts + windows.shape[1]]))
    return np.concatenate(out)


def matches(index: DataFrame, tests: TestSet, proximity: int = 0) -> DataFrame:
    """One row per document: words, hit ranges (token positions) and the items hit."""
    shared = index.sparkSession.sparkContext.broadcast(tests)

    def search(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                block = {c: batch.column(c)[r].values.to_numpy(zero_copy_only=False) for c in INDEX}
                doc_ids, keys = batch.column("doc_ids")[r].values, batch.column("text_keys")[r].values
                found = search_block(block, shared.value, proximity)
                firsts, lengths = np.asarray(block["firsts"], np.int64), np.asarray(block["lengths"], np.int64)
                row = np.searchsorted(firsts, found[:, 1], "right") - 1 if len(found) else np.zeros(0, np.int64)
                inside = found[:, 2] <= firsts[row] + lengths[row] if len(found) else np.zeros(0, bool)
                found, row = found[inside], row[inside]
                ranges = [[] for _ in lengths]
                items = [set() for _ in lengths]
                for (number, s, e), r in zip(found.tolist(), row.tolist()):
                    ranges[r].append((s - int(firsts[r]), e - int(firsts[r])))
                    items[r].update(shared.value.owners[number])
                names = shared.value.names
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, keys, pa.array(lengths, pa.int64()),
                     pa.array([sorted({p for s, e in r for p in range(s, e)}) for r in ranges], pa.list_(pa.int64())),
                     pa.array([sorted({names[k] or "" for k in i}) for i in items], pa.list_(pa.string()))],
                    names=["doc_id", "text_key", "n_words", "hit_words", "items"])

    return index.mapInArrow(search, "doc_id bigint, text_key bigint, n_words bigint, hit_words array<bigint>, items array<string>")


def test_chunks(benchmark: DataFrame, window: int, chunk_bytes: int):
    """The test table as TestSets of bounded size; rows of one item id may lie in several."""
    rows = benchmark.select(column(benchmark, "item_id", "string").alias("item_id"),
                            F.coalesce(column(benchmark, "text", "string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    parts = max(1, -(-2 * int(total) // chunk_bytes))
    for part in range(parts):
        mine = rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part) if parts > 1 else rows
        yield TestSet([(r["item_id"], r["text"]) for r in mine.collect()], window)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, proximity: int = 0,
                       chunk_bytes: int = 1 << 25) -> DataFrame:
    """doc_id, text_key (hash of the text), n_words, hit_words (positions), items (sorted distinct ids as text): one row per document."""
    chunks = []
    for tests in test_chunks(benchmark, window, chunk_bytes):
        index = materialize(index_blocks(docs, tests), "positional-index")
        chunks.append(matches(index, tests, proximity))
    found, others = chunks[0], chunks[1:]
    if others:  # further chunks only add hits; equal rows get equal hits, so they are told once per (doc_id, text)
        more = others[0]
        for chunk in others[1:]:
            more = more.unionByName(chunk)
        more = more.filter(F.size("hit_words") > 0).groupBy(F.col("doc_id").alias("_d"), F.col("text_key").alias("_t")).agg(
            F.flatten(F.collect_set("hit_words")).alias("_hits"), F.flatten(F.collect_set("items")).alias("_items"))
        found = found.join(more, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_t")), "left")
        for c, extra in (("hit_words", "_hits"), ("items", "_items")):
            found = found.withColumn(c, F.when(F.col(extra).isNull(), F.col(c)).otherwise(
                F.array_sort(F.array_distinct(F.concat(c, extra)))))
    return found.select("doc_id", "text_key", "n_words", "hit_words", "items")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a test window; a row is its doc_id (may be NULL or repeated) and text."""
    found = find_contamination(docs, benchmark, window).filter(F.size("hit_words") > 0)
    hit = found.select(F.col("doc_id").alias("hit_doc"), F.col("text_key").alias("hit_key")).distinct()
    hit = small_enough(materialize(hit, "contaminated"), 500_000)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), column(docs, "doc_id", "long").alias("doc"),
                       F.xxhash64(column(docs, "text", "string")).alias("key"))
    clean = rows.join(hit, F.col("doc").eqNullSafe(F.col("hit_doc")) & (F.col("key") == F.col("hit_key")), "left_anti")
    return clean.select("row.*")
