"""Language-model scoring: a word n-gram Katz model with Good-Turing discounts, counted and evaluated by Spark.

Model.  Tokens are lower-case words and one end token per text; a text starts
from a start state.  With a context h of up to ``order`` - 1 tokens and h' the
same without its first,
  p(w | h) = d(c) c(h, w) / c(h) for n-grams seen in training, alpha(h) p(w | h') otherwise,
down to p(w) = d(c) c(w) / N for known words, and what the
discounts leave there belongs to the one unknown word.  A context that training never saw
passes on to h' as it is.  d(r) are Katz's Good-Turing discounts of the level for r <= ``K`` and 1 above;
where counts of counts cannot give a discount in (0, 1], K is lowered.  A context (or the
unigram level) to which no mass would be left gets one more count in its denominator.
alpha(h) = (1 - seen mass) / (1 - sum of p(w | h') over words seen after h), so
every context sums to one exactly.

Jobs.  Texts become *blocks*: a local vocabulary (64-bit word hashes) and local ids.
A level turns the ids of neighbours into n-grams of one word more: an
n-gram is the pair (id of its first n - 1 words, id of its last n - 1), both
seen in training.  Every block sends its distinct pairs, grouped by context,
with their own and the shorter n-gram's counts to buckets by context; a bucket adds
up, numbers the pairs that training saw and answers in the order of the question:
counts, ids, and per context the sums that discounts and back-off need, as
integers (followers by count class, total, followers by the class of the shorter n-gram).  A
frequent context is dealt over several buckets (one per ``hot`` of its count, the text start
too); its sums meet in a table of at most 200,000 rows.  Answers join the blocks in a table bucketed by
block, so a level moves its questions and answers only.  Last, each block evaluates its texts
from the unigrams up to the full order.  Levels are stored as partitioned tables.
The driver sees counts of counts and the sums of frequent contexts.

Defined cases: NULL and empty texts are one end token; a NULL doc_id hashes as
the empty text; repeated rows count and are scored row by row; with no
training text at all every word is unknown and has probability one as the
only unknown word (score 0) while base_score follows its formula; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendlens.llm import bytetext as B
from lendlens.llm import memory  # noqa: F401 (workers give freed memory back)
from lendlens.llm.common import column, materialize

U64 = np.uint64
END, START = U64(0x1F3A5B7C9D2E4F61), U64(0xA2B4C6D8E0F13579)
K = 5
ORDER = 2
BLOCK_TOKENS = 1_000_000
START_ID = 0                       # ids of words and n-grams begin at 1
SUMS = 2 * K + 3                   # per context: n_1 .. n_K, counts above K, total; m_1 .. m_K, shorter counts above K
BLOCKS = ("block string, n_tokens bigint, n_train bigint, doc_ids binary, train binary, counts binary, local binary, vocabulary binary, "
          "seen binary")
STATE = BLOCKS + ", levels array<binary>"
ANSWER = "kind int, block string, bucket int, answer binary, context bigint, sums array<bigint>, classes array<bigint>"


def pack(a: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(a).tobytes()
    return len(raw).to_bytes(8, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def unpack(b: bytes, kind) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    return np.frombuffer(pa.decompress(b[8:], n, codec="zstd", asbytes=True) if n else b"", kind)


def pack_many(arrays: list[np.ndarray]) -> bytes:
    """Integer arrays one after the other, each in the narrowest type that holds it."""
    out = []
    for a in arrays:
        kind = np.result_type(np.min_scalar_type(a.min()), np.min_scalar_type(a.max())) if len(a) else np.dtype(np.uint8)
        raw = pack(a.astype(kind))
        out.append(kind.char.encode() + len(raw).to_bytes(8, "little") + raw)
    return b"".join(out)


def unpack_many(b: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(b):
        n = int.from_bytes(b[at + 1:at + 9], "little")
        out.append(unpack(b[at + 9:at + 9 + n], np.dtype(chr(b[at]))).astype(np.int64))
        at += 9 + n
    return out


def token_blocks(docs: DataFrame, keep_out: int, modulus: int) -> DataFrame:
    """Blocks of about BLOCK_TOKENS tokens: doc ids, training flags, token counts, packed local ids, vocabulary and counts."""
    def build(batches):
        part, number, held = TaskContext.get().partitionId(), 0, []

        def flush():
            nonlocal number
            ids = pa.concat_arrays([x[0] for x in held])
            train = np.concatenate([x[1] for x in held])
            counts = np.concatenate([x[2] for x in held])
            hashes = np.concatenate([x[3] for x in held])
            known, local, size = np.unique(hashes, return_inverse=True, return_counts=True)
            by_size = np.argsort(-size, kind="stable")
            rank = np.empty(len(known), np.int32)
            rank[by_size] = np.arange(len(known), dtype=np.int32)
            local = rank[local]
            vocabulary = np.concatenate([known[by_size], [END, START]])
            seen = np.bincount(local[np.repeat(train, counts)], minlength=len(vocabulary))
            seen[len(known)] = train.sum()
            block = f"{part}-{number}"
            number += 1
            known_ids = [ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)]
            blobs = [pack_many(known_ids), pack(train.astype(np.uint8)), pack_many([counts]), pack(local.astype(np.int32)), pack(vocabulary),
                     pack(seen.astype(np.int64))]
            return pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([len(local) + len(train)], pa.int64()), pa.array([int(train.sum())], pa.int64()),
                 *[pa.array([b], pa.binary()) for b in blobs]],
                names=["block", "n_tokens", "n_train", "doc_ids", "train", "counts", "local", "vocabulary", "seen"])

        waiting = 0
        for batch in batches:
            data, offsets = B.texts_of(batch.column(2))
            train = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for lo, hi in B.split_rows(offsets, 1 << 23):
                hashes, counts = B.tokens(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], B.SPACED)
                held.append((batch.column(0).slice(lo, hi - lo), train[lo:hi], counts, hashes))
                waiting += len(hashes) + (hi - lo)
                if waiting >= BLOCK_TOKENS:
                    yield flush()
                    held, waiting = [], 0
        if held:
            yield flush()

    doc_id = column(docs, "doc_id", "long")
    rest = F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
    rows = docs.select(doc_id.alias("doc_id"), (rest != keep_out).alias("train"), column(docs, "text", "string").alias("text"))
    return rows.mapInArrow(build, BLOCKS)


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> str:
    """Store ``df`` as a table bucketed by ``key`` in the warehouse; returns its name."""
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    df.write.bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(table)
    return table


def word_bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes >> U64(32)) % U64(buckets)).astype(np.int64)


def _groups(keys: np.ndarray):
    """(key, positions) for each distinct key, positions ascending."""
    order = np.argsort(keys, kind="stable")
    used, begin = np.unique(keys[order], return_index=True)
    return [(int(u), g) for u, g in zip(used, np.split(order, begin[1:]))]


def _classes(counts: np.ndarray) -> list[int]:
    """n_1 .. n_{k+1} of positive counts, types, and the sum of counts above k."""
    n = np.bincount(np.minimum(counts, K + 2), minlength=K + 3)[1:K + 2].tolist()
    return n + [int((counts > 0).sum()), int(counts[counts > K].sum())]


def _numbered(total: np.ndarray, bucket: int, buckets: int) -> np.ndarray:
    """Ids of the entries with a count, small for frequent ones; -1 for the others."""
    seen = np.flatnonzero(total > 0)
    seen = seen[np.argsort(-total[seen], kind="stable")]
    ids = np.full(len(total), -1, np.int64)
    ids[seen] = 1 + np.arange(len(seen), dtype=np.int64) * buckets + bucket
    return ids


class Discounts:
    """Katz's Good-Turing discounts from n_1 .. n_{k+1}."""

    def __init__(self, n: list[int]):
        self.d = np.ones(K + 1)
        for k in range(K, 0, -1):
            if not all(n[:k + 1]):
                continue
            cut = (k + 1) * n[k] / n[0]
            r = np.arange(1, k + 1)
            d = ((r + 1) * np.array(n[1:k + 1]) / np.array(n[:k]) / r - cut) / (1 - cut) if cut != 1 else np.zeros(k)
            if ((d > 0) & (d <= 1)).all():
                self.d[1:k + 1] = d
                break

    def discounted(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts <= K, self.d[np.minimum(counts, K)], 1.0) * counts


class Unigram:
    def __init__(self, n: list[int], types: int, rest: int):
        self.tokens = sum(r * n[r - 1] for r in range(1, K + 1)) + rest
        self.types = types
        self.discounts = Discounts(n)
        kept = sum(r * self.discounts.d[r] * n[r - 1] for r in range(1, K + 1)) + rest
        self.below = self.tokens if self.tokens - kept > 1e-9 * max(self.tokens, 1) else self.tokens + 1
        self.unknown = 1.0 - kept / self.below

    def p(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, self.discounts.discounted(counts) / self.below, self.unknown)


def word_counts(blocks: DataFrame, buckets: int) -> DataFrame:
    """ANSWER rows of the unigrams: kind 0 answers a block (counts and ids), kind 2 holds a bucket's classes."""
    def ask(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                words, seen = unpack(batch.column(1)[r].as_py(), U64), unpack(batch.column(2)[r].as_py(), np.int64)
                got = _groups(word_bucket(words, buckets))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([u for u, _ in got], pa.int32()), pa.array([batch.column(0)[r].as_py()] * len(got)),
                     pa.array([words[g].tobytes() for _, g in got], pa.binary()), pa.array([pack_many([seen[g]]) for _, g in got], pa.binary())],
                    names=["bucket", "block", "words", "seen"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        words = [np.frombuffer(w, U64) for w in pdf["words"]]
        known, back = np.unique(np.concatenate(words), return_inverse=True)
        total = np.zeros(len(known), np.int64)
        np.add.at(total, back, np.concatenate([unpack_many(s)[0] for s in pdf["seen"]]))
        bucket, cuts = int(pdf["bucket"].iloc[0]), np.cumsum([len(w) for w in words])[:-1]
        ids = _numbered(total, bucket, buckets)
        rows = [(0, b, bucket, pack_many([total[g], ids[g]]), None, None, None) for b, g in zip(pdf["block"], np.split(back, cuts))]
        return pd.DataFrame(rows + [(2, None, bucket, None, None, None, _classes(total))],
                            columns=["kind", "block", "bucket", "answer", "context", "sums", "classes"]).astype({"context": "Int64"})

    asked = blocks.select("block", "vocabulary", "seen").mapInArrow(ask, "bucket int, block string, words binary, seen binary")
    return asked.groupBy("bucket").applyInPandas(answer, ANSWER)


class Block:
    """The texts of a block as one sequence: start, words, end of each text."""

    def __init__(self, row):
        self.levels = [unpack_many(b) for b in row["levels"]] if row["levels"] is not None else []
        self.words = unpack(row["vocabulary"], U64) if row["vocabulary"] is not None else None
        width = len(self.words) if self.words is not None else len(self.levels[0][0])
        counts = unpack_many(row["counts"])[0]
        sizes = counts + 2
        ends = np.cumsum(sizes)
        starts = ends - sizes
        inner = np.ones(int(ends[-1]) if len(ends) else 0, bool)
        inner[starts] = inner[ends - 1] = False
        self.word = np.empty(len(inner), np.int64)                  # local words; the vocabulary ends with END, START
        self.word[inner] = unpack(row["local"], np.int32)
        self.word[starts], self.word[ends - 1] = width - 1, width - 2
        self.offset = np.arange(len(inner)) - np.repeat(starts, sizes)
        self.train = np.repeat(unpack(row["train"], np.uint8).astype(bool), sizes)
        self.sizes = sizes

    def grams(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(id or -1, count) at every position of the n-gram of ``size`` words that ends there."""
        count, ids = self.levels[0]
        c, g = count[self.word], ids[self.word]
        for k in range(2, size + 1):
            pairs = Pairs(g, c, self, k)
            count, ids = self.levels[k - 1][:2]
            c, g = np.zeros(len(g), np.int64), np.full(len(g), -1, np.int64)
            c[pairs.at[pairs.asked]], g[pairs.at[pairs.asked]] = count[pairs.back], ids[pairs.back]
        return g, c


class Pairs:
    """Distinct n-grams of ``size`` words as pairs of neighbouring shorter ones, and all contexts met."""

    def __init__(self, g: np.ndarray, c: np.ndarray, block: Block, size: int):
        at = np.flatnonzero(block.offset >= size - 1)
        self.at = at = at[g[at - 1] >= 0]                           # positions whose context was seen
        self.context, self.of = np.unique(g[at - 1], return_inverse=True)
        self.context_count = np.zeros(len(self.context), np.int64)
        self.context_count[self.of] = c[at - 1]
        self.asked = np.flatnonzero(g[at] >= 0)                     # positions (in ``at``) whose shorter n-gram was seen too
        right, ro = np.unique(g[at[self.asked]], return_inverse=True)
        code, self.back = np.unique(self.of[self.asked] * max(len(right), 1) + ro, return_inverse=True)
        self.left, self.right = code // max(len(right), 1), right[code % max(len(right), 1)] if len(right) else right
        self.low = np.zeros(len(code), np.int64)
        self.low[self.back] = c[at[self.asked]]
        self.seen = np.bincount(self.back[block.train[at[self.asked]]], minlength=len(code)).astype(np.int64)

    def dealt(self, buckets: int, hot: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(bucket, pairs, contexts) of every bucket asked; a frequent context is asked in several."""
        base, spread = B.mix(self.context.astype(U64)), (1 + self.context_count // hot).astype(U64)
        to = ((base[self.left] + B.mix(self.right.astype(U64)) % spread[self.left]) % U64(buckets)).astype(np.int64)
        calm = np.flatnonzero(spread == 1)
        alone = dict(_groups((base[calm] % U64(buckets)).astype(np.int64)))
        pairs = dict(_groups(to))
        none = np.zeros(0, np.int64)
        return [(u, pairs.get(u, none), np.union1d(self.left[pairs.get(u, none)], calm[alone.get(u, none)])) for u in sorted({*pairs, *alone})]


def ngram_counts(state: DataFrame, size: int, buckets: int, hot: int, last: bool) -> DataFrame:
    """ANSWER rows of the n-grams of ``size`` words: 0 answers a block, 1 reports a frequent context, 2 counts classes.  The last level needs no ids."""
    def ask(pdfs):
        for pdf in pdfs:
            for row in pdf.to_dict("records"):
                block = Block(row)
                pairs = Pairs(*block.grams(size - 1), block, size)
                out = []
                for u, mine, contexts in pairs.dealt(buckets, hot):
                    runs = np.bincount(np.searchsorted(contexts, pairs.left[mine]), minlength=len(contexts))
                    out.append((u, row["block"], pack_many([np.diff(pairs.context[contexts], prepend=0), runs, (pairs.context_count[contexts] >= hot).astype(np.int64),
                                                            pairs.right[mine], pairs.low[mine], pairs.seen[mine]])))
                yield pd.DataFrame(out, columns=["bucket", "block", "question"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("block")
        asked = [unpack_many(q) for q in pdf["question"]]
        contexts = [np.cumsum(a[0]) for a in asked]
        context, of = np.unique(np.concatenate(contexts), return_inverse=True)
        ofs = np.split(of, np.cumsum([len(c) for c in contexts])[:-1])
        left = np.concatenate([np.repeat(o, a[1]) for o, a in zip(ofs, asked)])
        right, ro = np.unique(np.concatenate([a[3] for a in asked]), return_inverse=True)
        code, back = np.unique(left * max(len(right), 1) + ro, return_inverse=True)
        total, low = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
        np.add.at(total, back, np.concatenate([a[5] for a in asked]))
        low[back] = np.concatenate([a[4] for a in asked])
        bucket = int(pdf["bucket"].iloc[0])
        ids = np.zeros(len(total), np.int64) if last else _numbered(total, bucket, buckets)
        live = total > 0
        h, c, m = code[live] // max(len(right), 1), total[live], low[live]
        sums = np.zeros((SUMS, len(context)), np.int64)
        for first, values in ((0, c), (K + 2, m)):
            np.add.at(sums, (first + np.minimum(values, K + 1) - 1, h), np.where(values > K, values, 1))
        np.add.at(sums[K + 1], h, c)
        rows, at = [], 0
        hot_ones = np.zeros(len(context), bool)
        for block, a, o in zip(pdf["block"], asked, ofs):
            mine = back[at:at + len(a[3])]
            at += len(a[3])
            hot_ones[o[a[2] > 0]] = True
            rows.append((0, block, bucket, pack_many([total[mine], ids[mine], sums[:, o[a[2] == 0]].ravel()]), None, None, None))
        rows += [(1, None, bucket, None, int(context[k]), sums[:, k].tolist(), None) for k in np.flatnonzero(hot_ones).tolist()]
        rows.append((2, None, bucket, None, None, None, _classes(total)))
        return pd.DataFrame(rows, columns=["kind", "block", "bucket", "answer", "context", "sums", "classes"]).astype({"context": "Int64"})

    asked = state.mapInPandas(ask, "bucket int, block string, question binary")
    return asked.groupBy("bucket").applyInPandas(answer, ANSWER)


def add_level(row: dict, answers: pd.DataFrame, size: int, buckets: int, hot: int, starts: int, hot_sums: tuple[np.ndarray, np.ndarray]) -> dict:
    """A block's row with the level of ``size`` words: counts and ids of its n-grams, sums of its contexts."""
    block = Block(row)
    told = {b: unpack_many(a) for b, a in zip(answers["bucket"], answers["answer"])}
    if size == 1:
        count, ids = np.zeros(len(block.words), np.int64), np.full(len(block.words), -1, np.int64)
        for u, places in _groups(word_bucket(block.words, buckets)):
            count[places], ids[places] = told[u]
        count[-1], ids[-1] = starts, START_ID
        level = [count, ids]
    else:
        pairs = Pairs(*block.grams(size - 1), block, size)
        count, ids = np.zeros(len(pairs.left), np.int64), np.full(len(pairs.left), -1, np.int64)
        sums = np.zeros((SUMS, len(pairs.context)), np.int64)
        frequent = pairs.context_count >= hot
        for u, mine, contexts in pairs.dealt(buckets, hot):
            count[mine], ids[mine], flat = told[u]
            calm = contexts[~frequent[contexts]]
            sums[:, calm] = flat.reshape(SUMS, len(calm))
        sums[:, frequent] = hot_sums[1][:, np.searchsorted(hot_sums[0], pairs.context[frequent])]
        level = [count, ids, sums.ravel()]
    levels = [*(row["levels"] if row["levels"] is not None else []), pack_many(level)]
    return {**row, "vocabulary": None, "seen": None, "levels": levels}


def told_blocks(state: DataFrame, answers: DataFrame, then, schema: str) -> DataFrame:
    """``then`` (a block's row, its answers) for every block."""
    def each(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return then(left.iloc[0].to_dict(), right)

    return state.groupBy("block").cogroup(answers.filter("kind = 0").select("block", "bucket", "answer").groupBy("block")).applyInPandas(each, schema)


def log_probabilities(block: Block, model: Unigram, discounts: list[Discounts]) -> np.ndarray:
    """log10 p(token | what precedes it) at every position, from the unigrams up (``discounts``: one a level, the unigrams' first)."""
    g, c = block.grams(1)
    p, below = model.p(c), np.full(len(c), float(model.below))
    for size in range(2, len(discounts) + 1):
        d, lower = discounts[size - 1], discounts[size - 2]
        pairs = Pairs(g, c, block, size)
        count, ids, sums = block.levels[size - 1]
        sums = sums.reshape(SUMS, len(pairs.context))
        r, total = np.arange(1, K + 1), sums[K + 1]
        kept = (r * d.d[1:]) @ sums[:K] + sums[K]
        shorter = (r * lower.d[1:]) @ sums[K + 2:2 * K + 2] + sums[2 * K + 2]
        under = np.where(total - kept > 1e-9 * total, total, total + 1).astype(float)
        at, of = pairs.at, pairs.of
        own = np.zeros(len(at), np.int64)
        own[pairs.asked] = count[pairs.back]
        alpha = (1 - kept / under)[of] / (1 - shorter[of] / below[at])
        p[at] = np.where(own > 0, d.discounted(own) / under[of], alpha * p[at])
        below[at] = under[of]
        c, g = np.zeros(len(g), np.int64), np.full(len(g), -1, np.int64)
        c[at[pairs.asked]], g[at[pairs.asked]] = count[pairs.back], ids[pairs.back]
    return np.log10(p)


def score_texts(docs: DataFrame, keep_out: int = 2, modulus: int = 7, order: int = ORDER, bucket_tokens: int = 750_000, hot: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per document."""
    spark, tables = docs.sparkSession, []
    slots = max(32, docs.rdd.getNumPartitions())

    def stored(df: DataFrame, name: str) -> DataFrame:
        """The next state as a table; the one before is dropped."""
        tables.append(bucketed(df, name, "block", slots))
        for old in tables[:-1]:
            spark.sql(f"DROP TABLE IF EXISTS {old}")
        return spark.table(tables[-1])

    try:
        first = token_blocks(docs, keep_out, modulus)
        state = stored(first.select("*", F.lit(None).cast("array<binary>").alias("levels")), "lm_blocks")
        tokens, starts = state.select(F.sum("n_tokens"), F.sum("n_train")).first()
        tokens, starts = tokens or 0, starts or 0
        hot = hot or max(500_000, tokens // 200_000)                # so that at most 200,000 contexts are frequent
        classes = lambda df: [int(x or 0) for x in df.filter("kind = 2").select(*[F.sum(F.col("classes")[i]) for i in range(K + 3)]).first()]
        discounts, model = [], None
        for size in range(1, order + 1):
            buckets = max(16, tokens // (4 * bucket_tokens)) if size == 1 else max(32, tokens // bucket_tokens)
            counted = word_counts(state, buckets) if size == 1 else ngram_counts(state, size, buckets, hot, size == order)
            answers = materialize(counted, f"lm-level-{size}")
            n = classes(answers)
            if size == 1:
                model = Unigram(n[:K + 1], n[K + 1], n[K + 2])
                discounts.append(model.discounts)
            else:
                discounts.append(Discounts(n[:K + 1]))
            frequent = answers.filter("kind = 1").groupBy("context").agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(SUMS)]).toPandas().sort_values("context")
            hot_sums = frequent["context"].to_numpy(np.int64), frequent.drop(columns="context").to_numpy(np.int64).T.copy()

            def grown(row, told, size=size, buckets=buckets, hot_sums=hot_sums):
                return add_level(row, told, size, buckets, hot, starts, hot_sums)

            if size < order:
                state = stored(told_blocks(state, answers, lambda row, told: pd.DataFrame({k: [v] for k, v in grown(row, told).items()}), STATE), f"lm_level_{size}")

        def evaluate(row, told):
            row = grown(row, told)
            block = Block(row)
            logs = log_probabilities(block, model, discounts)
            c = block.levels[0][0][block.word]
            base = np.log10(c + 1.0) - np.log10(model.tokens + model.types + 1.0)
            texts, inside = np.repeat(np.arange(len(block.sizes)), block.sizes), block.offset > 0
            add = lambda v: np.bincount(texts[inside], weights=v[inside], minlength=len(block.sizes))
            ids, missing = unpack_many(row["doc_ids"])
            return pd.DataFrame({"doc_id": pd.arrays.IntegerArray(ids, missing.astype(bool)), "held_out": unpack(row["train"], np.uint8) == 0,
                                 "n_tokens": block.sizes - 1, "n_known": add(c > 0).astype(np.int64), "train_tokens": model.tokens,
                                 "base_score": add(base), "score": add(logs)})

        return materialize(told_blocks(state, answers, evaluate, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                                                                 "base_score double, score double"), "lm-scores")
    finally:
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
