"""Language identification with a bidirectional gated recurrent network over bytes.

The network (numpy, trained here by backpropagation through time) reads
segments of ``SEGMENT`` bytes (A-Z folded) in both directions: byte -> input gates by table
look-up, GRU state of ``HIDDEN`` units per direction, softmax over languages
at every byte.  A document's probabilities are the means over all its letter
positions (ASCII letters and bytes of non-ASCII characters), whole text.

Training reads a bounded sample of labelled rows: of every language at most
``per_language`` documents (smallest hash of id and text) and ``pieces``
segments of each.  The bound is a parameter and fits the model only; every
document is predicted over its whole text.  Every label of the training
rows is learned, the output layer has a column for each.  lang, source and doc_id never enter a prediction.

Defined cases: NULL text, or text without any letter, is ``und`` with score 0;
with no labelled training row every text is ``und``; NULL and empty labels
do not train; repeated rows train at most once (their hash is one) and are
predicted row by row; ties go to the first language in sorted order; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lendlens.llm import bytetext as B
from lendlens.llm import memory  # noqa: F401 (workers give freed memory back)
from lendlens.llm.common import column

UNDEFINED = "und"
HIDDEN, SEGMENT = 8, 48
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
F32 = np.float32


def _sigmoid(x):
    return F32(0.5) * np.tanh(F32(0.5) * x) + F32(0.5)


class Network:
    """Two GRU directions (input table ``x``, recurrent ``u``) and one output layer."""

    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.RandomState(seed)
        h, n = HIDDEN, len(languages)
        self.languages = languages
        self.p = {"out": rng.normal(0, 0.3, (2 * h, n)), "bias": np.zeros(n)}
        for d in "fb":
            self.p["x" + d] = rng.normal(0, 0.3, (256, 3 * h))
            self.p["u" + d] = rng.normal(0, 0.3, (h, 3 * h))
        self.p = {k: v.astype(F32) for k, v in self.p.items()}

    def run(self, codes: np.ndarray, d: str, trace: list | None = None) -> np.ndarray:
        """States (T, B, h) of one direction over ``codes`` (T, B), in reading order of that direction."""
        x, u, h = self.p["x" + d], self.p["u" + d], HIDDEN
        state = np.zeros((codes.shape[1], h), F32)
        out = np.empty((*codes.shape, h), F32)
        for t in range(len(codes)):
            given = x[codes[t]]
            rec = state @ u
            gates = _sigmoid(given[:, :2 * h] + rec[:, :2 * h])
            z, r = gates[:, :h], gates[:, h:]
            new = np.tanh(given[:, 2 * h:] + r * rec[:, 2 * h:])
            if trace is not None:
                trace.append((state, z, r, new, rec[:, 2 * h:]))
            state = new + z * (state - new)
            out[t] = state
        return out

    def add_logits(self, codes: np.ndarray, d: str, logits: np.ndarray) -> None:
        """Add one direction's share of the output to ``logits`` (T, languages, B); as ``run``, units by rows, in place."""
        h, width = HIDDEN, codes.shape[1]
        x, u = np.ascontiguousarray(self.p["x" + d].T), np.ascontiguousarray(self.p["u" + d].T)
        x[:2 * h] *= F32(0.5)                      # sigmoid(a) = (1 + tanh(a / 2)) / 2
        u[:2 * h] *= F32(0.5)
        out = np.ascontiguousarray((self.p["out"][:h] if d == "f" else self.p["out"][h:]).T)
        state, given, rec = np.zeros((h, width), F32), np.empty((3 * h, width), F32), np.empty((3 * h, width), F32)
        for t in range(len(codes)) if d == "f" else range(len(codes) - 1, -1, -1):
            np.take(x, codes[t], axis=1, out=given, mode="clip")
            np.matmul(u, state, out=rec)
            gates = given[:2 * h]
            gates += rec[:2 * h]
            np.tanh(gates, out=gates)
            gates += F32(1)
            gates *= F32(0.5)
            z, new = gates[:h], given[2 * h:]
            rec[2 * h:] *= gates[h:]
            new += rec[2 * h:]
            np.tanh(new, out=new)
            state -= new
            state *= z
            state += new
            logits[t] += out @ state

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        """Softmax (T, languages, B) at every position."""
        logits = np.empty((len(codes), len(self.languages), codes.shape[1]), F32)
        logits[:] = self.p["bias"][None, :, None]
        self.add_logits(codes, "f", logits)
        self.add_logits(codes, "b", logits)
        logits -= logits.max(1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(1, keepdims=True)
        return logits

    def gradients(self, codes: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over letter positions and its gradient, by backpropagation through time."""
        h, (steps, width) = HIDDEN, codes.shape
        traces = {"f": [], "b": []}
        states = {"f": self.run(codes, "f", traces["f"]), "b": self.run(codes[::-1], "b", traces["b"])}
        both = np.concatenate([states["f"], states["b"][::-1]], -1)
        logits = both @ self.p["out"] + self.p["bias"]
        logits -= logits.max(-1, keepdims=True)
        prob = np.exp(logits)
        prob /= prob.sum(-1, keepdims=True)
        mask = LETTER[codes].astype(F32) / max(int(LETTER[codes].sum()), 1)
        t, b = np.indices(codes.shape)
        loss = float(-(np.log(prob[t, b, labels[None, :]] + 1e-9) * mask).sum())
        prob[t, b, labels[None, :]] -= 1
        prob *= mask[:, :, None]
        g = {"out": both.reshape(-1, 2 * h).T @ prob.reshape(-1, prob.shape[-1]), "bias": prob.sum((0, 1))}
        into = prob @ self.p["out"].T
        for d, seen, d_state in (("f", codes, into[:, :, :h]), ("b", codes[::-1], into[::-1, :, h:])):
            u, gx, gu = self.p["u" + d], np.zeros((256, 3 * h), F32), np.zeros((h, 3 * h), F32)
            back = np.zeros((width, h), F32)
            for k in range(steps - 1, -1, -1):
                before, z, r, new, rec = traces[d][k]
                total = d_state[k] + back
                d_new = total * (1 - z) * (1 - new * new)
                d_gate = np.concatenate([total * (before - new) * z * (1 - z), d_new * rec * r * (1 - r)], 1)
                d_rec = np.concatenate([d_gate, d_new * r], 1)
                np.add.at(gx, seen[k], np.concatenate([d_gate, d_new], 1))
                gu += before.T @ d_rec
                back = total * z + d_rec @ u.T
            g["x" + d], g["u" + d] = gx, gu
        return loss, g

    def fit(self, codes: np.ndarray, labels: np.ndarray, steps: int, batch: int = 128, rate: float = 0.02, seed: int = 11):
        """Adam over shuffled batches; ``codes`` (segments, SEGMENT)."""
        rng = np.random.RandomState(seed)
        first, second = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        for i in range(1, steps + 1):
            pick = rng.randint(0, len(labels), min(batch, len(labels)))
            _, g = self.gradients(codes[pick].T, labels[pick])
            pace = rate * min(1.0, 2.0 * (1 - i / (steps + 1)))
            for k, v in self.p.items():
                first[k] += 0.1 * (g[k] - first[k])
                second[k] += 0.01 * (g[k] ** 2 - second[k])
                v -= (pace * (first[k] / (1 - 0.9 ** i)) / (np.sqrt(second[k] / (1 - 0.99 ** i)) + 1e-7)).astype(F32)
        return self


def training_rows(docs: DataFrame, hold_out: int, modulus: int, per_language: int, pieces: int):
    """(languages, segment texts, labels): a bounded, repeatable sample of the labelled training rows."""
    doc_id, text, lang = column(docs, "doc_id", "long"), column(docs, "text", "string"), column(docs, "lang", "string")
    rest = F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
    rows = docs.select(lang.alias("lang"), text.alias("text"), rest.alias("rest"), F.xxhash64(doc_id, text).alias("h")).filter(
        (F.col("rest") != hold_out) & (F.col("lang") != "") & F.col("text").rlike("\\p{L}"))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    languages = sorted(r["lang"] for r in counts)
    if not languages:
        return [], [], []
    # a threshold on the hash keeps about twice the sample of each language; the exact cut follows below
    scale = 1 << 20
    below = docs.sparkSession.createDataFrame(pa.table({
        "lang": pa.array([r["lang"] for r in counts], pa.string()),
        "below": pa.array([min(scale, 2 * scale * per_language // r["n"] + 64) for r in counts], pa.int64())}))
    at = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)),
                     lambda k: F.substring(F.col("text"), (F.pmod(F.xxhash64("h", k), F.greatest(F.length("text") - SEGMENT, F.lit(1))) + 1).cast("int"), F.lit(SEGMENT)))
    near = rows.join(F.broadcast(below), "lang").filter(F.pmod("h", F.lit(scale)) < F.col("below")).select("lang", "h", at.alias("segments"))
    # repeated rows count once; the rank cuts every language at its own size
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    sample = near.groupBy("lang", "h").agg(F.min("segments").alias("segments")).withColumn("rank", rank).filter(F.col("rank") <= per_language)
    texts, labels = [], []
    index = {lang: k for k, lang in enumerate(languages)}
    for r in sample.orderBy("lang", "h").collect():
        texts += r["segments"]
        labels += [index[r["lang"]]] * len(r["segments"])
    return languages, texts, labels


def train(docs: DataFrame, hold_out: int = 0, modulus: int = 5, per_language: int = 400, pieces: int = 4,
          steps: int = 400) -> Network | None:
    languages, texts, labels = training_rows(docs, hold_out, modulus, per_language, pieces)
    if not languages or not texts:
        return None
    raw = [np.frombuffer(t.encode()[:SEGMENT].ljust(SEGMENT, b" "), np.uint8) for t in texts]
    return Network(languages).fit(B.FOLD[np.stack(raw)], np.array(labels), steps)


def pooled(network: Network, data: np.ndarray, offsets: np.ndarray, width: int = 2048) -> np.ndarray:
    """Mean language probabilities over the letter positions of each text (rows of zeros without letters)."""
    sizes = np.diff(offsets)
    width = max(16, min(width, width * 64 // len(network.languages)))          # many languages: fewer segments at once
    segments = -(-sizes // SEGMENT)
    owner = np.repeat(np.arange(len(sizes)), segments)
    start = offsets[:-1][owner] + SEGMENT * (np.arange(len(owner)) - np.repeat(np.cumsum(segments) - segments, segments))
    stop = np.minimum(start + SEGMENT, offsets[1:][owner])
    sums = np.zeros((len(sizes), len(network.languages)))
    letters = np.zeros(len(sizes))
    steps = np.arange(SEGMENT)[:, None]
    for lo in range(0, len(owner), width):
        at = start[None, lo:lo + width] + steps
        inside = at < stop[None, lo:lo + width]
        codes = np.where(inside, B.FOLD[data[np.minimum(at, len(data) - 1)]], np.uint8(32))
        mask = (LETTER[codes] & inside).astype(F32)
        pool = np.einsum("tnb,tb->bn", network.probabilities(codes), mask)
        np.add.at(sums, owner[lo:lo + width], pool)
        np.add.at(letters, owner[lo:lo + width], mask.sum(0))
    return sums / np.maximum(letters, 1)[:, None]


def predicted(docs: DataFrame, network: Network) -> DataFrame:
    """(row: the columns of ``docs`` as a struct, lang_pred, score); only the texts leave the JVM, once."""
    shared = docs.sparkSession.sparkContext.broadcast(network)

    def label(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        net = shared.value
        for texts in columns:
            data, offsets = B.texts_of(texts)
            names, scores = [], []
            for lo, hi in B.split_rows(offsets, 1 << 22):
                part = pooled(net, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                top = part.argmax(1)
                some = part.sum(1) > 0
                names += [net.languages[k] if s else UNDEFINED for k, s in zip(top.tolist(), some.tolist())]
                scores.append(np.where(some, np.minimum(part.max(1), 1.0), 0.0))
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(np.concatenate(scores) if scores else np.zeros(0))], ["lang_pred", "score"])

    told = F.arrow_udf(label, "lang_pred string, score double").asNondeterministic()
    text = column(docs, "text", "string")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), told(F.when(text.rlike("\\p{L}"), text)).alias("told"))
    return rows.select("row", "told.lang_pred", "told.score")


def predict(docs: DataFrame, network: Network | None, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with lang_pred and score."""
    if network is None:
        return docs.select(*keep, F.lit(UNDEFINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    return predicted(docs, network).select(*[F.col("row")[c].alias(c) for c in keep], "lang_pred", "score")


def identify(docs: DataFrame, hold_out: int = 0, modulus: int = 5) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per document."""
    network = train(docs, hold_out, modulus)
    doc_id = column(docs, "doc_id", "long")
    rest = F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
    rows = docs.select(doc_id.alias("doc_id"), (rest == hold_out).alias("held_out"), column(docs, "text", "string").alias("text"))
    return predict(rows, network, ["doc_id", "held_out"])
