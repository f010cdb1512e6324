"""Histogram gradient boosting for a 0/1 target, leaf-wise, several models in one pass.

Inputs are binned once: a numeric input by up to 254 ascending edges (bin = number of
edges below the value, so "bin <= t" is "value <= edge t"), missing values in a bin of
their own, a category by its level.  The stored matrix is one byte an input, in blocks of rows.

A tree grows by best gain first up to ``leaves`` leaves and ``depth`` levels.
The gain of a node does not depend on the order in which others are split, so a
whole level is searched with one pass over the blocks and the best-first
choice is made afterwards among all nodes found.  A pass adds up gradients,
hessians and rows per (model, node, input, bin) in numpy; of two
children only the smaller is summed, the other is its parent minus it.
Histograms have a size that depends on nodes and inputs only; they meet by (model, node,
input) in parallel and the driver reads their sums.  Missing values go to the side
with the larger gain; a category splits off one level.

  gain = GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2),  leaf value = - rate * G / (H + l2)

Scores of rows are those stored with the blocks plus the trees since; they are
stored again every ``STORE`` rounds, and the blocks before them are removed.  Sums are added in the order of the tasks' first blocks, so reruns agree.
Folds: model k fits on the rows of the other folds, holds a part of them out (by
hash) and stops when its loss has not fallen for ``patience`` rounds.

Rows with a NULL target are left out.  A model whose rows are of one class or
too few stays at its start score, as does one without rows (score 0).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendlens.session import materialize, remove_stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 256
MISSING = 255                 # bin of a missing number, and of an unknown category
BLOCK_ROWS = 1 << 16
STORE = 2                       # a pass evaluates the trees since on every row: few of them
LEAST_HESSIAN = 1e-3
DRIVER_BYTES = 1 << 27        # histograms of single tasks that may meet on the driver


@dataclass
class Binning:
    """How columns become bytes: ascending edges of numbers, sorted levels of categories."""
    edges: dict[str, list[float]]
    levels: dict[str, list[str]] = field(default_factory=dict)

    def __post_init__(self):
        wide = [c for c, x in {**self.edges, **self.levels}.items() if len(x) > MISSING]
        if wide:
            raise ValueError(f"more than {MISSING} bins or levels: {wide}")

    @property
    def inputs(self) -> list[str]:
        return [*self.edges, *self.levels]

    def codes(self, columns: list[pa.Array]) -> np.ndarray:
        """Bytes (input, row)."""
        out = np.full((len(self.inputs), len(columns[0]) if columns else 0), MISSING, np.uint8)
        for k, edges in enumerate(self.edges.values()):
            v = columns[k].to_numpy(zero_copy_only=False).astype(float)
            known = ~np.isnan(v)
            out[k, known] = np.searchsorted(np.asarray(edges, float), v[known], "left")
        for k, levels in enumerate(self.levels.values(), len(self.edges)):
            place, seen = {x: i for i, x in enumerate(levels)}, columns[k].dictionary_encode("encode")
            at = np.array([place.get(x, MISSING) for x in seen.dictionary.to_pylist()], np.uint8)
            out[k] = at[seen.indices.to_numpy(zero_copy_only=False)] if len(at) else MISSING
        return out


def numeric_edges(df: DataFrame, columns: list[str], bins: int = 255, accuracy: int = 2_000) -> dict[str, list[float]]:
    """At most ``bins`` - 1 edges a column: its approximate quantiles without the largest value (one aggregate)."""
    share = [k / bins for k in range(1, bins + 1)]
    clean = {c: F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in columns}
    row = df.agg(*[F.percentile_approx(v, share, accuracy).alias(c) for c, v in clean.items()], *[F.max(v).alias(f"max {c}") for c, v in clean.items()]).first()
    return {c: [v for v in sorted(set(row[c] or [])) if v < row[f"max {c}"]][:bins - 1] for c in columns}


@dataclass
class Split:
    gain: float
    input: int
    at: int                   # bin (number: last one to the left; category: the level to the right)
    category: bool
    missing_left: bool
    left: np.ndarray          # G, H, rows
    right: np.ndarray


@dataclass
class Tree:
    """Nodes in arrays; node 0 is the root, ``left`` -1 marks a leaf."""
    input: list[int] = field(default_factory=lambda: [0])
    at: list[int] = field(default_factory=lambda: [0])
    category: list[bool] = field(default_factory=lambda: [False])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])

    def grow(self, node: int, s: Split) -> tuple[int, int]:
        n = len(self.input)
        self.input[node], self.at[node], self.category[node], self.missing_left[node] = s.input, s.at, s.category, s.missing_left
        self.left[node], self.right[node] = n, n + 1
        for x, v in ((self.input, 0), (self.at, 0), (self.category, False), (self.missing_left, False), (self.left, -1), (self.right, -1), (self.value, 0.0)):
            x += [v, v]
        return n, n + 1


def goes_left(code: np.ndarray, at: int, category: bool, missing_left: bool) -> np.ndarray:
    if category:
        return code != at
    return np.where(code == MISSING, missing_left, code <= at)


def rows_at(tree: Tree, codes: np.ndarray, rows: np.ndarray) -> dict[int, np.ndarray]:
    """Those of ``rows`` (columns of ``codes``) that end in each leaf, in the given order; every node looks only at its own rows."""
    at, out, every = {0: rows}, {}, np.arange(BINS)
    for node in range(len(tree.left)):                 # children come after their parents
        here = at.pop(node)
        if tree.left[node] < 0:
            out[node] = here
        else:
            side = goes_left(every, tree.at[node], tree.category[node], tree.missing_left[node])[codes[tree.input[node]].take(here)]
            at[tree.left[node]], at[tree.right[node]] = here[side], here[~side]
    return out


def leaf_of(tree: Tree, codes: np.ndarray) -> np.ndarray:
    """Leaf number of every row of ``codes`` (input, row)."""
    at = np.zeros(codes.shape[1], np.int32)
    for leaf, rows in rows_at(tree, codes, np.arange(codes.shape[1])).items():
        at[rows] = leaf
    return at


def best_split(hist: np.ndarray, categories: np.ndarray, l2: float, least_rows: int) -> Split | None:
    """Best split of a node from its histogram (input, bin, [G, H, rows]); ties go to the first input, bin, missing right."""
    total = hist[0].sum(0)
    if total[2] < 2 * least_rows:
        return None
    score = lambda s: s[..., 0] ** 2 / np.maximum(s[..., 1] + l2, 1e-300)
    missing = hist[:, MISSING:, :]
    upto = np.cumsum(hist[:, :MISSING], axis=1)
    lefts = np.stack([upto, upto + missing], axis=2)                       # (input, bin, missing side, 3)
    lefts[categories] = (total - hist[categories, :MISSING])[:, :, None]
    rights = total - lefts
    gain = score(lefts) + score(rights) - score(total)
    fits = (np.minimum(lefts[..., 2], rights[..., 2]) >= least_rows) & (np.minimum(lefts[..., 1], rights[..., 1]) >= LEAST_HESSIAN)
    fits[..., 1] &= (missing[:, :, 2] > 0) & ~categories[:, None]
    gain = np.where(fits, gain, -np.inf)
    # sums of doubles differ in their last digits: equal gains are those within 1e-10
    top = gain.max()
    if not top > 1e-12:
        return None
    k, b, m = np.argwhere(gain >= top * (1 - 1e-10))[0]
    return Split(float(gain[k, b, m]), int(k), int(b), bool(categories[k]), bool(m), lefts[k, b, m], rights[k, b, m])


@dataclass
class Boosted:
    binning: Binning
    start: float
    trees: list[Tree] = field(default_factory=list)
    losses: list[float] = field(default_factory=list)

    def raw(self, codes: np.ndarray, first: int = 0) -> np.ndarray:
        out = np.zeros(codes.shape[1])
        for tree in self.trees[first:]:
            for leaf, rows in rows_at(tree, codes, np.arange(len(out))).items():
                out[rows] += tree.value[leaf]
        return out


def blocks_of(df: DataFrame, binning: Binning, target: str, fold: Column, held: Column, models: int, starts: list[float]) -> DataFrame:
    """Stored blocks: name, codes (bytes, input by input), y, fold, held out, scores of all models."""
    rows = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in binning.edges], *[F.col(c).cast("string") for c in binning.levels],
                     F.col(target).cast("double").alias("y"), fold.cast("int").alias("fold"), held.cast("boolean").alias("held")).filter("y IS NOT NULL")
    width = len(binning.inputs)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, waiting, n = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            codes, y, folds, out = (np.concatenate(x, axis=-1) for x in zip(*waiting))
            scores = np.repeat(np.asarray(starts)[:, None], len(y), axis=1)
            return pa.RecordBatch.from_arrays(
                [pa.array([part * (1 << 32) + number]), *[pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())
                                                         for x in (codes, y.astype(np.uint8), folds.astype(np.uint8), out.astype(np.uint8), scores)]],
                names=["block", "codes", "y", "fold", "held", "scores"])

        for batch in batches:
            if not batch.num_rows:
                continue
            c = batch.columns
            waiting.append((binning.codes(c[:width]), *[x.to_numpy(zero_copy_only=False) for x in c[width:]]))
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield flush()
                number, waiting, n = number + 1, [], 0
        if waiting:
            yield flush()

    return rows.mapInArrow(build, "block bigint, codes binary, y binary, fold binary, held binary, scores binary")


def _arrays(row, width: int, models: int):
    y = np.frombuffer(row.y, np.uint8)
    return (np.frombuffer(row.codes, np.uint8).reshape(width, len(y)), y, np.frombuffer(row.fold, np.uint8),
            np.frombuffer(row.held, np.uint8).astype(bool), np.frombuffer(row.scores, np.float64).reshape(models, len(y)))


def histograms(blocks: DataFrame, models: list[Boosted], stored: int, growing: dict[int, Tree], wanted: dict[int, list[int]],
               tasks: int | None = None):
    """One pass: {(model, node): histogram} of the wanted nodes and {model: (held-out loss, rows)} of the scores.

    The loss is summed with the root or when no node is wanted.

    ``growing``: the unfinished tree of every model still fitted; ``stored``: rounds that the blocks' scores hold;
    ``tasks``: number of partitions of ``blocks`` if known.  The sums of few tasks are added on the driver
    (at most ``DRIVER_BYTES``), those of many in a shuffle, in the same order.
    """
    width, count = len(models[0].binning.inputs), len(models)

    def add(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, first = {}, None
        for pdf in pdfs:
            for row in pdf.itertuples():
                first = row.block if first is None else first
                codes, y, folds, held, scores = _arrays(row, width, count)
                for k, tree in growing.items():
                    mine = folds != k if count > 1 else np.ones(len(y), bool)
                    if held.any() and (0 in wanted[k] or not wanted[k]):
                        test = np.flatnonzero(mine & held)
                        raw = scores[k][test] + models[k].raw(codes.take(test, axis=1), stored)
                        loss = np.array([(np.logaddexp(0.0, raw) - y[test] * raw).sum(), len(test)])
                        sums[k, -1] = sums.get((k, -1), 0.0) + loss[None]
                    inside = rows_at(tree, codes, np.flatnonzero(mine & ~held)) if wanted[k] else {}
                    inside = {node: inside[node] for node in wanted[k] if len(inside.get(node, ()))}
                    if not inside:
                        continue
                    # all wanted nodes at once: the rows of the n-th count in bins of their own
                    rows, n = np.concatenate(list(inside.values())), len(inside)
                    place = np.repeat(np.arange(n) * BINS, [len(r) for r in inside.values()])
                    c = codes.take(rows, axis=1)
                    p = 1 / (1 + np.exp(-(scores[k][rows] + models[k].raw(c, stored))))
                    g, h, part = p - y[rows], p * (1 - p), np.empty((n, width, BINS, 3))
                    for f, code in enumerate(c):
                        at = place + code
                        for j, x in enumerate((g, h, None)):
                            part[:, f, :, j] = np.bincount(at, x, n * BINS).reshape(n, BINS)
                    for node, more in zip(inside, part):
                        sums[k, node] = sums.get((k, node), 0.0) + more
        # one row a task, node and input, whatever the number of its blocks
        out = [(first, k, node, f, np.ascontiguousarray(x).tobytes()) for (k, node), parts in sums.items() for f, x in enumerate(parts)]
        yield pd.DataFrame(out, columns=["block", "model", "node", "input", "sums"])

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(s) for s in pdf.sort_values("block")["sums"]], axis=0)
        return pd.DataFrame([(*pdf[["model", "node", "input"]].iloc[0], total.tobytes())], columns=["model", "node", "input", "sums"])

    parts = blocks.mapInPandas(add, "block bigint, model int, node int, input int, sums binary")
    hist, losses = {}, {}
    size = (tasks or 1 << 30) * sum(len(nodes) for nodes in wanted.values()) * width * BINS * 24
    if size <= DRIVER_BYTES:
        met: dict[tuple, np.ndarray] = {}
        told = parts.toArrow().sort_by("block")
        for *at, sums in zip(*(told[c].to_pylist() for c in ("model", "node", "input")), told["sums"]):
            met[tuple(at)] = met.get(tuple(at), 0.0) + np.frombuffer(sums.as_buffer())
    else:
        met = {(r["model"], r["node"], r["input"]): np.frombuffer(r["sums"]) for r in parts.groupBy("model", "node", "input").applyInPandas(
            meet, "model int, node int, input int, sums binary").collect()}
    for (model, node, place), sums in met.items():
        if node < 0:
            losses[model] = sums
        else:
            hist.setdefault((model, node), np.zeros((width, BINS, 3)))[place] = sums.reshape(BINS, 3)
    return hist, losses


def root_splits(df: DataFrame, binning: Binning, target: str, least_rows: int = 20, l2: float = 0.0) -> list[Split | None]:
    """The best split of every input over all rows, at the start score."""
    n, share = df.filter(F.col(target).isNotNull()).agg(F.count(F.lit(1)), F.avg(target)).first()
    share = min(max(share, 0.5 / n), 1 - 0.5 / n) if n else 0.5
    model = Boosted(binning, float(np.log(share / (1 - share))))
    blocks = blocks_of(df, binning, target, F.lit(0), F.lit(False), 1, [model.start])
    hist, _ = histograms(blocks, [model], 0, {0: Tree()}, {0: [0]})
    width, numbers = len(binning.inputs), len(binning.edges)
    held = hist.get((0, 0), np.zeros((width, BINS, 3)))
    return [best_split(held[k:k + 1], np.array([k >= numbers]), l2, least_rows) for k in range(width)]


def store_scores(blocks: DataFrame, models: list[Boosted], stored: int) -> DataFrame:
    width, count = len(models[0].binning.inputs), len(models)

    def apply(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            scores = []
            for row in pdf.itertuples():
                codes, *_, old = _arrays(row, width, count)
                scores.append(np.stack([old[k] + models[k].raw(codes, stored) for k in range(count)]).tobytes())
            yield pdf.assign(scores=scores)

    return materialize(blocks.mapInPandas(apply, blocks.schema), "boost-blocks")


class Grower:
    """Grows one tree of one model level by level, then takes the best splits first."""

    def __init__(self, categories: np.ndarray, leaves: int, depth: int, l2: float, least_rows: int, rate: float):
        self.categories, self.leaves, self.depth = categories, leaves, depth
        self.l2, self.least_rows, self.rate = l2, least_rows, rate
        self.full, self.splits, self.hist, self.sums = Tree(), {}, {}, {}
        self.level, self.open, self.smaller = 0, [0], {0: None}

    def wanted(self) -> list[int]:
        """Nodes to sum: the root, then the smaller child of every split node."""
        return list(self.smaller)

    def take(self, got: dict[int, np.ndarray]) -> bool:
        """Histograms of the wanted nodes; False when the tree is done."""
        width = len(self.categories)
        for node, pair in self.smaller.items():
            self.hist[node] = got.get(node, np.zeros((width, BINS, 3)))
            if pair is not None:
                parent, sibling = pair
                self.hist[sibling] = self.hist[parent] - self.hist[node]
                del self.hist[parent]
        self.smaller, found = {}, []
        if 0 in self.open:
            self.sums[0] = self.hist[0][0].sum(0)
        for node in self.open:
            s = best_split(self.hist[node], self.categories, self.l2, self.least_rows) if self.level < self.depth else None
            if s is None:
                del self.hist[node]
                continue
            self.splits[node] = s
            left, right = self.full.grow(node, s)
            self.sums[left], self.sums[right] = s.left, s.right
            small, large = (left, right) if s.left[2] <= s.right[2] else (right, left)
            self.smaller[small] = (node, large)
            found += [left, right]
        self.open, self.level = found, self.level + 1
        if self.level >= self.depth:                      # children of the last level are leaves
            self.open = []
        return bool(self.open)

    def tree(self) -> Tree:
        """The ``leaves`` - 1 best splits whose parents are split too."""
        out, names, open_ = Tree(), {0: 0}, [0]
        while open_ and len(out.left) < 2 * self.leaves - 1:
            ready = [n for n in open_ if n in self.splits]
            if not ready:
                break
            node = max(ready, key=lambda n: (self.splits[n].gain, -n))
            open_.remove(node)
            left, right = out.grow(names[node], self.splits[node])
            for old, new in ((self.full.left[node], left), (self.full.right[node], right)):
                names[old] = new
                open_.append(old)
        for old, new in names.items():
            if out.left[new] < 0 and out.left[0] >= 0:
                g, h, _ = self.sums[old]
                out.value[new] = float(-self.rate * g / (h + self.l2)) if h + self.l2 > 0 else 0.0
        return out


def fit_boosting(df: DataFrame, binning: Binning, target: str, rounds: int = 400, rate: float = 0.08, leaves: int = 31, depth: int = 6,
                 least_rows: int = 20, l2: float = 0.0, patience: int | None = 10, fold: Column | None = None, folds: int = 1,
                 held: Column | None = None) -> list[Boosted]:
    """``folds`` models (one: on all rows); with ``patience`` and ``held`` each keeps the rounds of its least held-out loss."""
    none = F.lit(False)
    stop = patience is not None and held is not None
    apart = held if stop else none
    fold = F.lit(0) if fold is None else fold
    folds_n = df.filter(F.col(target).isNotNull()).groupBy(fold.cast("int").alias("f")).agg(
        F.count(F.when(~apart, 1)).alias("n"), F.sum(F.when(~apart, F.col(target))).alias("pos")).collect()
    starts = []
    for k in range(folds):
        used = [r for r in folds_n if folds == 1 or r["f"] != k]
        n, pos = sum(r["n"] for r in used), sum(r["pos"] or 0 for r in used)
        share = min(max(pos / n, 0.5 / n), 1 - 0.5 / n) if n else 0.5
        starts.append(float(np.log(share / (1 - share))))
    models = [Boosted(binning, s) for s in starts]
    blocks = materialize(blocks_of(df, binning, target, fold, apart, folds, starts), "boost-blocks")
    categories = np.array([False] * len(binning.edges) + [True] * len(binning.levels))
    live, stored, tasks = set(range(folds)), 0, blocks.rdd.getNumPartitions()
    for r in range(rounds):
        if not live:
            break
        if r - stored >= STORE:
            before, blocks, stored = blocks, store_scores(blocks, models, stored), r
            remove_stored(before)
            tasks = blocks.rdd.getNumPartitions()
        growers = {k: Grower(categories, leaves, depth, l2, least_rows, rate) for k in live}
        active, first = set(live), True
        while active:
            hist, losses = histograms(blocks, models, stored, {k: growers[k].full for k in active}, {k: growers[k].wanted() for k in active}, tasks)
            if first and stop:
                for k in sorted(live):
                    loss, n = losses.get(k, (0.0, 0))
                    models[k].losses.append(loss / n if n else 0.0)
                    best = int(np.argmin(models[k].losses))
                    if n and len(models[k].losses) - 1 - best >= patience:
                        live.discard(k)
                        active.discard(k)
            first = False
            for k in sorted(active):
                if not growers[k].take({node: h for (m, node), h in hist.items() if m == k}):
                    active.discard(k)
        for k in sorted(live):
            tree = growers[k].tree()
            if tree.left[0] < 0:                          # nothing left to split
                live.discard(k)
            else:
                models[k].trees.append(tree)
        # a model that has stopped keeps its trees until the end: stored scores hold them
    if stop:
        if live:
            _, losses = histograms(blocks, models, stored, {k: Tree() for k in live}, {k: [] for k in live}, tasks)
            for k in live:
                loss, n = losses.get(k, (0.0, 0))
                models[k].losses.append(loss / n if n else 0.0)
        for m in models:
            m.trees = m.trees[:int(np.argmin(m.losses))] if m.losses else m.trees
    remove_stored(blocks)
    return models


def boosted_score(model: Boosted) -> Column:
    """Raw score (log odds) of a row with the input columns."""
    b = model.binning

    def score(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            codes = b.codes(list(columns))
            yield pa.array(model.start + model.raw(codes))

    args = [F.nanvl(F.col(c).cast("double"), F.lit(None)) for c in b.edges] + [F.col(c).cast("string") for c in b.levels]
    return F.arrow_udf(score, "double")(*args)
