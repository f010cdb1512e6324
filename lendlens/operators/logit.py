"""L2 logistic regression by Newton steps with distributed Gram and gradient sums.

Minimises  sum_i log(1 + exp(-s_i (b + w x_i))) + ridge / 2 * |w|^2  (s = +-1, the
intercept b is not penalised; ridge = 1 / C).  A step is one aggregate: every
task adds up its loss, gradient X'(p - y) and Gram matrix X' diag(p (1 - p)) X
with numpy, the sums meet by position in the JVM with partial aggregation, and
the driver solves one (d + 1) x (d + 1) system.  A step that does not
lower the loss is halved.  Six to eight passes reach a gradient of rounding size.

Rows with a NULL label or input are left out.  With one class only the intercept
has no finite optimum: the fit stops after ``max_steps`` and says so (``converged``).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# functions of this module travel by value: workers need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class LogitModel:
    coefficients: np.ndarray      # intercept first
    gradient: np.ndarray          # penalised gradient at the coefficients
    loss: float
    steps: int
    converged: bool


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of an array<double> column with a leading 1."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.column_stack([np.ones(n), flat.reshape(n, -1)]) if n else np.zeros((0, 1))


def _loss_sums(X: np.ndarray, y: np.ndarray, beta: np.ndarray) -> np.ndarray:
    """Loss, gradient and upper triangle of the Gram matrix of some rows, one after the other."""
    z = X @ beta
    p = 1.0 / (1.0 + np.exp(-z))
    loss = np.logaddexp(0.0, z).sum() - y @ z
    gram = (X * (p * (1 - p))[:, None]).T @ X
    return np.concatenate([[loss], X.T @ (p - y), gram[np.triu_indices(len(beta))]])


def _pass(rows: DataFrame, beta: np.ndarray) -> np.ndarray:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = _loss_sums(_matrix(batch.column(0)), batch.column(1).to_numpy(zero_copy_only=False), beta)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total])], names=["sums"])

    sums = rows.mapInArrow(add, "sums array<double>").select(F.posexplode("sums").alias("at", "v"))
    out = np.zeros(1 + len(beta) + len(beta) * (len(beta) + 1) // 2)
    for r in sums.groupBy("at").agg(F.sum("v").alias("v")).collect():      # its length depends on the number of inputs only
        out[r["at"]] = r["v"]
    return out


def fit_logit(df: DataFrame, x: str, y: str, ridge: float = 1.0, max_steps: int = 50, tolerance: float = 1e-9) -> LogitModel:
    """Fit on the array<double> column ``x`` and the 0/1 column ``y``; ``df`` should be stored, it is read once a step."""
    rows = df.select(F.col(x).alias("x"), F.col(y).cast("double").alias("y")).filter("x IS NOT NULL AND y IS NOT NULL")
    first = rows.agg(F.max(F.size("x")).alias("d"), F.count(F.lit(1)).alias("n"), F.avg("y").alias("rate")).first()
    d, n, rate = first["d"] or 0, first["n"], first["rate"]
    beta = np.zeros(d + 1)
    if n == 0:
        return LogitModel(beta, beta, 0.0, 0, False)
    share = min(max(rate, 0.5 / n), 1 - 0.5 / n)
    beta[0] = np.log(share / (1 - share))
    penalty = np.full(d + 1, ridge)
    penalty[0] = 0.0
    before, best = None, np.inf
    for step in range(1, max_steps + 1):
        sums = _pass(rows, beta)
        loss = sums[0] + 0.5 * penalty @ beta ** 2
        if before is not None and loss > best + 1e-12 * abs(best):
            if np.abs(beta - before).max() < 1e-12:
                return LogitModel(before, gradient, best, step, True)  # noqa: F821 (set with ``before``)
            beta = (beta + before) / 2
            continue
        best, gradient = loss, sums[1:d + 2] + penalty * beta
        gram = np.zeros((d + 1, d + 1))
        gram[np.triu_indices(d + 1)] = sums[d + 2:]
        gram = gram + np.triu(gram, 1).T + np.diag(penalty)
        if np.abs(gradient).max() <= tolerance * max(1.0, n ** 0.5):
            return LogitModel(beta, gradient, loss, step, True)
        before = beta
        beta = beta - np.linalg.lstsq(gram, gradient, rcond=None)[0]
    return LogitModel(before, gradient, best, max_steps, False)


def logit_probability(model: LogitModel, x: str) -> Column:
    """P(y = 1) for the array column ``x``."""
    beta = model.coefficients

    def score(rows: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in rows:
            yield pa.array(1.0 / (1.0 + np.exp(-(_matrix(column) @ beta))) if len(column) else np.zeros(0))

    return F.arrow_udf(score, "double")(x)


def logit_gradient(df: DataFrame, x: str, y: str, model: LogitModel, ridge: float = 1.0) -> np.ndarray:
    """Penalised gradient of ``model`` on other rows (or the same ones, as a check)."""
    rows = df.select(F.col(x).alias("x"), F.col(y).cast("double").alias("y")).filter("x IS NOT NULL AND y IS NOT NULL")
    d = len(model.coefficients)
    return _pass(rows, model.coefficients)[1:d + 1] + np.r_[0.0, np.full(d - 1, ridge)] * model.coefficients
