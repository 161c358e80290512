"""Softmax regression fitted step by step, with a validation curve.

Each step is one pass over the rows: a task adds up gradient, loss and hits of
its Arrow batches in NumPy and gives one row of sums; these rows are added in
a tree of two levels (about the square root of the tasks, then one; a few tasks
at once), so that no task and not the driver takes in a row of every task of a
large cluster. The driver holds the
weights (classes x features), moves them, and sends them with the next step.
Training rows give gradient and training loss, validation rows their loss and
accuracy; the weights of the step with the smallest validation loss are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lookout.operators.scoring import LinearModel
from lookout.session import prepare

# Probabilities are clipped so before the logarithm, as in the loss of a table.
EPSILON = 1e-7
# Up to the square of so many tasks one level adds all their sums.
FEW = 8
# Sums before the gradient: training weight and loss, validation rows, loss, hits.
HEAD = 5


class Step(NamedTuple):
    step: int
    train_loss: float
    val_loss: float | None
    val_accuracy: float | None


class Fit(NamedTuple):
    model: LinearModel
    curve: list[Step]
    best: int


def _vectors(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _partial(weights: np.ndarray, bias: np.ndarray):
    """One row of sums for each task."""
    k, d = weights.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, grad = np.zeros(HEAD), np.zeros((k, d + 1))
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _vectors(batch.column(0)), batch.column(1).to_numpy()
            w, val = batch.column(2).to_numpy(), batch.column(3).to_numpy(zero_copy_only=False)
            s = x @ weights.T + bias
            p = np.exp(s - s.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            loss = -np.log(np.clip(p[np.arange(len(y)), y], EPSILON, 1 - EPSILON))
            head += [
                w[~val].sum(),
                (w * loss)[~val].sum(),
                val.sum(),
                loss[val].sum(),
                (s[val].argmax(axis=1) == y[val]).sum(),
            ]
            p[np.arange(len(y)), y] -= 1.0
            off = (p * w[:, None])[~val]
            grad[:, :d] += off.T @ x[~val]
            grad[:, d] += off.sum(axis=0)
        yield _row(np.concatenate([head, grad.reshape(-1)]))

    return run


def _row(sums: np.ndarray) -> pa.RecordBatch:
    flat = pa.array(sums)
    return pa.RecordBatch.from_arrays(
        [pa.ListArray.from_arrays(pa.array([0, len(sums)], pa.int32()), flat)], names=["sums"]
    )


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            some = _vectors(batch.column(0)).sum(axis=0)
            total = some if total is None else total + some
    if total is not None:
        yield _row(total)


def _sums(data: DataFrame, weights: np.ndarray, bias: np.ndarray, fan: int) -> np.ndarray:
    sums = data.mapInArrow(_partial(weights, bias), "sums array<double>")
    if fan > FEW:
        sums = sums.repartition(fan).mapInArrow(_add, "sums array<double>")
    return np.array(sums.repartition(1).mapInArrow(_add, "sums array<double>").first()[0])


def fit_softmax(
    train: DataFrame,
    val: DataFrame,
    vec_col: str,
    label_col: str = "label",
    weight_col: str | None = None,
    k: int = 10,
    steps: int = 20,
    rate: float = 1.0,
) -> Fit:
    """Weights of the softmax head after ``steps`` gradient steps over all of
    ``train``, from zero. Rows without a vector or with a label outside
    0..k-1 take no part; all vectors have one length. ``curve[s]`` has the
    losses after ``s`` steps (the validation ones None without validation
    rows; then the last step counts as the best)."""
    prepare(train.sparkSession)

    def narrow(df: DataFrame, is_val: bool) -> DataFrame:
        weight = F.col(weight_col) if weight_col and not is_val else F.lit(1.0)
        rows = df.select(
            F.col(vec_col).alias("v"),
            F.col(label_col).cast("long").alias("y"),
            weight.cast("double").alias("w"),
            F.lit(is_val).alias("val"),
        )
        return rows.where(F.col("v").isNotNull() & F.col("w").isNotNull() & F.col("y").between(0, k - 1))

    data = narrow(train, False).unionByName(narrow(val, True)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        first = data.where(~F.col("val")).select(F.size("v")).first()
        if first is None:
            raise ValueError("there are no training rows")
        d = int(first[0])
        fan = 1 + math.isqrt(data.rdd.getNumPartitions())
        weights, bias = np.zeros((k, d)), np.zeros(k)
        curve: list[Step] = []
        best = (math.inf, 0, weights, bias)
        for step in range(steps + 1):
            sums = _sums(data, weights, bias, fan)
            total, loss, rows, val_loss, hits = sums[:HEAD].tolist()
            seen = (val_loss / rows, hits / rows) if rows else (None, None)
            curve.append(Step(step, loss / total, *seen))
            if not rows or seen[0] < best[0]:
                best = (seen[0] if rows else math.inf, step, weights, bias)
            grad = sums[HEAD:].reshape(k, d + 1) / total
            weights, bias = weights - rate * grad[:, :d], bias - rate * grad[:, d]
        return Fit(LinearModel(best[2], best[3]), curve, best[1])
    finally:
        data.unpersist()
