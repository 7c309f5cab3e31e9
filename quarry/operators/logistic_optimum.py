"""Optimality of one-vs-rest logistic regression.

The objective of a class is the mean logistic loss of "this label or another"
plus ``reg / 2`` times the squared weights (the intercept is free), as MLlib
minimises it without standardization. One pass over the rows adds up loss,
gradient and Hessian of every class at given weights, in the blocks that
``fold_statistics`` adds up side by side. From these follow Newton steps to the optimum,
and so how far a fit is from it.

A task holds the Hessians of as many classes as fit ``TASK_BYTES`` (more classes
take more passes), the driver those of all classes, ``(d + 1) ** 2`` numbers
each: d must stay in the low thousands, like for a PCA.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import OneVsRestModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.fold_statistics import MOMENTS, SALTS, moment_blocks, project, summed_moments

# The functions below run in Python workers that may not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TASK_BYTES = 64 << 20


@dataclass(frozen=True)
class Fit:
    """One class: weights (the intercept last), and objective, gradient and Hessian there."""

    label: int
    n: int
    weights: np.ndarray
    loss: float
    gradient: np.ndarray
    hessian: np.ndarray

    def slope(self) -> float:
        """Greatest entry of the gradient."""
        return float(np.abs(self.gradient).max())

    def better_than(self, other: Fit) -> bool:
        """Lower, or as low (to rounding) with less slope."""
        return self.loss < other.loss or (self.loss <= other.loss + 1e-12 * abs(other.loss) and self.slope() < other.slope())


def _add_losses(labels: Sequence[int], weights: np.ndarray, first: int):
    """Sums of a task: the gradient, the loss in one more place, and the Hessian."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, d = weights.shape
        n, salt = 0, 0
        sums, hessians = np.zeros((k, d + 1)), np.zeros((k, d + 1, d + 1))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            label = batch.column("label").to_numpy(zero_copy_only=False)
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            x = np.hstack([x, np.ones((batch.num_rows, 1))])
            salt = int(batch.column("salt")[0].as_py())
            n += batch.num_rows
            for c in range(k):
                side = np.where(label == labels[c], 1.0, -1.0)
                margin = side * (x @ weights[c])
                wrong = np.exp(-np.logaddexp(0, margin))
                sums[c, :d] -= x.T @ (side * wrong)
                sums[c, d] += np.logaddexp(0, -margin).sum()
                hessians[c, :d, :d] += (x * (wrong * (1 - wrong))[:, None]).T @ x
        if n:
            for c in range(k):
                yield from moment_blocks(first + c, n, sums[c], hessians[c], salt)

    return run


def _usable(df: DataFrame, vec_col: str, label_col: str) -> DataFrame:
    rows = df.select(F.col(label_col).cast("int").alias("label"), F.col(vec_col).cast("array<double>").alias("x"))
    return rows.where(F.col("label").isNotNull() & F.col("x").isNotNull())


def losses_at(df: DataFrame, weights: dict[int, np.ndarray], reg: float, vec_col: str = "vec", label_col: str = "label") -> list[Fit]:
    """Objective, gradient and Hessian of each label at its weights, the
    intercept last, ordered by label. Rows without label or vector are left
    out; without rows there are no fits."""
    rows = _usable(df, vec_col, label_col).withColumn("salt", (F.spark_partition_id() % SALTS).cast("int"))
    labels = sorted(weights)
    found = []
    d = len(weights[labels[0]]) if labels else 0
    at_once = max(1, TASK_BYTES // (8 * (d + 1) ** 2))
    for first in range(0, len(labels), at_once):
        part = labels[first: first + at_once]
        task = _add_losses(part, np.array([weights[c] for c in part]), first)
        for c, m in summed_moments(rows.mapInArrow(task, MOMENTS), np.zeros(d + 1)).items():
            w = weights[labels[c]]
            shrunk = np.append(w[:-1], 0.0)
            hessian = m.gram[:d, :d] / m.n + reg * np.diag(np.append(np.ones(d - 1), 0.0))
            found.append(Fit(labels[c], m.n, w, float(m.sums[d] / m.n + reg / 2 * shrunk @ shrunk), m.sums[:d] / m.n + reg * shrunk, hessian))
    return sorted(found, key=lambda f: f.label)


def optimum(df: DataFrame, weights: dict[int, np.ndarray], reg: float, vec_col: str = "vec", label_col: str = "label",
            tol: float = 1e-12, max_passes: int = 100) -> list[Fit]:
    """Newton steps from ``weights``, or from zeros where these are better, until
    no entry of any gradient exceeds ``tol``. Where a Newton step does not help,
    the next step divides by the Hessian at zeros, which no other exceeds, so that
    it always leads down. Raises if ``max_passes`` passes over the rows do not get
    there, as with classes that can be told apart entirely and ``reg`` 0."""
    zeros = losses_at(df, {c: np.zeros_like(w, dtype=np.float64) for c, w in weights.items()}, reg, vec_col, label_col)
    given = losses_at(df, weights, reg, vec_col, label_col)
    best = {f.label: min(f, z, key=lambda one: one.loss) for f, z in zip(given, zeros)}
    steepest = zeros[0].hessian if zeros else None
    newton = dict.fromkeys(best, True)
    for _ in range(max_passes):
        left = [f for f in best.values() if f.slope() > tol]
        if not left:
            return [best[c] for c in sorted(best)]
        # of least norm where the matrix is singular
        tried = {f.label: f.weights - np.linalg.lstsq(f.hessian if newton[f.label] else steepest, f.gradient, rcond=None)[0] for f in left}
        for f in losses_at(df, tried, reg, vec_col, label_col):
            newton[f.label] = f.better_than(best[f.label])
            if newton[f.label]:
                best[f.label] = f
    raise ValueError(f"no optimum within {max_passes} passes: slope {max(f.slope() for f in best.values())}")


def fitted_weights(model: OneVsRestModel) -> dict[int, np.ndarray]:
    """Weights of each label of an MLlib one-vs-rest fit, the intercept last."""
    return {c: np.append(m.coefficients.toArray(), m.intercept) for c, m in enumerate(model.models)}


def predict(df: DataFrame, fits: Sequence[Fit], vec_col: str = "vec", output: str = "predicted") -> DataFrame:
    """``df`` with the label of the greatest margin instead of the vector
    (of equal margins the smallest label). Rows without a vector are left out."""
    if not fits:
        raise ValueError("no fits to predict from")
    margins = project(df, vec_col, np.array([f.weights[:-1] for f in fits]).T)
    free = F.array(*(F.lit(float(f.weights[-1])) for f in fits))
    margin = F.zip_with(vec_col, free, lambda a, b: a + b)
    labels = F.array(*(F.lit(f.label) for f in fits))
    return margins.withColumn(vec_col, margin).select(
        *(c for c in df.columns if c != vec_col), F.get(labels, F.array_position(vec_col, F.array_max(vec_col)).cast("int") - 1).alias(output))
