"""Moments of every cross-validation fold from one pass over the features.

A fit on all folds but one needs the rows of the others only through their
number, sums and Gramian, and those are the totals less the held-out fold's. So
one pass adds up the moments of each fold, and the covariance and PCA of every
training set follow by subtraction, where a fit per fold reads nearly all rows
as many times as there are folds.

A task sorts its rows by fold and holds one Gramian at a time. Gramians travel
in blocks of ``BLOCK`` columns and are added up side by side, first the tasks of
a salt, then the salts, as a stream: memory is one block. The driver holds the
totals and the folds' moments (``(folds + 1) * d * d`` numbers), like MLlib's own
PCA, which decomposes one such matrix there.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The functions below run in Python workers that may not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 256
SALTS = 32
MOMENTS = "fold int, i int, j int, salt int, n long, sums array<double>, cells array<double>"
_SCHEMA = pa.schema([("fold", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("salt", pa.int32()), ("n", pa.int64()),
                     ("sums", pa.list_(pa.float64())), ("cells", pa.list_(pa.float64()))])


def moment_blocks(fold: int, n: int, sums: np.ndarray, gram: np.ndarray, salt: int) -> Iterator[pa.RecordBatch]:
    """Upper blocks of a Gramian, the sums with those of the diagonal."""
    d = len(sums)
    for i in range(0, d, BLOCK):
        for j in range(i, d, BLOCK):
            own = sums[i: i + BLOCK] if i == j else sums[:0]
            yield pa.RecordBatch.from_pylist([{"fold": fold, "i": i, "j": j, "salt": salt, "n": n, "sums": own, "cells": gram[i: i + BLOCK, j: j + BLOCK].ravel()}], _SCHEMA)


def _gather(centre: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, n, salt = None, 0, 0
        sums, gram = np.zeros(len(centre)), np.zeros((len(centre), len(centre)))
        for batch in batches:
            if batch.num_rows == 0:
                continue
            folds = batch.column("fold").to_numpy(zero_copy_only=False)
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(folds), -1) - centre
            salt = int(batch.column("salt")[0].as_py())
            cuts = [0, *(np.flatnonzero(folds[1:] != folds[:-1]) + 1).tolist(), len(folds)]
            for a, b in zip(cuts, cuts[1:]):
                if n and folds[a] != fold:
                    yield from moment_blocks(fold, n, sums, gram, salt)
                    n, sums, gram = 0, np.zeros_like(sums), np.zeros_like(gram)
                fold = int(folds[a])
                n += b - a
                sums += x[a:b].sum(axis=0)
                gram += x[a:b].T @ x[a:b]
        if n:
            yield from moment_blocks(fold, n, sums, gram, salt)

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up neighbouring rows of one key."""
    held: dict | None = None
    for batch in batches:
        for r in batch.to_pylist():
            row = r | {c: np.array(r[c]) for c in ("sums", "cells")}
            if held and all(held[c] == row[c] for c in ("fold", "i", "j", "salt")):
                held["n"] += row["n"]
                held["sums"] += row["sums"]
                held["cells"] += row["cells"]
                continue
            if held:
                yield pa.RecordBatch.from_pylist([held], _SCHEMA)
            held = row
    if held:
        yield pa.RecordBatch.from_pylist([held], _SCHEMA)


@dataclass(frozen=True)
class Moments:
    """Number, sums and Gramian of some rows, all less ``centre``."""

    n: int
    sums: np.ndarray
    gram: np.ndarray
    centre: np.ndarray

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.n - other.n, self.sums - other.sums, self.gram - other.gram, self.centre)

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.n + other.n, self.sums + other.sums, self.gram + other.gram, self.centre)

    def mean(self) -> np.ndarray:
        return self.centre + self.sums / self.n

    def covariance(self) -> np.ndarray:
        """Sample covariance (NaN for under two rows)."""
        if self.n < 2:
            return np.full_like(self.gram, np.nan)
        return (self.gram - np.outer(self.sums, self.sums) / self.n) / (self.n - 1)

    def components(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` principal directions (columns, the largest entry of each
        positive) and their variances, greatest first."""
        values, vectors = np.linalg.eigh(self.covariance())
        values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
        sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
        return vectors * np.where(sign == 0, 1, sign), values


def summed_moments(parts: DataFrame, centre: np.ndarray) -> dict[int | None, Moments]:
    """Blocks of all tasks added up per fold, first the tasks of a salt."""
    for keys in (["fold", "i", "j", "salt"], ["fold", "i", "j"]):
        dealt = parts.withColumn("salt", F.lit(0)) if len(keys) == 3 else parts
        parts = dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_add, MOMENTS)
    d = len(centre)
    found: dict[int | None, Moments] = {}
    for r in parts.toLocalIterator():
        m = found.setdefault(None if r["fold"] < 0 else r["fold"], Moments(r["n"], np.zeros(d), np.zeros((d, d)), centre))
        i, j = r["i"], r["j"]
        cells = np.array(r["cells"]).reshape(min(BLOCK, d - i), min(BLOCK, d - j))
        m.gram[i: i + BLOCK, j: j + BLOCK] = cells
        m.gram[j: j + BLOCK, i: i + BLOCK] = cells.T
        if i == j:
            m.sums[i: i + BLOCK] = r["sums"]
    return found


def fold_moments(df: DataFrame, vec_col: str, fold_col: str = "fold") -> dict[int | None, Moments]:
    """Moments of each fold, from one pass over ``vec_col`` (arrays of one
    length). Rows without a fold are under None: they are never held out.
    Null vectors are left out; an empty table gives an empty result.
    """
    rows = df.where(F.col(vec_col).isNotNull()).select(F.coalesce(F.col(fold_col).cast("int"), F.lit(-1)).alias("fold"), F.col(vec_col).cast("array<double>").alias("x"))
    one = rows.select("x").first()  # near the data, so that squares do not swallow small variances
    if one is None:
        return {}
    centre = np.array(one["x"], dtype=np.float64)
    salted = rows.sortWithinPartitions("fold").withColumn("salt", (F.spark_partition_id() % SALTS).cast("int"))
    return summed_moments(salted.mapInArrow(_gather(centre), MOMENTS), centre)


def training_moments(folds: dict[int | None, Moments]) -> dict[int, Moments]:
    """Moments of all rows outside each fold: the totals less the fold's."""
    if not folds:
        return {}
    own = list(folds.values())
    total = sum(own[1:], own[0])
    return {i: total - m for i, m in sorted((i, m) for i, m in folds.items() if i is not None)}


def _times(vec_col: str, matrix: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(vec_col).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)
            flat = pa.array((x @ matrix).ravel())
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * matrix.shape[1])
            at = batch.schema.get_field_index(vec_col)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, flat) if c == at else batch.column(c) for c in range(batch.num_columns)], names=batch.schema.names)

    return run


def project(df: DataFrame, vec_col: str, matrix: np.ndarray) -> DataFrame:
    """``df`` with the arrays of ``vec_col`` multiplied by the columns of ``matrix`` (not centred, as MLlib's PCA)."""
    fields = [T.StructField(f.name, T.ArrayType(T.DoubleType())) if f.name == vec_col else f for f in df.schema.fields]
    return df.where(F.col(vec_col).isNotNull()).mapInArrow(_times(vec_col, matrix), T.StructType(fields))


def fold_covariances(df: DataFrame, vec_col: str, fold_col: str = "fold") -> DataFrame:
    """fold, n, i, j, cov: sample covariances (i <= j, from 0) of the rows outside each fold."""
    spark = df.sparkSession
    rows = [(i, m.n, cov.tolist()) for i, m in training_moments(fold_moments(df, vec_col, fold_col)).items() for cov in [m.covariance()]]
    matrices = spark.createDataFrame(rows, "fold int, n long, cov array<array<double>>")
    cells = matrices.select("fold", "n", F.posexplode("cov").alias("i", "row")).select("fold", "n", "i", F.posexplode("row").alias("j", "cov"))
    return cells.where("i <= j")


def principal_components(df: DataFrame, vec_col: str, k: int) -> DataFrame:
    """component (from 0, greatest variance first), variance, i, loading: the
    ``k`` principal directions of all rows (the largest entry of each positive),
    from Gramian blocks that Spark adds up in one pass. Null vectors are left
    out; without rows there are no components."""
    moments = fold_moments(df.select(vec_col, F.lit(None).cast("int").alias("fold")), vec_col).get(None)
    rows = []
    if moments is not None and moments.n > 1:
        vectors, variances = moments.components(k)
        rows = [(c, float(v), vectors[:, c].tolist()) for c, v in enumerate(variances)]
    found = df.sparkSession.createDataFrame(rows, "component int, variance double, vector array<double>")
    return found.select("component", "variance", F.posexplode("vector").alias("i", "loading"))
