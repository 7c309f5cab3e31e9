"""Exact k nearest neighbours with pivot bounds.

``neighbors.knn_candidates`` compares every block of queries with every block
of train rows. Where vectors cluster, most of those pairs cannot hold a
neighbour, and the triangle inequality shows it beforehand:

1. Pivots are train rows of a bounded sample, far from one another. Every train
   row belongs to the cell of its nearest pivot.
2. Of each cell the driver knows its size, its nearest and farthest distance to
   the pivot and the ``k`` smallest ones: ``pivots * (k + 3)`` numbers.
3. A query's k-th neighbour is no farther than the k-th smallest of
   ``d(q, pivot) + d(pivot, row)`` over those rows. A cell is visited only if
   neither its ring around the pivot nor its half space against the query's own
   cell is farther away than that.
4. Queries are copied to the cells they visit, and a train row stays in its
   own. Cells are cut into blocks by hash, so a group is one bounded block pair
   whatever the size of a cell, and the block kernel of ``neighbors`` ranks it.

All bounds leave a margin for rounding, so the answers are those of
``knn_candidates``: same neighbours, distances and ranks.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import neighbors as nn
from quarry.session import scratch_path

# The functions below run in Python workers that may not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules["quarry.session"])

#: Sampled train rows per pivot.
SAMPLE = 16
#: Relative rounding margin of a bound.
MARGIN = 1e-7


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """``n`` distinct rows (or all), each as far as possible from those before it."""
    sample = np.unique(sample, axis=0)
    if len(sample) <= n:
        return sample
    found = [0]
    far = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(found) < n:
        found.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[found[-1]]) ** 2).sum(axis=1))
    return sample[found]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of rows to pivots, by direct differences a pivot at a time."""
    return np.sqrt(np.stack([((x - p) ** 2).sum(axis=1) for p in pivots], axis=1))


def _assign(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = distances(_matrix(batch.column("_tv"), pivots.shape[1]), pivots)
            cell = d.argmin(axis=1) if batch.num_rows else np.zeros(0, dtype=np.int64)
            near = d[np.arange(len(cell)), cell]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(near)], names=[*batch.schema.names, "_cell", "_near"])

    return run


@dataclass(frozen=True)
class Cells:
    """Pivots; of each cell its number, rows, nearest and farthest row, and the least distances to the pivot."""

    pivots: np.ndarray
    number: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least: list[np.ndarray]

    def visited(self, q: np.ndarray, k: int) -> np.ndarray:
        """Row and position of the cells that may hold one of the ``k`` nearest of each query."""
        d = distances(q, self.pivots)
        inner = d[:, self.number]
        bounds = np.concatenate([inner[:, [j]] + own[None, :] for j, own in enumerate(self.least)], axis=1)
        most = min(k, bounds.shape[1]) - 1
        reach = np.partition(bounds, most, axis=1)[:, most] if bounds.shape[1] >= k else np.full(len(q), np.inf)
        ring = np.maximum(inner - self.high[None, :], self.low[None, :] - inner)
        own = d.argmin(axis=1)
        apart = np.sqrt(((self.pivots[own][:, None, :] - self.pivots[self.number][None, :, :]) ** 2).sum(axis=2))
        nearest = d[np.arange(len(q)), own][:, None]
        half = np.divide(inner ** 2 - nearest ** 2, 2 * apart, out=np.zeros_like(inner), where=apart > 0)
        scale = 1.0 + np.abs(q).max(axis=1, initial=0.0) + d.max(axis=1) + float(np.abs(self.pivots).max(initial=0.0))
        margin = (MARGIN * scale)[:, None]  # of the ring; a half space's error grows as the pivots close up
        slack = MARGIN * np.divide(scale[:, None] * (inner + nearest), apart, out=np.full_like(inner, np.inf), where=apart > 0)
        return np.argwhere((ring <= reach[:, None] + margin) & ((half <= reach[:, None] + margin + slack) | (apart == 0)))


def _visit(cells: Cells, k: int, step: int = 256):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                rows, found = cells.visited(_matrix(part.column("_qv"), cells.pivots.shape[1]), k).T
                copied = part.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*copied.columns, pa.array(cells.number[found].astype(np.int32))], names=[*part.schema.names, "_cell"])

    return run


def _train_cells(train: DataFrame, k: int, pivots: int) -> tuple[DataFrame, Cells | None]:
    """Train rows with their cell, in a written table, and what is known of the cells."""
    spark = train.sparkSession
    sample = train.orderBy(F.xxhash64("_tid"), "_tid").limit(SAMPLE * pivots).select("_tv").collect()  # bounded
    if not sample:
        return train, None
    chosen = choose_pivots(np.array([r["_tv"] for r in sample], dtype=np.float64), pivots)
    schema = T.StructType([*train.schema.fields, T.StructField("_cell", T.IntegerType()), T.StructField("_near", T.DoubleType())])
    path = scratch_path(spark, "cells")
    train.mapInArrow(_assign(chosen), schema).withColumn("_salt", F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.parquet(path)  # the salt stays as it was written
    facts = {r["_cell"]: r for r in stored.groupBy("_cell").agg(F.count(F.lit(1)).alias("n"), F.min("_near").alias("low"), F.max("_near").alias("high")).collect()}
    order = F.row_number().over(Window.partitionBy("_cell").orderBy("_near"))
    least: dict[int, list[float]] = {}
    for r in stored.select("_cell", "_near").withColumn("_r", order).where(F.col("_r") <= k).collect():  # pivots * k rows
        least.setdefault(r["_cell"], []).append(r["_near"])
    number = np.array(sorted(facts))
    column = lambda name: np.array([facts[c][name] for c in number.tolist()])
    return stored, Cells(chosen, number, column("n"), column("low"), column("high"), [np.sort(least[c]) for c in number.tolist()])


def _sides(queries: DataFrame, train: DataFrame, k: int, qid: str, qvec: str, qlabel: str | None, tid: str, tvec: str, tlabel: str,
           pivots: int, carry: Sequence[str]) -> tuple[DataFrame, DataFrame, Cells | None]:
    t = train.where(nn._finite(tvec)).select(F.col(tid).cast("bigint").alias("_tid"), F.col(tlabel).cast("int").alias("_tlabel"), F.col(tvec).cast("array<double>").alias("_tv"))
    stored, cells = _train_cells(t, k, pivots)
    bad = F.raise_error(F.concat(F.lit("query vector is not finite: "), F.coalesce(F.col(qid).cast("string"), F.lit("NULL")))).cast("array<double>")
    q = queries.select(F.col(qid).cast("bigint").alias("_qid"), (F.col(qlabel).cast("int") if qlabel else F.lit(None).cast("int")).alias("_qlabel"),
                       F.when(nn._finite(qvec), F.col(qvec).cast("array<double>")).otherwise(bad).alias("_qv"), *[F.col(c).alias(f"_c_{c}") for c in carry])
    if cells is None:
        return q, stored, None
    schema = T.StructType([*q.schema.fields, T.StructField("_cell", T.IntegerType())])
    return q.mapInArrow(_visit(cells, k), schema), stored, cells


def knn_pruned(queries: DataFrame, train: DataFrame, k: int, *, qid: str = "qid", qvec: str = "qvec", qlabel: str | None = "qlabel",
               tid: str = "tid", tvec: str = "tvec", tlabel: str = "tlabel", pivots: int = 64, block_rows: int | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """The ``k`` nearest train rows of every query, as ``knn_candidates``
    returns them, with only those cells compared that may hold one.

    Query ids must be unique; copies of a train row are spread over blocks. A
    train vector with a missing, NaN or infinite entry is nobody's neighbour, a
    query vector with one stops the job; so do queries without any train row.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if not queries.groupBy(qid).count().where("count > 1").isEmpty():
        raise ValueError(f"query ids must be unique: some {qid} value occurs more than once")
    q, t, cells = _sides(queries, train, k, qid, qvec, qlabel, tid, tvec, tlabel, pivots, carry)
    schema = T.StructType(nn.CANDIDATE_SCHEMA.fields + [T.StructField(c, queries.schema[c].dataType, True) for c in carry])
    if cells is None:
        if not queries.isEmpty():
            raise ValueError("no train row with a finite vector")
        return queries.sparkSession.createDataFrame([], schema)
    rows = block_rows or nn.block_rows_for(cells.pivots.shape[1])
    visits = {r["_cell"]: r["count"] for r in q.groupBy("_cell").count().collect()}  # a row a cell
    blocks = lambda n: max(1, math.ceil(n / rows))
    n_cells = int(cells.number.max()) + 1
    size = dict(zip(cells.number.tolist(), cells.rows.tolist()))
    of_cell = lambda counts: F.get(F.array(*[F.lit(blocks(counts.get(c, 0))) for c in range(n_cells)]), F.col("_cell"))
    n_q, n_t = of_cell(visits), of_cell(size)
    q_rep = q.withColumn("_qb", F.pmod(F.xxhash64("_qid"), n_q).cast("int")).withColumn("_tb", F.explode(F.sequence(F.lit(0), n_t - 1)))
    here = F.get(F.array(*[F.lit(c in visits) for c in range(n_cells)]), F.col("_cell"))
    t_rep = (t.where(here).select("_tid", "_tlabel", "_tv", "_cell", F.pmod(F.xxhash64("_salt"), n_t).cast("int").alias("_tb"))
             .withColumn("_qb", F.explode(F.sequence(F.lit(0), n_q - 1))))
    key = ("_cell", "_qb", "_tb")
    found = q_rep.groupBy(*key).cogroup(t_rep.groupBy(*key)).applyInPandas(nn._knn_block_fn(k, None, tuple(carry)), schema)
    best = nn.top_k_per_key(found.drop("rank"), "qid", [F.col("dist"), F.col("tid")], k, "rank")
    return best.select([f.name for f in schema.fields])


def visits(queries: DataFrame, train: DataFrame, k: int, *, qid: str = "qid", qvec: str = "qvec", tid: str = "tid", tvec: str = "tvec",
           tlabel: str = "tlabel", pivots: int = 64) -> DataFrame:
    """qid and cell: the copies of queries that ``knn_pruned`` ships, at one block a cell."""
    q, _, cells = _sides(queries, train, k, qid, qvec, None, tid, tvec, tlabel, pivots, ())
    return q.select(F.col("_qid").alias("qid"), (F.col("_cell") if cells else F.lit(None).cast("int")).alias("cell"))
