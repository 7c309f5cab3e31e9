"""Exact k-nearest-neighbour classification.

Plan (no cross join, no pair rows):

1. One sizing job counts rows and id multiplicity per side, reading only
   the id columns (the vector width comes from one query row).
   Both sides are hashed (``xxhash64`` of the id, so evenly) into tiles of
   bounded size: whole blocks of at most ``block_rows`` rows, packed until a
   side of a tile is ``block_rows_for(dim)`` rows. Query ids must be unique,
   and when copies of one train row would overfill a block a checkpointed
   per-row salt spreads them.
2. Every query row is copied once per train tile and every train row once
   per query tile. Each pair of tiles is a task of its own
   (``repartitionById``), whose number grows with the data and whose work does
   not. In a task the queries come first, then the train rows.
3. The task holds its queries and their ``k`` best so far, and lets the train
   rows pass by, at most ``block_rows`` at a time. One single-precision matrix
   product tells which of them may be nearer than a query's k-th best, within a
   margin above its rounding; those few are computed exactly by direct
   differences (summed left to right, the same order as the native
   ``squared_distance`` expression) and merged into the best, ranked by
   (distance, train id).
4. With more than one train tile the candidates (``k`` per query and train
   tile) are merged by ``row_number() <= k`` per query, which Spark
   trims map-side (``WindowGroupLimit``) before the shuffle.
5. The vote groups the at most ``k`` neighbours of each query (a bounded
   array) and picks the most frequent label, ties going to the label whose
   nearest member ranks first. It reuses the merge's partitioning.

Cost: data moved is ``|Q| * n_train_tiles + |T| * n_query_tiles`` rows;
a task's Python holds one query tile and a batch of train rows, whatever the
table's size; distance work is the unavoidable ``|Q| * |T| * dim``, a bounded
part of it in each task.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quarry.session import checkpoint_dir, default_parallelism

# The block kernel below runs in Python workers. Pickling this module's
# functions by value ships them with the task, so executors need numpy and
# pandas but not this package on their path.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # older cloudpickle: ship the package with --py-files
    pass


CANDIDATE_SCHEMA = T.StructType([
    T.StructField("qid", T.LongType(), False),
    T.StructField("qlabel", T.IntegerType(), True),
    T.StructField("tid", T.LongType(), False),
    T.StructField("tlabel", T.IntegerType(), True),
    T.StructField("dist", T.DoubleType(), False),
    T.StructField("rank", T.IntegerType(), False),
])


_EMPTY = pd.DataFrame({
    "qid": pd.Series(dtype="int64"), "qlabel": pd.Series(dtype="int32"),
    "tid": pd.Series(dtype="int64"), "tlabel": pd.Series(dtype="int32"),
    "dist": pd.Series(dtype="float64"), "rank": pd.Series(dtype="int32")})


def _stack(vectors: pd.Series) -> np.ndarray:
    if len(vectors) == 0:
        return np.zeros((0, 0))
    return np.stack([np.asarray(v, dtype=np.float64) for v in vectors])


def block_distances(q: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Squared distances of every query row to every train row, summed over
    dimensions left to right (bit-equal to a sequential fold)."""
    acc = np.zeros((q.shape[0], t.shape[0]), dtype=np.float64)
    for j in range(q.shape[1]):
        d = q[:, j][:, None] - t[:, j][None, :]
        acc += d * d
    return acc


#: Entries of a strip's distance matrix (8 MB of doubles).
STRIP_CELLS = 1 << 20


def block_top_k(q: np.ndarray, t: np.ndarray, tids: np.ndarray, k: int, qx: np.ndarray | None = None,
                tx: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Exact ``k`` nearest train rows of every query row of one block pair.

    Works in strips of queries, so that memory is a few arrays of
    ``STRIP_CELLS`` numbers besides the vectors, also where all distances are
    equal. In a strip, candidates are found with one matrix product on vectors
    centred at the train mean (``|q|^2 + |t|^2 - 2 q.t``); every train row
    whose approximate distance is within a rounding margin of the k-th
    smallest is kept, so no true neighbour can be missed. Only the candidates
    get exact distances (direct differences summed left to right, one
    dimension at a time, bit-equal to ``block_distances``) and are ordered by
    (distance, train id).

    Returns row index, column index, exact distance and rank (1-based) of the
    selected pairs, grouped by row. Pairs with equal ``qx`` and ``tx`` are skipped.
    """
    n_q, n_t = q.shape[0], t.shape[0]
    kk = min(k, n_t)
    e = np.zeros(0, dtype=np.int64)
    if n_q == 0 or kk == 0:
        return e, e, np.zeros(0), e
    centre = t.mean(axis=0)
    tc = t - centre
    tn = np.einsum("ij,ij->i", tc, tc)
    far = float(np.abs(t).max(initial=0.0))
    eps, dim = np.finfo(np.float64).eps, q.shape[1]
    step = max(1, STRIP_CELLS // n_t)
    found = []
    for at in range(0, n_q, step):
        own = q[at: at + step]
        qc = own - centre
        qn = np.einsum("ij,ij->i", qc, qc)
        approx = qn[:, None] + tn[None, :] - 2.0 * (qc @ tc.T)
        if qx is not None:
            approx[qx[at: at + step, None] == tx[None, :]] = np.inf
        kth = np.partition(approx, kk - 1, axis=1)[:, kk - 1]
        # Rounding of the product form is below dim * eps * (|q|^2 + |t|^2), that of the centring
        # below dim * eps * (largest entry) * distance; the margin is many orders above both.
        spread = np.maximum(far, np.abs(own).max(axis=1, initial=0.0))
        margin = max(1e-9, 64.0 * dim * eps) * (qn + tn.max()) + 64.0 * dim * eps * spread * np.sqrt(qn + tn.max()) + (64.0 * dim * eps * spread) ** 2 + 1e-300
        rows, cols = np.nonzero((approx <= (kth + margin)[:, None]) & np.isfinite(approx))
        dist = np.zeros(len(rows))
        for j in range(dim):
            d = own[rows, j] - t[cols, j]
            dist += d * d
        order = np.lexsort((tids[cols], dist, rows))
        rows, cols, dist = rows[order], cols[order], dist[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") + 1
        keep = rank <= kk
        found.append((rows[keep] + at, cols[keep], dist[keep], rank[keep]))
    return tuple(np.concatenate(x) for x in zip(*found))


def _knn_block_fn(k: int, exclude: str | None, carry: tuple[str, ...] = ()):
    def fn(qdf: pd.DataFrame, tdf: pd.DataFrame) -> pd.DataFrame:
        if qdf.empty or tdf.empty:
            empty = _EMPTY.copy()
            for c in carry:
                empty[c] = pd.Series(dtype="object")
            return empty
        q = _stack(qdf["_qv"])
        t = _stack(tdf["_tv"])
        tids = tdf["_tid"].to_numpy(dtype=np.int64)
        sides = () if exclude is None else (qdf["_qx"].to_numpy(), tdf["_tx"].to_numpy())
        rows, cols, dist, rank = block_top_k(q, t, tids, k, *sides)
        out = pd.DataFrame({
            "qid": qdf["_qid"].to_numpy(dtype=np.int64)[rows],
            "qlabel": qdf["_qlabel"].to_numpy()[rows],
            "tid": tids[cols],
            "tlabel": tdf["_tlabel"].to_numpy()[cols],
            "dist": dist,
            "rank": rank.astype(np.int32),
        })
        for c in carry:
            out[c] = qdf[f"_c_{c}"].to_numpy()[rows]
        return out
    return fn


#: Train rows compared at a time, entries of a strip's single-precision distances, candidates computed at a time.
PIECE_ROWS, PIECE_CELLS, EXACT_ROWS = 2048, 1 << 19, 1 << 14
#: Train tiles at least, where there are several train blocks: so many candidate lists of a query are merged by window.
LEAST_TILES = 4
#: Stands for a missing id, and for a missing label (no int).
_NO_ID, _NO_LABEL = np.iinfo(np.int64).min, 1 << 40


def exact_distances(q: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Squared distances of paired rows, summed over dimensions left to right."""
    out = np.zeros(len(q))
    if q.shape[1]:
        for at in range(0, len(q), EXACT_ROWS):
            d = q[at: at + EXACT_ROWS] - t[at: at + EXACT_ROWS]
            out[at: at + EXACT_ROWS] = np.add.accumulate(d * d, axis=1)[:, -1]
    return out


class NearestRows:
    """The ``k`` nearest of the train rows seen so far, for each query of a tile."""

    def __init__(self, q: np.ndarray, k: int, qx: np.ndarray | None = None):
        n = len(q)
        self.q, self.k, self.qx = q, k, qx
        self.dist = np.full((n, k), np.inf)
        self.tid = np.full((n, k), np.iinfo(np.int64).max)
        self.label = np.full((n, k), _NO_LABEL)
        self.centre = q.mean(axis=0) if n else np.zeros(q.shape[1])
        self.far, self.norm = np.zeros(n), np.zeros(n)
        self.scale = 0.0
        for at in range(0, n, PIECE_ROWS):  # a piece at a time: no second copy of the tile in doubles
            own = q[at: at + PIECE_ROWS]
            c = own - self.centre
            self.norm[at: at + PIECE_ROWS] = np.einsum("ij,ij->i", c, c)
            self.far[at: at + PIECE_ROWS] = np.abs(own).max(axis=1, initial=0.0)
            self.scale = max(self.scale, float(np.abs(c).max(initial=0.0)))
        self.narrow = np.empty((n, q.shape[1] + 1), dtype=np.float32) if 1e-100 < self.scale < 1e100 else None
        if self.narrow is not None:
            for at in range(0, n, PIECE_ROWS):
                self.narrow[at: at + PIECE_ROWS, :-1] = (q[at: at + PIECE_ROWS] - self.centre) * (-2.0 / self.scale)
            self.narrow[:, -1] = 1.0

    def see(self, t: np.ndarray, tids: np.ndarray, labels: np.ndarray, tx: np.ndarray | None = None, rows: int = PIECE_ROWS) -> None:
        for at in range(0, len(t), rows):
            to = at + rows
            self._see(t[at: to], tids[at: to], labels[at: to], None if tx is None else tx[at: to])

    def _see(self, t: np.ndarray, tids: np.ndarray, labels: np.ndarray, tx: np.ndarray | None) -> None:
        eps, dim = np.finfo(np.float64).eps, t.shape[1]
        tc = t - self.centre
        tn = np.einsum("ij,ij->i", tc, tc)
        top, far = float(tn.max()), float(np.abs(t).max(initial=0.0))
        narrow = None
        if self.narrow is not None and np.abs(tc).max(initial=0.0) <= 1e3 * self.scale:
            narrow = np.concatenate([tc / self.scale, (tn / self.scale ** 2)[:, None]], axis=1).astype(np.float32).T
        step = max(1, PIECE_CELLS // len(t))
        for at in range(0, len(self.q), step):
            own = slice(at, at + step)
            qn = self.norm[own]
            # Rounding of the product form is below dim * eps * (|q|^2 + |t|^2), that of the centring
            # below dim * eps * (largest entry) * distance; the margin is many orders above both.
            spread = np.maximum(far, self.far[own])
            margin = (max(1e-9, 64.0 * dim * eps) * (qn + top) + 64.0 * dim * eps * spread * np.sqrt(qn + top)
                      + (64.0 * dim * eps * spread) ** 2 + 1e-300)
            blocked = None if tx is None else (self.qx[own], tx)
            found = None
            if narrow is not None:
                s2 = self.scale ** 2
                # Products and sums of floats: below (dim + 5) * 2^-24 * (|q|^2 + 2 |t|^2); the margin is over ten times that.
                single = (margin + 8.0 * (dim + 8) * float(np.finfo(np.float32).eps) * (qn + top)) / s2 + 1e-30
                found = self._within(self.narrow[own] @ narrow, (self.dist[own, -1] - qn) / s2, single, blocked, 8 * self.k)
            if found is None:  # single precision tells too few apart
                approx = tn[None, :] - 2.0 * ((self.q[own] - self.centre) @ tc.T)
                found = self._within(approx, self.dist[own, -1] - qn, margin, blocked, len(t))
            row, col = found
            if blocked is not None:
                free = blocked[0][row] != tx[col]
                row, col = row[free], col[free]
            if len(row):
                self._merge(row + at, t, tids, labels, col)

    def _within(self, approx: np.ndarray, limit: np.ndarray, margin: np.ndarray, blocked: tuple | None, most: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Row and column of all entries that may be among the ``k`` least, none of
        those within ``limit`` missed; None for more than ``most`` a row."""
        n = approx.shape[1]
        with np.errstate(over="ignore", invalid="ignore"):
            bound = (limit + margin).astype(approx.dtype)
            flat = np.flatnonzero(approx <= bound[:, None])
            if len(flat) > 8 * self.k * len(approx):  # not near enough a bound yet: the piece's own k-th least
                if blocked is not None:
                    approx[blocked[0][:, None] == blocked[1][None, :]] = np.inf
                if self.k < n:
                    kth = np.partition(approx, self.k - 1, axis=1)[:, self.k - 1].astype(np.float64)
                    bound = np.minimum(bound, np.nan_to_num(kth + 2.0 * margin, nan=np.inf, posinf=np.inf).astype(approx.dtype))
                flat = np.flatnonzero((approx <= bound[:, None]) & (approx < np.inf))
        if len(flat) > most * len(approx):
            return None
        return flat // n, flat % n

    def _merge(self, row: np.ndarray, t: np.ndarray, tids: np.ndarray, labels: np.ndarray, col: np.ndarray) -> None:
        dist = np.empty(len(row))
        for at in range(0, len(row), EXACT_ROWS):
            to = at + EXACT_ROWS
            dist[at: to] = exact_distances(self.q[row[at: to]], t[col[at: to]])
        near = (dist <= self.dist[row, -1]) & (dist < np.inf)
        row, col, dist = row[near], col[near], dist[near]
        if len(row) == 0:
            return
        own = np.unique(row)
        k = self.k
        every = np.concatenate([np.repeat(own, k), row])
        d = np.concatenate([self.dist[own].ravel(), dist])
        ids = np.concatenate([self.tid[own].ravel(), tids[col]])
        names = np.concatenate([self.label[own].ravel(), labels[col]])
        order = np.lexsort((ids, d, every))
        every = every[order]
        place = np.arange(len(every)) - np.searchsorted(every, every, side="left")
        order, every, place = order[place < k], every[place < k], place[place < k]
        self.dist[every, place], self.tid[every, place], self.label[every, place] = d[order], ids[order], names[order]


def _column(batch: pa.RecordBatch, name: str, missing: int) -> np.ndarray:
    return batch.column(name).cast(pa.int64()).fill_null(missing).to_numpy(zero_copy_only=False)


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("_v")
    widths = np.diff(column.offsets.to_numpy())
    if len(widths) and (widths != widths[0]).any():
        raise ValueError("vectors of different lengths")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, int(widths[0]) if len(widths) else 0)


def _tile_fn(k: int, exclude: bool, block_rows: int, schema: pa.Schema, carry: tuple[str, ...]):
    """Nearest rows of the queries of each group (``_side`` 0, first) among its
    train rows (``_side`` 1), which pass by batch by batch."""

    def answers(held: list[pa.RecordBatch], best: NearestRows) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in held:
            own = slice(at, at + batch.num_rows)
            at += batch.num_rows
            row, place = np.nonzero(best.dist[own] < np.inf)
            if len(row) == 0:
                continue
            here = pa.array(row)
            label = best.label[own][row, place]
            columns = [batch.column("_id").take(here), batch.column("_label").take(here), pa.array(best.tid[own][row, place]),
                       pa.array(np.where(label == _NO_LABEL, 0, label).astype(np.int32), mask=label == _NO_LABEL),
                       pa.array(best.dist[own][row, place]), pa.array((place + 1).astype(np.int32)), *[batch.column(f"_c_{c}").take(here) for c in carry]]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, vectors, best = None, [], [], None
        kept = ["_id", "_label", *(["_x"] if exclude else []), *[f"_c_{c}" for c in carry]]
        for batch in batches:
            if batch.num_rows == 0:
                continue
            key = _column(batch, "_group", 0) * 2 + _column(batch, "_side", 0)
            cuts = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(a, b - a)
                if key[a] // 2 != group:
                    if best is not None:
                        yield from answers(held, best)
                    group, held, vectors, best = key[a] // 2, [], [], None
                if key[a] % 2 == 0:
                    vectors.append(_vectors(part).copy())  # the batch itself is let go
                    held.append(pa.RecordBatch.from_arrays([pa.concat_arrays([part.column(c), part.column(c).slice(0, 0)]) for c in kept], names=kept))
                    continue
                if not held:
                    continue
                if best is None:
                    q = np.concatenate(vectors)
                    vectors = []
                    best = NearestRows(q, k, np.concatenate([_column(h, "_x", 0) for h in held]) if exclude else None)
                best.see(_vectors(part), _column(part, "_id", _NO_ID), _column(part, "_label", _NO_LABEL),
                         _column(part, "_x", 0) if exclude else None, min(block_rows, PIECE_ROWS))
        if best is not None:
            yield from answers(held, best)
        pa.default_memory_pool().release_unused()  # the worker lives on

    return run


def tile_counts(n_query: int, n_train: int, block_rows: int, tile_rows: int, min_groups: int = 1) -> tuple[int, int]:
    """Number of query and train tiles: whole blocks, at most ``tile_rows``
    rows (or one block) to a tile. Several train blocks make several tiles."""
    n_qb, n_tb = block_counts(n_query, n_train, max(block_rows, tile_rows), min_groups)
    blocks = math.ceil(n_train / block_rows)
    return n_qb, max(n_tb, min(blocks, LEAST_TILES))


def _id_counts(queries: DataFrame, train: DataFrame, qid: str, tid: str) -> DataFrame:
    """``_side, n, copies`` per side, from the id columns only."""
    tagged = (queries.select(F.lit(0).alias("_side"), F.col(qid).cast("bigint").alias("_id"))
              .unionByName(train.select(F.lit(1).alias("_side"), F.col(tid).cast("bigint").alias("_id"))))
    per_id = tagged.groupBy("_side", "_id").agg(F.count(F.lit(1)).alias("c"))
    return per_id.groupBy("_side").agg(F.sum("c").alias("n"), F.max("c").alias("copies"))


def _side_stats(queries: DataFrame, train: DataFrame, qid: str, tid: str) -> dict[int, dict[str, int]]:
    """Per side (0 = queries, 1 = train): row count and the largest number of
    rows sharing one id, in one job that reads only the id columns. Ids are
    counted per id first (partially aggregated, so a hot id costs nothing
    extra); a few scalars reach the driver."""
    rows = _id_counts(queries, train, qid, tid).collect()
    out = {0: {"n": 0, "copies": 0}, 1: {"n": 0, "copies": 0}}
    for r in rows:
        out[r["_side"]] = {"n": int(r["n"]), "copies": int(r["copies"])}
    return out


def _vector_width(queries: DataFrame, qvec: str) -> int:
    """Vector length from one query row (distances need query and train
    vectors of one length): ``first()`` takes rows incrementally from one
    partition, so this is a tiny job, not another scan of the vectors."""
    row = queries.select(F.size(qvec).alias("d")).where(F.col("d") >= 0).first()
    return max(row["d"] if row else 0, 1)


def block_rows_for(dim: int, side_bytes: int = 64 << 20, min_rows: int = 64) -> int:
    """Rows per block so one side of a block stays near ``side_bytes`` as
    doubles. The distances of a block pair are computed in strips, so their
    number sets no further bound."""
    return int(max(min_rows, side_bytes // (8 * max(1, dim))))


def _finite(vector: str) -> Column:
    """True for a vector without missing, NaN or infinite entries."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf")))), F.lit(False))


def block_counts(n_query: int, n_train: int, block_rows: int, min_groups: int = 1,
                min_query_rows: int = 64) -> tuple[int, int]:
    """Number of query and train blocks: each block at most ``block_rows``.
    When that gives fewer than ``min_groups`` groups the query side is split
    further (so small inputs still use several tasks), but never below
    ``min_query_rows`` queries per block: each extra query block costs one
    more copy of the train side."""
    n_tb = max(1, math.ceil(n_train / block_rows))
    n_qb = max(1, math.ceil(n_query / block_rows))
    if n_qb * n_tb < min_groups:
        cap = max(1, n_query // max(1, min_query_rows))
        n_qb = max(n_qb, min(cap, math.ceil(min_groups / n_tb)))
    return n_qb, n_tb


def knn_candidates(queries: DataFrame, train: DataFrame, k: int, *, qid: str = "qid",
                   qvec: str = "qvec", qlabel: str | None = "qlabel", tid: str = "tid",
                   tvec: str = "tvec", tlabel: str = "tlabel", block_rows: int | None = None,
                   exclude: str | None = None, n_query: int | None = None,
                   n_train: int | None = None, carry: Sequence[str] = (),
                   check_ids: bool = True) -> DataFrame:
    """The ``k`` nearest train rows of every query row, with ranks.

    ``exclude`` names a column present on both sides: pairs with equal values
    are never neighbours (e.g. a fold id, for held-out-fold prediction), and
    NULL equals NULL there.
    A train vector with a missing, NaN or infinite entry is nobody's
    neighbour; a query vector with one stops the job with its id. Queries
    without any such train row stop the job, too.
    ``carry`` lists query-side columns copied onto each of the query's
    candidate rows (no join back needed).
    One sizing job counts the rows and id multiplicities of both sides:
    query ids must be unique; train rows may repeat (copies are spread over
    blocks by a checkpointed salt when they would overfill one). A caller
    that knows both sizes and that ids are unique can pass ``n_query``,
    ``n_train``, ``block_rows`` and ``check_ids=False`` to skip that job.
    ``block_rows`` defaults to ``block_rows_for(dim)`` (64 MB of doubles);
    smaller blocks travel several to a tile of that size.

    Output: ``qid, qlabel, tid, tlabel, dist, rank`` (rank 1 = nearest) and
    the ``carry`` columns, in this order for any number of blocks.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = queries.sparkSession
    known = n_query is not None and n_train is not None and block_rows is not None
    tile_rows = block_rows_for(_vector_width(queries, qvec))
    block_rows = tile_rows if block_rows is None else block_rows
    if check_ids or not known:
        stats = _side_stats(queries, train, qid, tid)
        if stats[0]["copies"] > 1:
            raise ValueError(f"query ids must be unique: some {qid} value occurs {stats[0]['copies']} times")
        n_query = stats[0]["n"] if n_query is None else n_query
        n_train = stats[1]["n"] if n_train is None else n_train
        train_copies = stats[1]["copies"]
    else:
        train_copies = 1  # the caller vouches for unique ids and gives the sizes
    if n_query and train.where(_finite(tvec)).isEmpty():
        raise ValueError("no train row with a finite vector")
    n_qb, n_tb = tile_counts(n_query, n_train, block_rows, tile_rows, default_parallelism(spark))
    # Copies of one train row all hash to one block. When they are many, a
    # per-row salt spreads them; the salted side is checkpointed first, so a
    # recomputed task can never move a row to another block.
    salted = train_copies > max(1, block_rows // 2)
    if salted:
        checkpoint_dir(spark)
        train = train.withColumn("_salt", F.monotonically_increasing_id()).checkpoint(eager=True)

    x = F.xxhash64(exclude) if exclude else F.lit(None).cast("bigint")
    q = queries.select(
        F.lit(0).alias("_side"),
        F.col(qid).cast("bigint").alias("_id"),
        (F.col(qlabel).cast("int") if qlabel else F.lit(None).cast("int")).alias("_label"),
        F.when(_finite(qvec), F.col(qvec)).otherwise(
            F.raise_error(F.concat(F.lit("query vector is not finite: "), F.coalesce(F.col(qid).cast("string"), F.lit("NULL"))))
            .cast(queries.schema[qvec].dataType)).cast("array<double>").alias("_v"),
        x.alias("_x"),
        F.pmod(F.xxhash64(F.col(qid)), F.lit(n_qb)).cast("int").alias("_qb"),
        F.explode(F.sequence(F.lit(0), F.lit(n_tb - 1))).alias("_tb"),
        *[F.col(c).alias(f"_c_{c}") for c in carry])
    t = train.where(_finite(tvec)).select(
        F.lit(1).alias("_side"),
        F.col(tid).cast("bigint").alias("_id"),
        F.col(tlabel).cast("int").alias("_label"),
        F.col(tvec).cast("array<double>").alias("_v"),
        x.alias("_x"),
        F.explode(F.sequence(F.lit(0), F.lit(n_qb - 1))).alias("_qb"),
        F.pmod(F.xxhash64(F.col(tid), *([F.col("_salt")] if salted else [])), F.lit(n_tb)).cast("int").alias("_tb"),
        *[F.lit(None).cast(queries.schema[c].dataType).alias(f"_c_{c}") for c in carry])
    group = (F.col("_qb") * n_tb + F.col("_tb")).cast("int")
    tiles = (q.unionByName(t).withColumn("_group", group).drop("_qb", "_tb")
             .repartitionById(n_qb * n_tb, "_group").sortWithinPartitions("_group", "_side"))

    schema = T.StructType(CANDIDATE_SCHEMA.fields + [
        T.StructField(c, queries.schema[c].dataType, True) for c in carry])
    cand = tiles.mapInArrow(_tile_fn(k, exclude is not None, block_rows, to_arrow_schema(schema), tuple(carry)), schema)
    if n_tb > 1:
        cand = top_k_per_key(cand.drop("rank"), "qid", [F.col("dist"), F.col("tid")], k, "rank")
    return cand.select([f.name for f in schema.fields])


def top_k_per_key(df: DataFrame, key: str, order: list[Column | str], k: int,
                  rank_col: str = "rank") -> DataFrame:
    """``k`` first rows per key in the given order, with their rank."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def majority_vote(neighbors: DataFrame, key: str = "qid", label: str = "tlabel", rank: str = "rank",
                  actual: str | None = "qlabel", carry: Sequence[str] = ()) -> DataFrame:
    """Most frequent label among each query's neighbours; a tie goes to the
    label whose nearest member has the best rank.

    The neighbours of one query are at most ``k`` rows, so they are gathered
    into one bounded array and voted on with native array functions.

    Output: ``qid, actual, predicted, votes`` and the ``carry`` columns
    (constant per query).
    """
    aggs = [F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(label).alias("l"))))
            .alias("_nb")]
    if actual:
        aggs.append(F.first(actual, ignorenulls=True).alias("actual"))
    aggs += [F.first(c, ignorenulls=True).alias(c) for c in carry]
    voted = neighbors.groupBy(key).agg(*aggs)
    nb = F.col("_nb")
    scored = F.transform(nb, lambda e: F.struct(
        F.size(F.filter(nb, lambda x: x["l"] == e["l"])).alias("votes"),
        (-e["r"]).alias("neg_rank"),
        e["l"].alias("label")))
    best = F.array_max(scored)
    cols = [F.col(key).alias("qid")]
    if actual:
        cols.append(F.col("actual"))
    cols += [best["label"].alias("predicted"), best["votes"].cast("bigint").alias("votes")]
    return voted.select(*cols, *carry)


def knn_classify(queries: DataFrame, train: DataFrame, k: int = 5, **kw) -> DataFrame:
    """Exact KNN classifier: candidates -> vote. Output ``qid, actual,
    predicted, votes``."""
    return majority_vote(knn_candidates(queries, train, k, **kw), carry=kw.get("carry", ()))

