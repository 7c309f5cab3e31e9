import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import neighbors as nn
from quarry.operators import pivots as pv


def frames(spark, q, t, parts=4):
    qs = spark.createDataFrame([(i, i % 3, x.tolist()) for i, x in enumerate(q)], "qid long, qlabel int, qvec array<double>")
    ts = spark.createDataFrame([(i, i % 5, x.tolist()) for i, x in enumerate(t)], "tid long, tlabel int, tvec array<double>")
    return qs.repartition(parts), ts.repartition(parts)


def rows(df):
    return sorted((r.qid, r["rank"], r.tid, r.tlabel, r.dist) for r in df.collect())


def brute(q, t, k):
    out = []
    for i, x in enumerate(q):
        d = nn.block_distances(x[None, :], t)[0]
        best = sorted(range(len(t)), key=lambda j: (d[j], j))[:k]
        out += [(i, r, j, j % 5, d[j]) for r, j in enumerate(best, 1)]
    return sorted(out)


def clustered(rng, n, centres):
    return centres[rng.integers(0, len(centres), n)] + rng.normal(0, 0.5, (n, centres.shape[1]))


def test_clustered_vectors_visit_few_cells_and_give_the_same_answer(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 60, (16, 8))
    q, t = clustered(rng, 160, centres), clustered(rng, 1600, centres)
    qs, ts = frames(spark, q, t)
    assert rows(pv.knn_pruned(qs, ts, 5, pivots=16)) == brute(q, t, 5)
    shipped = pv.visits(qs, ts, 5, pivots=16).count()
    assert shipped <= 2 * len(q)  # of 16 cells
    assert rows(pv.knn_pruned(qs, ts, 5, pivots=16, block_rows=40)) == rows(nn.knn_candidates(qs, ts, 5, block_rows=40))


@pytest.mark.parametrize("k,pivots", [(1, 1), (3, 7), (50, 4), (400, 9)])
def test_spread_vectors_ties_and_large_k(spark, k, pivots):
    rng = np.random.default_rng(k)
    q, t = rng.normal(0, 1, (40, 3)).round(1), rng.normal(0, 1, (300, 3)).round(1)
    t[:60] = t[60]  # many equal rows: ties go to the smaller id
    q[:10] = t[60]
    qs, ts = frames(spark, q, t)
    assert rows(pv.knn_pruned(qs, ts, k, pivots=pivots, block_rows=64)) == brute(q, t, k)


def test_far_from_the_origin(spark):
    rng = np.random.default_rng(9)
    q, t = 1e7 + rng.normal(0, 1, (30, 4)), 1e7 + rng.normal(0, 1, (200, 4))
    qs, ts = frames(spark, q, t)
    assert rows(pv.knn_pruned(qs, ts, 4, pivots=8)) == brute(q, t, 4)


def test_a_cell_with_a_third_of_the_rows_is_cut_into_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    t = np.concatenate([np.full((500, 4), 7.0), rng.normal(0, 30, (1000, 4))])
    q = np.concatenate([np.full((100, 4), 7.0), rng.normal(0, 30, (50, 4))])
    qs, ts = frames(spark, q, t)
    largest = spark.sparkContext.accumulator(0)
    inner = nn._knn_block_fn

    def counted(*a):
        fn = inner(*a)

        def run(x, y):
            if max(len(x), len(y)) > 150:
                largest.add(1)
            return fn(x, y)
        return run

    monkeypatch.setattr(pv.nn, "_knn_block_fn", counted)
    assert rows(pv.knn_pruned(qs, ts, 5, pivots=10, block_rows=100)) == brute(q, t, 5)
    assert largest.value == 0


def test_bad_vectors_and_ids(spark):
    qs, ts = frames(spark, np.ones((2, 2)), np.array([[np.nan, 1.0], [1.0, 2.0], [np.inf, 0.0]]))
    assert rows(pv.knn_pruned(qs, ts, 3)) == [(0, 1, 1, 1, 1.0), (1, 1, 1, 1, 1.0)]
    for finder in (pv.knn_pruned, nn.knn_candidates):
        with pytest.raises(ValueError, match="finite"):
            finder(qs, ts.where("tid = 0"), 1).collect()
    with pytest.raises(ValueError, match="unique"):
        pv.knn_pruned(qs.withColumn("qid", F.lit(1)), ts, 1)
    assert pv.knn_pruned(qs.limit(0), ts.limit(0), 1).count() == 0
    with pytest.raises(Exception, match="not finite"):
        pv.knn_pruned(ts.select(F.col("tid").alias("qid"), F.col("tlabel").alias("qlabel"), F.col("tvec").alias("qvec")), ts, 1).collect()
