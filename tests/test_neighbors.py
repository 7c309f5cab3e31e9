import numpy as np
import pytest

from quarry.functions.scalars import squared_distance
from quarry.operators import neighbors as nn
from quarry.plans import fixtures as fx

from sf_paths import SF001


def brute_force(q, qids, t, tids, tlabels, k):
    """Reference answer: nearest by (distance, id), vote by count then best rank."""
    out = {}
    for i, qid in enumerate(qids):
        d = [(float(((q[i].astype(np.float64) - t[j].astype(np.float64)) ** 2).sum()), int(tids[j]), int(tlabels[j]))
             for j in range(len(tids))]
        d.sort(key=lambda x: (x[0], x[1]))
        top = d[:k]
        counts = {}
        for rank, (_, _, lab) in enumerate(top):
            c, best = counts.get(lab, (0, rank))
            counts[lab] = (c + 1, best)
        out[int(qid)] = min(counts, key=lambda lab: (-counts[lab][0], counts[lab][1]))
    return out


def _random_sides(spark, n_q=37, n_t=151, dim=6, seed=3, n_labels=4):
    rng = np.random.default_rng(seed)
    q = rng.normal(size=(n_q, dim))
    t = rng.normal(size=(n_t, dim))
    tl = rng.integers(0, n_labels, n_t)
    ql = rng.integers(0, n_labels, n_q)
    qdf = spark.createDataFrame([(i, int(ql[i]), q[i].tolist()) for i in range(n_q)],
                                "qid long, qlabel int, qvec array<double>")
    tdf = spark.createDataFrame([(1000 + j, int(tl[j]), t[j].tolist()) for j in range(n_t)],
                                "tid long, tlabel int, tvec array<double>")
    return q, t, tl, qdf, tdf


def test_block_distances_match_native_expression(spark):
    q, t, _, _, _ = _random_sides(spark, 5, 7)
    pairs = spark.createDataFrame([(i, 1000 + j, q[i].tolist(), t[j].tolist()) for i in range(5) for j in range(7)],
                                  "qid long, tid long, qvec array<double>, tvec array<double>")
    native = {(r.qid, r.tid): r.d for r in pairs.select(
        "qid", "tid", squared_distance("qvec", "tvec").alias("d")).collect()}
    mat = nn.block_distances(q, t)
    for i in range(5):
        for j in range(7):
            assert mat[i, j] == native[(i, 1000 + j)]


@pytest.mark.parametrize("block_rows", [4096, 16, 50])
@pytest.mark.parametrize("k", [1, 5])
def test_knn_equals_brute_force_for_any_blocking(spark, block_rows, k):
    q, t, tl, qdf, tdf = _random_sides(spark)
    want = brute_force(q, list(range(len(q))), t, [1000 + j for j in range(len(t))], tl, k)
    got = {r.qid: r.predicted for r in nn.knn_classify(qdf, tdf, k, block_rows=block_rows).collect()}
    assert got == want
    nb = nn.knn_candidates(qdf, tdf, k, block_rows=block_rows)
    counts = {r.qid: r["count"] for r in nb.groupBy("qid").count().collect()}
    assert set(counts.values()) == {k}
    ranks = sorted({r.rank for r in nb.collect()})
    assert ranks == list(range(1, k + 1))


def test_ties_broken_by_train_id_and_vote_by_nearest(spark):
    # every train point at the same distance: the k smallest ids win
    qdf = spark.createDataFrame([(1, 0, [0.0, 0.0])], "qid long, qlabel int, qvec array<double>")
    tdf = spark.createDataFrame([(10 + j, lab, [1.0, 0.0] if j % 2 else [0.0, 1.0])
                                 for j, lab in enumerate([7, 8, 8, 7, 9, 9])],
                                "tid long, tlabel int, tvec array<double>")
    nb = nn.knn_candidates(qdf, tdf, 4, block_rows=2).orderBy("rank").collect()
    assert [r.tid for r in nb] == [10, 11, 12, 13]
    # labels 7,8,8,7: tie 2-2, label 7 holds rank 1 -> 7
    assert nn.knn_classify(qdf, tdf, 4, block_rows=2).first().predicted == 7


def test_exclude_column_skips_same_group(spark):
    qdf = spark.createDataFrame([(1, 0, [0.0], 0), (2, 0, [10.0], 1)], "qid long, qlabel int, qvec array<double>, g int")
    tdf = spark.createDataFrame([(11, 5, [0.0], 0), (12, 6, [10.0], 1), (13, 7, [5.0], 2)],
                                "tid long, tlabel int, tvec array<double>, g int")
    nb = {r.qid: r.tid for r in nn.knn_candidates(qdf, tdf, 1, exclude="g").collect()}
    assert nb == {1: 13, 2: 13}


def test_fewer_train_rows_than_k(spark):
    qdf = spark.createDataFrame([(1, 0, [0.0])], "qid long, qlabel int, qvec array<double>")
    tdf = spark.createDataFrame([(11, 5, [1.0]), (12, 5, [2.0])], "tid long, tlabel int, tvec array<double>")
    assert nn.knn_candidates(qdf, tdf, 5).count() == 2
    assert nn.knn_classify(qdf, tdf, 5).first().predicted == 5


def test_block_counts_bounds():
    assert nn.block_counts(100, 400, 2048, 8) == (1, 1)
    n_qb, n_tb = nn.block_counts(10_000, 400, 2048, 8)
    assert n_tb == 1 and n_qb >= 5
    n_qb, n_tb = nn.block_counts(10_000, 100_000, 2048, 8)
    assert n_tb == 49 and n_qb == 5


def test_driver_table_knn_blocking_invariant(spark):
    q, t = fx.knn_sides(spark, SF001)
    a = sorted(map(tuple, nn.knn_classify(q, t, 5).collect()))
    b = sorted(map(tuple, nn.knn_classify(q, t, 5, block_rows=37).collect()))
    assert a == b and len(a) == 100


def _direct_top_k(q, t, tids, k, blocked=None):
    d = nn.block_distances(q, t)
    if blocked is not None:
        d[blocked] = np.inf
    out = []
    for i in range(len(q)):
        order = sorted((x for x in range(len(t)) if np.isfinite(d[i, x])), key=lambda x: (d[i, x], tids[x]))[:k]
        out += [(i, x, d[i, x], r + 1) for r, x in enumerate(order)]
    return out


@pytest.mark.parametrize("offset", [0.0, 1e4])
def test_block_top_k_is_exact(offset):
    rng = np.random.default_rng(7)
    q = rng.normal(size=(40, 16)) + offset
    t = rng.normal(size=(300, 16)) + offset
    t[50] = t[10]                      # exact duplicate: tie broken by id
    q[3] = t[20]                       # zero distance
    tids = rng.permutation(300).astype(np.int64) + 5
    qx, tx = rng.integers(0, 6, 40), rng.integers(0, 6, 300)
    for b, sides in ((None, ()), (qx[:, None] == tx[None, :], (qx, tx))):
        rows, cols, dist, rank = nn.block_top_k(q, t, tids, 7, *sides)
        got = list(zip(rows.tolist(), cols.tolist(), dist.tolist(), rank.tolist()))
        assert got == _direct_top_k(q, t, tids, 7, b)


def test_block_top_k_all_blocked_row():
    q = np.zeros((2, 3))
    t = np.ones((4, 3))
    rows, cols, dist, rank = nn.block_top_k(q, t, np.arange(4), 3, np.array([1, 2]), np.array([1, 1, 1, 1]))
    assert rows.tolist() == [1, 1, 1] and cols.tolist() == [0, 1, 2] and rank.tolist() == [1, 2, 3]


def test_block_rows_adapt_to_dimension():
    assert nn.block_rows_for(64) == (64 << 20) // 512
    assert nn.block_rows_for(16384) == 512
    assert nn.block_rows_for(10 ** 7) == 64


@pytest.mark.parametrize("block_rows", [4096, 16])
def test_carry_columns_reach_the_vote(spark, block_rows):
    from pyspark.sql import functions as F
    _, _, _, qdf, tdf = _random_sides(spark)
    qdf = qdf.withColumn("tag", (F.col("qid") * 3).cast("int"))
    out = nn.knn_classify(qdf, tdf, 3, block_rows=block_rows, carry=["tag"]).collect()
    assert len(out) == 37 and all(r.tag == r.qid * 3 for r in out)


def test_hot_copies_in_train_are_spread_and_counted(spark):
    """One train row repeated many times (a third of the train side) still
    gives the brute-force answer, with each copy a separate neighbour."""
    from pyspark.sql import functions as F
    q, t, tl, qdf, tdf = _random_sides(spark, n_q=20, n_t=60)
    hot = tdf.where("tid = 1000").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(30)))).drop("copy")
    tdf2 = tdf.unionByName(hot)
    nb = nn.knn_candidates(qdf, tdf2, 5, block_rows=8)
    tids = list(range(1000, 1060)) + [1000] * 30
    tt = np.vstack([t, np.repeat(t[:1], 30, axis=0)])
    tl2 = np.concatenate([tl, np.repeat(tl[:1], 30)])
    want = brute_force(q, list(range(20)), tt, tids, tl2, 5)
    got = {r.qid: r.predicted for r in nn.majority_vote(nb).collect()}
    assert got == want
    assert nb.groupBy("qid").count().where("count <> 5").count() == 0


def test_duplicate_query_ids_are_rejected(spark):
    _, _, _, qdf, tdf = _random_sides(spark, n_q=5, n_t=10)
    with pytest.raises(ValueError, match="unique"):
        nn.knn_candidates(qdf.unionByName(qdf), tdf, 3)


def test_known_sizes_skip_the_sizing_job(spark):
    q, t, tl, qdf, tdf = _random_sides(spark)
    a = sorted(map(tuple, nn.knn_classify(qdf, tdf, 5).collect()))
    b = sorted(map(tuple, nn.knn_classify(qdf, tdf, 5, n_query=37, n_train=151, block_rows=64,
                                          check_ids=False).collect()))
    assert a == b


def _sides(spark, vectors, fold=None):
    rows = [(i, i % 3, [float(x) for x in v] if v is not None else None, None if fold is None else fold(i)) for i, v in enumerate(vectors)]
    q = spark.createDataFrame(rows, "qid long, qlabel int, qvec array<double>, fold int")
    t = spark.createDataFrame(rows, "tid long, tlabel int, tvec array<double>, fold int")
    return q, t


def test_nan_train_rows_cost_no_query(spark):
    q, _ = _sides(spark, [[i, 1] for i in range(30)])
    _, t = _sides(spark, [[i, 1] for i in range(40)] + [[float("nan"), 1], [float("inf"), 0], None])
    got = nn.knn_classify(q, t, 3)
    assert got.count() == 30
    assert {r.tid for r in nn.knn_candidates(q, t, 3).collect()} <= set(range(40))


def test_bad_query_vector_is_named(spark):
    import pytest
    q, t = _sides(spark, [[1, 1], [2, 2], [float("nan"), 0]])
    with pytest.raises(Exception, match="query vector is not finite: 2"):
        nn.knn_classify(q, t, 1).collect()


def test_null_folds_exclude_each_other(spark):
    q, t = _sides(spark, [[i, 0] for i in range(12)], fold=lambda i: None if i % 3 == 0 else i % 2)
    for r in nn.knn_candidates(q, t, 2, exclude="fold").collect():
        assert r.qid != r.tid and not (r.qid % 3 == 0 and r.tid % 3 == 0)


def test_columns_do_not_depend_on_the_number_of_blocks(spark):
    q, t = _sides(spark, [[i, 0] for i in range(300)], fold=lambda i: i % 2)
    one = nn.knn_candidates(q, t, 2, exclude="fold", carry=["fold"])
    many = nn.knn_candidates(q, t, 2, exclude="fold", carry=["fold"], block_rows=64)
    assert one.columns == many.columns == ["qid", "qlabel", "tid", "tlabel", "dist", "rank", "fold"]
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_kernel_memory_is_bounded_on_equal_and_shifted_vectors():
    import tracemalloc
    rng = np.random.default_rng(0)
    for q, t in ((np.ones((2048, 784)),) * 2, (rng.normal(size=(2048, 64)) + 1e6, rng.normal(size=(2048, 64)) + 1e6)):
        tracemalloc.start()
        rows, cols, dist, rank = nn.block_top_k(q, t, np.arange(len(t)), 5)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 160 << 20, peak
        assert len(rows) == 5 * len(q)
    brute = ((q[7] - t) ** 2).sum(axis=1)
    assert set(cols[rows == 7]) == set(np.lexsort((np.arange(len(t)), brute))[:5])


def test_small_blocks_travel_together(spark):
    """Copies of queries and train rows grow with the tiles, not with the small blocks."""
    assert nn.tile_counts(240_000, 960_000, 64, 131_072, 12) == (2, 8)
    assert nn.tile_counts(400, 1600, 64, 131_072, 1) == (1, 4)
    assert nn.tile_counts(400, 60, 64, 131_072, 1) == (1, 1)
    _, _, _, qdf, tdf = _random_sides(spark, n_q=40, n_t=1200)
    plan = nn.knn_candidates(qdf, tdf, 3, block_rows=8)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroups" not in plan and "sequence(0, 149" not in plan
    groups = {(r.qid, r.tid, r.dist, r["rank"]) for r in nn.knn_candidates(qdf, tdf, 3, block_rows=8).collect()}
    assert groups == {(r.qid, r.tid, r.dist, r["rank"]) for r in nn.knn_candidates(qdf, tdf, 3).collect()}


@pytest.mark.parametrize("shape", ["plain", "offset", "equal", "outlier", "tiny"])
def test_passing_train_rows_keep_the_nearest(shape):
    rng = np.random.default_rng(11)
    q, t = rng.normal(size=(60, 16)), rng.normal(size=(900, 16))
    if shape == "offset":
        q, t = q + 1e6, t + 1e6
    elif shape == "equal":
        q, t = np.ones_like(q), np.ones_like(t)
    elif shape == "outlier":
        q[0], t[5], t[6] = 1e9, -1e12, 1e9
    elif shape == "tiny":
        q, t = q * 1e-120, t * 1e-120
    t[300:400] = t[100:200]
    t = t[np.argsort(-((t - q[7]) ** 2).sum(axis=1), kind="stable")]  # ever nearer ones
    tids = rng.permutation(900)
    qx, tx = rng.integers(0, 3, 60), rng.integers(0, 3, 900)
    for b, sides in ((None, (None, None)), (qx[:, None] == tx[None, :], (qx, tx))):
        best = nn.NearestRows(q, 7, sides[0])
        for at in range(0, 900, 250):
            own = slice(at, at + 250)
            best.see(t[own], tids[own], np.zeros(900, dtype=np.int64)[own], None if b is None else tx[own], 64)
        want = _direct_top_k(q, t, tids, 7, b)
        assert best.dist.ravel().tolist() == [w[2] for w in want]
        assert best.tid.ravel().tolist() == [int(tids[w[1]]) for w in want]
