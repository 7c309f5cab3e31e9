import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from quarry.operators import fold_statistics as fs
from quarry.operators import models as ml


def frame(spark, x, folds, parts=5):
    rows = [(i, f, int(v[0] > v[1]), v.tolist()) for i, (v, f) in enumerate(zip(x, folds))]
    return spark.createDataFrame(rows, "id long, fold int, label int, vec array<double>").repartition(parts)


@pytest.mark.parametrize("d,block,offset", [(3, 256, 0.0), (7, 2, 1e6), (40, 16, -3.0)])
def test_moments_match_numpy(spark, monkeypatch, d, block, offset):
    monkeypatch.setattr(fs, "BLOCK", block)
    rng = np.random.default_rng(d)
    x = rng.normal(offset, 1, (300, d)) * np.linspace(1, 3, d)
    folds = [None if i % 11 == 0 else int(f) for i, f in enumerate(rng.choice(4, 300, p=[0.7, 0.1, 0.1, 0.1]))]
    got = fs.training_moments(fs.fold_moments(frame(spark, x, folds), "vec"))
    assert sorted(got) == [0, 1, 2, 3]
    for f, m in got.items():
        rest = x[[v != f for v in folds]]
        assert m.n == len(rest) and np.allclose(m.mean(), rest.mean(axis=0), rtol=1e-12)
        assert np.allclose(m.covariance(), np.cov(rest.T), rtol=1e-8, atol=1e-9)


def test_components_equal_a_fit_per_fold(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (400, 12)) @ rng.normal(0, 1, (12, 12))
    df = frame(spark, x, [i % 5 for i in range(400)])
    for f, m in fs.training_moments(fs.fold_moments(df, "vec")).items():
        model = ml.fit_pca(ml.assemble_features(df.where(F.col("fold") != f), "vec"), 4)
        vectors, values = m.components(4)
        want = model.pc.toArray()
        assert np.allclose(np.abs((vectors * want).sum(axis=0)), 1, atol=1e-9)
        assert np.allclose(values / np.trace(m.covariance()), model.explainedVariance.toArray(), atol=1e-9)
        held = {r.id: r.vec for r in fs.project(df.where(F.col("fold") == f), "vec", vectors).collect()}
        assert len(held) == 80 and all(np.allclose(held[i], x[i] @ vectors, atol=1e-9) for i in held)


def test_the_features_are_read_once(spark, tmp_path):
    frame(spark, np.ones((50, 3)), [i % 2 for i in range(50)]).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    scans = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            scans.add(b.num_rows)
            yield b

    fs.fold_moments(df.mapInArrow(count, df.schema), "vec")
    assert scans.value <= 50 + 50  # the pass, and what first() took for the centre


def test_cross_validation_on_shared_moments(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0, 1, (240, 6))
    x[:, 0] *= 5
    df = frame(spark, x, [None if i == 7 else i % 4 for i in range(240)])
    make = lambda: LogisticRegression(maxIter=30)
    one = ml.cross_validate(ml.assemble_features(df, "vec", keep=["id", "fold", "label"]), make, 4, pca_k=3, keep=["id"])
    two = ml.cross_validate_arrays(df, make, 4, pca_k=3, vec_col="vec", keep=["id"])
    rows = lambda p: {r.id: (r.fold, r.actual, r.predicted) for r in p.collect()}
    assert rows(one) == rows(two) and len(rows(two)) == 239


def test_nulls_small_folds_and_empty_tables(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (0, None), (1, [3.0, 5.0])], "fold int, vec array<double>")
    got = fs.training_moments(fs.fold_moments(df, "vec"))
    assert (got[0].n, got[1].n) == (1, 1) and np.isnan(got[0].covariance()).all()
    assert fs.fold_moments(df.limit(0), "vec") == {} and fs.training_moments({}) == {}


def test_principal_components_match_a_fit(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(0, 1, (200, 9)) @ rng.normal(0, 1, (9, 9)) + 50
    df = frame(spark, x, [0] * 200).unionByName(spark.createDataFrame([(-1, 0, 0, None)], "id long, fold int, label int, vec array<double>"))
    got = fs.principal_components(df, "vec", 3).orderBy("component", "i").collect()
    values, vectors = np.linalg.eigh(np.cov(x.T))
    assert len(got) == 27 and all(r.loading > 0 for r in got if abs(r.loading) == max(abs(o.loading) for o in got if o.component == r.component))
    for c in range(3):
        own = np.array([r.loading for r in got if r.component == c])
        assert abs(abs(own @ vectors[:, -1 - c]) - 1) < 1e-9 and abs(got[9 * c].variance - values[-1 - c]) < 1e-8
    assert fs.principal_components(df.limit(0), "vec", 3).count() == 0
