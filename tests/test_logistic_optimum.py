import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import logistic_optimum as lo
from quarry.operators import models as ml

REG = 0.05


def data(n=300, d=4, classes=3, seed=1):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, classes, n)
    return rng.normal(0, 1, (n, d)) + 0.8 * np.eye(classes, d)[y], y


def frame(spark, x, y, parts=5):
    rows = [(i, int(c), v.tolist()) for i, (v, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, label int, vec array<double>").repartition(parts)


def objective(x, y, c, w):
    side = np.where(y == c, 1.0, -1.0)
    return np.logaddexp(0, -side * (x @ w[:-1] + w[-1])).mean() + REG / 2 * w[:-1] @ w[:-1]


def test_loss_gradient_and_hessian_match_differences(spark, monkeypatch):
    x, y = data()
    df = frame(spark, x, y).unionByName(spark.createDataFrame([(900, None, [1.0] * 4), (901, 1, None)], "id long, label int, vec array<double>"))
    weights = {c: np.random.default_rng(c).normal(0, 1, 5) for c in range(3)}
    whole = lo.losses_at(df, weights, REG)
    monkeypatch.setattr(lo, "TASK_BYTES", 1)  # one class a pass
    for fits in (whole, lo.losses_at(df, weights, REG)):
        assert [f.label for f in fits] == [0, 1, 2] and {f.n for f in fits} == {300}
        for f in fits:
            w, eps = weights[f.label], 1e-5
            assert f.loss == pytest.approx(objective(x, y, f.label, w), abs=1e-12)
            slope = [(objective(x, y, f.label, w + e) - objective(x, y, f.label, w - e)) / (2 * eps) for e in eps * np.eye(5)]
            assert np.allclose(f.gradient, slope, atol=1e-8)
            curve = [[(objective(x, y, f.label, w + a + b) - objective(x, y, f.label, w + a - b) - objective(x, y, f.label, w - a + b)
                       + objective(x, y, f.label, w - a - b)) / 4e-6 for a in 1e-3 * np.eye(5)] for b in 1e-3 * np.eye(5)]
            assert np.allclose(f.hessian, curve, atol=1e-5)


@pytest.mark.parametrize("start", [0.0, 30.0])
def test_optimum_from_any_start_and_mllib_reaches_it(spark, start):
    x, y = data()
    df = frame(spark, x, y)
    best = lo.optimum(df, {c: np.full(5, start) for c in range(3)}, REG)
    assert max(np.abs(f.gradient).max() for f in best) < 1e-7
    rows = ml.assemble_features(df, "vec", "features", keep=["label"]).withColumn("label", F.col("label").cast("double"))
    model = ml.ovr_logistic(tol=1e-12, reg_param=REG, standardize=False).fit(rows)
    weights = lo.fitted_weights(model)
    for f in best:
        assert np.allclose(f.weights, weights[f.label], atol=1e-4)
        assert 0 <= objective(x, y, f.label, weights[f.label]) - f.loss + 1e-15 < 1e-8
    # a fit that was stopped early is told apart
    early = lo.losses_at(df, lo.fitted_weights(ml.ovr_logistic(max_iter=1, reg_param=REG, standardize=False).fit(rows)), REG)
    assert all(e.slope() > 1e-4 and e.loss - f.loss > 1e-6 for e, f in zip(early, best))


def test_predictions_take_the_greatest_margin(spark):
    x, y = data()
    df = frame(spark, x, y).unionByName(spark.createDataFrame([(901, 1, None)], "id long, label int, vec array<double>"))
    best = lo.optimum(df, {c: np.zeros(5) for c in range(3)}, REG)
    got = {r.id: r.predicted for r in lo.predict(df, best).collect()}
    margins = np.column_stack([x @ f.weights[:-1] + f.weights[-1] for f in best])
    assert got == dict(enumerate(margins.argmax(axis=1).tolist()))
    assert np.mean(margins.argmax(axis=1) == y) > 0.45
    tied = [lo.Fit(c, 1, np.zeros(5), 0.0, np.zeros(5), np.eye(5)) for c in (4, 7)]
    assert {r.predicted for r in lo.predict(df, tied).collect()} == {4}


def test_a_label_of_a_third_of_the_rows_in_one_partition(spark):
    x, y = data(900)
    y[: 300] = 0
    apart, one = (lo.optimum(frame(spark, x, y, p), {c: np.zeros(5) for c in range(3)}, REG) for p in (40, 1))
    assert all(np.allclose(a.weights, b.weights, atol=1e-7) for a, b in zip(apart, one))


def test_tables_without_an_optimum(spark):
    df = frame(spark, np.array([[-1.0], [1.0]]), np.array([0, 1]))
    assert lo.losses_at(df.limit(0), {0: np.zeros(2)}, REG) == []
    assert lo.optimum(df.limit(0), {0: np.zeros(2)}, REG) == []
    with pytest.raises(ValueError):  # told apart entirely and without a penalty
        lo.optimum(df, {1: np.zeros(2)}, 0.0, max_passes=8)
    with pytest.raises(ValueError):
        lo.predict(df, [])
