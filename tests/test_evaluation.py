from quarry.operators import evaluation as ev

# The stored 10x10 confusion matrix of the original KNN run
# (row = predicted class, column = actual class), 100 test rows, 98 correct.
GOLDEN_MATRIX = [
    [8, 0, 0, 0, 1, 0, 0, 0, 0, 0],
    [0, 14, 0, 0, 0, 0, 0, 0, 0, 0],
    [0, 0, 8, 0, 0, 0, 0, 0, 0, 0],
    [0, 0, 0, 11, 0, 0, 0, 0, 0, 0],
    [0, 0, 0, 0, 12, 0, 0, 0, 0, 0],
    [0, 0, 0, 0, 0, 7, 0, 0, 0, 0],
    [0, 0, 0, 0, 0, 0, 10, 0, 0, 0],
    [0, 0, 0, 0, 0, 0, 0, 15, 0, 0],
    [0, 0, 0, 0, 0, 0, 0, 0, 2, 0],
    [0, 0, 0, 0, 1, 0, 0, 0, 0, 11],
]


def golden_predictions(spark):
    rows = [(a, p) for p, row in enumerate(GOLDEN_MATRIX) for a, n in enumerate(row) for _ in range(n)]
    return spark.createDataFrame(rows, "actual int, predicted int")


def test_error_count_and_accuracy(spark):
    pred = golden_predictions(spark)
    assert ev.error_count(pred).first().errors == 2
    acc = ev.accuracy(pred).first()
    assert (acc.n, acc.errors, acc.accuracy) == (100, 2, 0.98)
    assert ev.prediction_count(pred).first().n == 100
    fixed = ev.accuracy(pred, total=10000).first()
    assert fixed.accuracy == (10000 - 2) / 10000


def test_confusion_matrix_reproduces_golden(spark):
    m = ev.confusion_matrix(golden_predictions(spark), 10)
    assert m.count() == 100
    cells = {(r.predicted, r.actual): r.n for r in m.collect()}
    assert all(cells[(p, a)] == GOLDEN_MATRIX[p][a] for p in range(10) for a in range(10))
    assert sum(cells.values()) == 100
    wide = {r.predicted: [r[f"actual_{j}"] for j in range(10)] for r in ev.confusion_wide(m, 10).collect()}
    assert [wide[p] for p in range(10)] == GOLDEN_MATRIX


def test_class_metrics_standard_and_compat(spark):
    pred = golden_predictions(spark)
    std = {r.label: r for r in ev.class_metrics(pred, 10).collect()}
    cmp_ = {r.label: r for r in ev.class_metrics(pred, 10, compat=True).collect()}
    assert (std[4].precision, std[4].recall, std[4].f_measure, std[4].support) == (1.0, 0.857, 0.923, 14)
    assert (cmp_[4].precision, cmp_[4].recall, cmp_[4].f_measure, cmp_[4].support) == (0.857, 1.0, 0.462, 12)
    assert (std[0].precision, std[0].recall, std[0].f_measure, std[0].support) == (0.889, 1.0, 0.941, 8)
    assert (cmp_[0].precision, cmp_[0].recall, cmp_[0].f_measure, cmp_[0].support) == (1.0, 0.889, 0.471, 9)
    assert all(r.tp + r.fp + r.fn + r.tn == 100 for r in std.values())


def test_metrics_from_matrix_equal_metrics_from_rows(spark):
    pred = golden_predictions(spark)
    m = ev.confusion_matrix(pred, 10)
    for compat in (False, True):
        a = sorted(map(tuple, ev.metrics_from_matrix(m, compat).collect()))
        b = sorted(map(tuple, ev.class_metrics(pred, 10, compat).collect()))
        assert a == b


def test_never_predicted_class_gives_null_ratio(spark):
    pred = spark.createDataFrame([(0, 1), (1, 1)], "actual int, predicted int")
    rows = {r.label: r for r in ev.class_metrics(pred, 3).collect()}
    assert rows[0].precision is None and rows[0].recall == 0.0
    assert rows[2].precision is None and rows[2].recall is None and rows[2].support == 0


def test_merge_confusion_and_mean_fold_accuracy(spark):
    pred = spark.createDataFrame([(0, 0, 0), (0, 1, 0), (1, 1, 1), (1, 0, 1), (1, 1, 1), (1, 1, 0)],
                                 "fold int, actual int, predicted int")
    merged = {(r.predicted, r.actual): r.n for r in ev.merge_confusion(ev.per_fold_confusion(pred)).collect()}
    assert merged == {(0, 0): 1, (0, 1): 2, (1, 0): 1, (1, 1): 2}
    parts = [ev.confusion_matrix(pred.where(f"fold = {i}"), 2) for i in (0, 1)]
    listed = {(r.predicted, r.actual): r.n for r in ev.merge_confusion(parts).collect()}
    assert {k: v for k, v in listed.items() if v} == merged
    mfa = ev.mean_fold_accuracy(pred).first()
    assert mfa.n_folds == 2 and abs(mfa.mean_accuracy - (0.5 + 0.5) / 2) < 1e-12


def test_accuracy_from_matrix_and_null_labels(spark):
    pred = spark.createDataFrame([(0, 0), (None, 1), (2, None), (None, None), (3, 3)], "actual int, predicted int")
    a, b = ev.accuracy(pred).first(), ev.accuracy_from_matrix(ev.confusion_matrix(pred, 2)).first()
    assert tuple(a) == tuple(b) == (5, 2, 0.6)
    wide = ev.confusion_wide(ev.confusion_matrix(pred, 2), 2)
    assert sum(sum(v or 0 for k, v in r.asDict().items() if k != "predicted") for r in wide.collect()) == 5


def test_show_metrics_prints_every_class(spark, capsys):
    pred = spark.range(150).selectExpr("cast(id as int) as actual", "cast(id as int) as predicted")
    ev.show_metrics(ev.class_metrics(pred, 10))
    assert "|149  |" in capsys.readouterr().out
