"""End-to-end jobs on files derived from the driver tables."""

from pyspark.sql import functions as F

from quarry.plans import catalog
from quarry.plans import fixtures as fx
from quarry.plans import jobs
from quarry.session import scratch_path
from quarry.sources import csv as csvio
from quarry.sources import text as textio

from sf_paths import SF0001


def test_overlap_job_matches_query(spark):
    src, out = scratch_path(spark, "job-in"), scratch_path(spark, "job-out")
    obs = fx.overlap_observations(spark, SF0001)
    textio.write_observations(obs, {"item_id": F.col("item_id"), "category": F.col("category"),
                                   "market": F.col("market")}, src)
    jobs.overlap_job(spark, src, out, fx.MARKET_1, fx.MARKET_2)
    got = sorted(map(tuple, textio.read_keyed_text(spark, out, "category", "line").collect()))
    want = sorted(map(tuple, catalog.q_category_overlap_text(spark, SF0001).collect()))
    assert got == want and len(got) == 5
    raw_out = scratch_path(spark, "job-out")
    jobs.overlap_job(spark, src, raw_out, fx.MARKET_1, fx.MARKET_2, raw_lines=True)
    assert sorted(map(tuple, textio.read_keyed_text(spark, raw_out, "category", "line").collect())) == want


def test_growth_job_writes_sorted_report(spark):
    src, out = scratch_path(spark, "job-in"), scratch_path(spark, "job-out")
    o = fx.table(spark, SF0001, "orders")
    textio.write_observations(o, {"item_id": F.col("o_custkey"), "obs_date": F.date_format("o_orderdate", "yy.dd.MM"),
                                 "views": F.floor("o_totalprice").cast("bigint"),
                                 "market": F.col("o_orderpriority")}, src)
    report = jobs.growth_job(spark, src, out)
    lines = [r.value for r in spark.read.text(out).collect()]
    assert len(lines) == report.count() > 0
    want = {r.line for r in catalog.q_growth_from_lines(spark, SF0001).collect()}
    assert set(lines) == want


def _sample_files(spark, sf_dir, separable=False, label_first=True):
    if separable:
        e = fx.separable_embeddings(spark, sf_dir).withColumnRenamed("feat_array", "vec")
    else:
        e = fx.embeddings(spark, sf_dir)
    test, train = fx.holdout(e)
    paths = []
    for part in (test, train):
        p = scratch_path(spark, "samples")
        csvio.write_labelled_csv(part.orderBy("vec_id").coalesce(1), "label", "vec", p, label_first)
        paths.append(p)
    return paths


def test_knn_job_matches_query(spark):
    test_path, train_path = _sample_files(spark, SF0001)
    out = scratch_path(spark, "knn-job")
    res = jobs.knn_job(spark, test_path, train_path, out, dim=None, k=5, n_features=64)
    got = sorted((r.actual, r.predicted) for r in res["predictions"].collect())
    want = sorted((r.actual, r.predicted) for r in catalog.q_knn_predict(spark, SF0001).collect())
    assert got == want
    stored = csvio.read_confusion_csv(spark, f"{out}/confusion")
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, res["confusion"].collect()))
    assert res["accuracy"].first().n == len(want)
    pca = jobs.knn_job(spark, test_path, train_path, scratch_path(spark, "knn-job"), dim=10, k=5)
    assert pca["predictions"].count() == len(want)


def test_classifier_job_bayes_and_label_last(spark):
    test_path, train_path = _sample_files(spark, SF0001, separable=True, label_first=False)
    res = jobs.classifier_job(spark, test_path, train_path, scratch_path(spark, "clf-job"), "bayes",
                              pca_k=None, n_features=64, label_first=False)
    acc = res["accuracy"].first()
    assert acc.n == 100 and acc.accuracy >= 0.95
    assert res["metrics"].count() == 10


def test_cross_validation_job(spark):
    _, train_path = _sample_files(spark, SF0001, separable=True, label_first=False)
    res = jobs.cross_validation_job(spark, train_path, scratch_path(spark, "cv-job"), n_folds=4, pca_k=16,
                                    layers=(16, 12, 10), max_iter=50, n_features=64)
    pred = res["predictions"].collect()
    assert len(pred) == 400 and len({r.qid for r in pred}) == 400
    assert res["mean_accuracy"].first().n_folds == 4
    assert res["merged_confusion"].agg(F.sum("n")).first()[0] == 400


def test_command_line_overlap_and_growth(spark):
    from quarry.__main__ import main
    src = scratch_path(spark, "cli-in")
    obs = fx.overlap_observations(spark, SF0001)
    textio.write_observations(obs, {"item_id": F.col("item_id"), "category": F.col("category"),
                                   "market": F.col("market")}, src)
    out = scratch_path(spark, "cli-out")
    assert main(["overlap", src, out, fx.MARKET_1, fx.MARKET_2]) == 0
    assert textio.read_keyed_text(spark, out).count() == 5
    out2 = scratch_path(spark, "cli-out")
    assert main(["growth", src, out2, "--threshold", "0"]) == 0
    assert spark.read.text(out2).count() >= 0


def test_command_line_knn_and_classify(spark, capsys):
    from quarry.__main__ import main
    test_path, train_path = _sample_files(spark, SF0001)
    out = scratch_path(spark, "cli-knn")
    assert main(["knn", test_path, train_path, out, "--dim", "0", "--k", "5", "--features", "64"]) == 0
    stored = csvio.read_confusion_csv(spark, f"{out}/confusion")
    assert stored.agg(F.sum("n")).first()[0] == 100
    s_test, s_train = _sample_files(spark, SF0001, separable=True, label_first=False)
    out2 = scratch_path(spark, "cli-clf")
    assert main(["classify", s_test, s_train, out2, "--model", "bayes", "--pca", "0", "--features", "64",
                 "--label-last"]) == 0
    assert "accuracy" in capsys.readouterr().out


def test_command_line_cross_validation(spark, capsys):
    from quarry.__main__ import main
    _, train_path = _sample_files(spark, SF0001, separable=True, label_first=False)
    out = scratch_path(spark, "cli-cv")
    assert main(["cv", train_path, out, "--folds", "3", "--pca", "16", "--features", "64",
                 "--layers", "16,12,10", "--max-iter", "40"]) == 0
    assert spark.read.option("header", True).csv(f"{out}/predictions").count() == 400
    assert "mean_accuracy" in capsys.readouterr().out
