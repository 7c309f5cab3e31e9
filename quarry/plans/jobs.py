"""End-to-end jobs over files: the same inputs and outputs as the original
programs, composed from the operators.

Each job reads its input paths, runs distributed, and writes its outputs
under ``output`` (paths on shared storage). Predictions are written once and
read back before they are evaluated: the written table cuts the lineage, so
the evaluations never recompute the classifier, and a lost executor cannot
change what is evaluated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.scalars import date_key
from quarry.operators import evaluation as ev
from quarry.operators import models as ml
from quarry.operators import neighbors as nn
from quarry.operators import trending as tr
from quarry.sources import csv as csvio
from quarry.sources import text as textio

PREDICTION_SCHEMA = "qid bigint, actual int, predicted int"


def overlap_job(spark: SparkSession, input_path: str, output_path: str, market1: str, market2: str,
                n_files: int = 3, raw_lines: bool = False, multiline: bool = False) -> DataFrame:
    """Per-category overlap of two markets -> ``category<TAB>total ...`` text
    in ``n_files`` hash-partitioned files. Returns the overlap table."""
    obs = (textio.read_observation_lines(spark, input_path) if raw_lines
           else textio.read_observations(spark, input_path, multiline=multiline))
    overlap = tr.category_overlap(obs, market1, market2)
    textio.write_keyed_text(tr.category_overlap_text(overlap, market2), "category", "line", output_path, n_files)
    return overlap


def growth_job(spark: SparkSession, input_path: str, output_path: str, threshold: int = 1000,
               zero_base: str = "null", raw_lines: bool = True, multiline: bool = False) -> DataFrame:
    """Early growth per (market, item) from the two earliest dated rows ->
    globally sorted report lines (market desc, growth desc). Rows tied on
    date are ordered by their view count, so the result never depends on
    arrival order. Returns the report table."""
    obs = (textio.read_observation_lines(spark, input_path) if raw_lines
           else textio.read_observations(spark, input_path, multiline=multiline))
    obs = obs.withColumn("date_key", date_key("obs_date"))
    g = tr.growth_first_two(obs, keys=("market", "item_id"), date="date_key", views="views",
                            tiebreak="views", zero_base=zero_base)
    report = tr.growth_report(g, threshold)
    textio.write_sorted_text(report, [F.col("market").desc(), F.col("pct_trunc").desc(), F.col("item_id")],
                             "line", output_path)
    return report


def read_samples(spark: SparkSession, path: str, n_features: int | None, label_first: bool,
                  id_col: str) -> DataFrame:
    """Labelled CSV with a row id: the position-derived id of the file scan
    (file splits and their row order are fixed, so the id is reproducible).
    ``_place`` orders the rows by file name, then by place in the file."""
    df = csvio.read_labelled_csv(spark, path, n_features, label_first)
    row = F.monotonically_increasing_id()
    return df.withColumn("_place", F.struct(F.input_file_name().alias("file"), F.input_file_block_start().alias("block"), row.alias("row"))
                         ).withColumn(id_col, row)


def _evaluate(spark: SparkSession, pred_path: str, output: str, n_classes: int, compat: bool) -> dict:
    pred = spark.read.option("header", True).schema(PREDICTION_SCHEMA).csv(pred_path)
    matrix = _store_matrix(pred, output, n_classes)
    return {"predictions": pred, "accuracy": ev.accuracy_from_matrix(matrix), "confusion": matrix,
            "metrics": ev.metrics_from_matrix(matrix, compat)}


def _store_matrix(pred: DataFrame, output: str, n_classes: int) -> DataFrame:
    """The matrix of the predictions, counted once and written; every report reads the written one."""
    counted = ev.confusion_matrix(pred, n_classes).cache()  # one row per cell
    csvio.write_confusion_csv(ev.confusion_wide(counted, n_classes), f"{output}/confusion")
    counted.unpersist()
    return csvio.read_confusion_csv(pred.sparkSession, f"{output}/confusion")


def knn_job(spark: SparkSession, test_path: str, train_path: str, output: str, dim: int = 10, k: int = 5,
            n_features: int | None = None, label_first: bool = True, n_classes: int = 10,
            compat: bool = False, block_rows: int | None = None) -> dict:
    """PCA (fit on train) + exact KNN + vote; writes predictions and the
    confusion matrix, returns the evaluation frames."""
    test = read_samples(spark, test_path, n_features, label_first, "qid")
    train = read_samples(spark, train_path, n_features, label_first, "tid")
    arr = ml.vector_as_array("features")
    q = test.select("qid", F.col("label").alias("qlabel"), arr.alias("qvec"))
    t = train.select("tid", F.col("label").alias("tlabel"), arr.alias("tvec"))
    pred = ml.pca_knn_classify(t, q, dim, k, block_rows=block_rows) if dim else \
        nn.knn_classify(q, t, k, block_rows=block_rows)
    csvio.write_predictions(pred.select("qid", "actual", "predicted"), f"{output}/predictions")
    return _evaluate(spark, f"{output}/predictions", output, n_classes, compat)


CLASSIFIERS = {
    "logistic": lambda p: ml.ovr_logistic(**p),
    "svm": lambda p: ml.ovr_linear_svm(**p),
    "bayes": lambda p: ml.naive_bayes(**p),
    "mlp": lambda p: ml.mlp(**p),
}


def classifier_job(spark: SparkSession, test_path: str, train_path: str, output: str, model: str,
                   params: dict | None = None, pca_k: int | None = 200, n_features: int | None = None,
                   label_first: bool = False, n_classes: int = 10, compat: bool = False) -> dict:
    """Optional PCA + one MLlib classifier (``logistic``, ``svm``, ``bayes``,
    ``mlp``); writes predictions and the confusion matrix."""
    test = read_samples(spark, test_path, n_features, label_first, "qid")
    train = read_samples(spark, train_path, n_features, label_first, "tid")
    est = CLASSIFIERS[model](params or {})
    pred = ml.classify(est, train, test, pca_k, keep=["qid"])
    csvio.write_predictions(pred.select("qid", "actual", "predicted"), f"{output}/predictions")
    return _evaluate(spark, f"{output}/predictions", output, n_classes, compat)


def cross_validation_job(spark: SparkSession, train_path: str, output: str, n_folds: int = 10,
                         fold_size: int | None = None, pca_k: int | None = 200,
                         layers: Sequence[int] = (200, 150, 150, 10), max_iter: int = 400,
                         n_features: int | None = None, label_first: bool = False, n_classes: int = 10,
                         compat: bool = False) -> dict:
    """Contiguous k-fold cross-validation of the MLP in file order; writes
    all held-out predictions (with their fold) and the merged confusion
    matrix, returns the mean fold accuracy too."""
    df = read_samples(spark, train_path, n_features, label_first, "qid")
    folded = ml.contiguous_folds(df, "_place", n_folds, fold_size)
    pred = ml.cross_validate(folded, lambda: ml.mlp(layers, max_iter), n_folds, pca_k=pca_k, keep=["qid"])
    pred.write.mode("overwrite").option("header", True).csv(f"{output}/predictions")
    back = spark.read.option("header", True).schema(
        T.StructType([T.StructField("fold", T.IntegerType()), T.StructField("qid", T.LongType()),
                      T.StructField("actual", T.IntegerType()), T.StructField("predicted", T.IntegerType())])
    ).csv(f"{output}/predictions")
    matrix = _store_matrix(back, output, n_classes)
    return {"predictions": back, "merged_confusion": ev.merge_confusion(ev.per_fold_confusion(back, "fold", n_classes)),
            "mean_accuracy": ev.mean_fold_accuracy(back), "metrics": ev.metrics_from_matrix(matrix, compat)}
