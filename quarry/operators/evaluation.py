"""Evaluation of predictions: errors, accuracy, confusion matrices and
per-class metrics.

Every operator is a (partial + final) aggregate over the prediction rows, so
a hot class is combined map-side. Results are small by construction: the
confusion matrix has one row per (predicted, actual) pair of classes and the
metric table one row per class.

Matrix orientation: row = predicted class, column = actual class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def error_count(pred: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Predictions that differ from the label (NULL-safe)."""
    return pred.agg(F.count_if(~F.col(actual).eqNullSafe(F.col(predicted))).cast("bigint").alias("errors"))


def prediction_count(pred: DataFrame) -> DataFrame:
    return pred.agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def accuracy(pred: DataFrame, actual: str = "actual", predicted: str = "predicted",
             total: int | None = None) -> DataFrame:
    """``n, errors, accuracy = (n - errors) / n`` with ``n`` counted.

    ``total`` replaces the counted ``n`` in the ratio by a fixed row count,
    as the original reports did (their accuracy is wrong whenever the count
    differs)."""
    hit = F.col(actual).eqNullSafe(F.col(predicted))
    denom = F.lit(float(total)) if total is not None else F.col("n").cast("double")
    num = (F.lit(total) if total is not None else F.col("n")) - F.col("errors")
    return pred.agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                    F.count_if(~hit).cast("bigint").alias("errors")).select(
        "n", "errors", F.try_divide(num.cast("double"), denom).alias("accuracy"))


def accuracy_from_matrix(matrix: DataFrame) -> DataFrame:
    """``n, errors, accuracy`` of the predictions that a long-form matrix counts."""
    wrong = F.sum(F.when(F.col("predicted").eqNullSafe(F.col("actual")), 0).otherwise(F.col("n")))
    return matrix.agg(F.sum("n").cast("bigint").alias("n"), wrong.cast("bigint").alias("errors")).select(
        "n", "errors", F.try_divide((F.col("n") - F.col("errors")).cast("double"), F.col("n").cast("double")).alias("accuracy"))


def _class_grid(spark: SparkSession, n_classes: int) -> DataFrame:
    """All (predicted, actual) cells of an n x n matrix with count 0, without a
    cross join (``n_classes ** 2`` rows)."""
    n = n_classes
    return spark.range(n * n).select((F.col("id") / n).cast("int").alias("predicted"),
                                     (F.col("id") % n).cast("int").alias("actual"),
                                     F.lit(0).cast("bigint").alias("n"))


def confusion_matrix(pred: DataFrame, n_classes: int = 10, actual: str = "actual",
                     predicted: str = "predicted") -> DataFrame:
    """Long form ``predicted, actual, n`` with every cell of the
    ``n_classes`` grid (zeros included); labels outside the grid are kept."""
    counts = pred.groupBy(F.col(predicted).cast("int").alias("predicted"),
                          F.col(actual).cast("int").alias("actual")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))
    grid = _class_grid(pred.sparkSession, n_classes)
    return counts.unionByName(grid).groupBy("predicted", "actual").agg(F.sum("n").cast("bigint").alias("n"))


#: More distinct labels than this are no classes; a matrix of them is refused.
MAX_CLASSES = 10_000


def class_labels(matrix: DataFrame, n_classes: int = 10) -> list[int | None]:
    """All labels of a matrix in order: ``0..n_classes-1`` and every other label
    that occurs as predicted or actual, NULL last. One row per label reaches
    the driver, at most ``MAX_CLASSES``."""
    labels = matrix.select(F.explode(F.array("predicted", "actual")).alias("l")).distinct()
    found = {r["l"] for r in labels.limit(MAX_CLASSES + 1).collect()} | set(range(n_classes))
    if len(found) > MAX_CLASSES:
        raise ValueError(f"over {MAX_CLASSES} distinct labels: these are no classes")
    return sorted(found - {None}) + ([None] if None in found else [])


def confusion_wide(matrix: DataFrame, n_classes: int = 10, prefix: str = "actual_",
                   labels: list[int | None] | None = None) -> DataFrame:
    """Wide form: one row per predicted class, one count column per actual
    class (``actual_0 ..``, ``actual_null`` for a missing label). The classes
    come from the data (``class_labels``) unless they are given, so no
    prediction is left out: all cells sum up to the matrix."""
    labels = class_labels(matrix, n_classes) if labels is None else labels
    cells = [F.sum(F.when(F.col("actual").eqNullSafe(F.lit(j)), F.col("n")).otherwise(0)).cast("bigint")
             .alias(f"{prefix}{'null' if j is None else j}") for j in labels]
    return matrix.groupBy("predicted").agg(*cells)


def merge_confusion(matrices: DataFrame | list[DataFrame]) -> DataFrame:
    """Cell-wise sum of several long-form matrices (a list, or one frame with
    any extra key such as ``fold``)."""
    if isinstance(matrices, list):
        m = matrices[0]
        for other in matrices[1:]:
            m = m.unionByName(other.select(*m.columns))
    else:
        m = matrices
    return m.groupBy("predicted", "actual").agg(F.sum("n").cast("bigint").alias("n"))


def per_fold_confusion(pred: DataFrame, fold: str = "fold", n_classes: int = 10) -> DataFrame:
    """Long-form matrix per fold: ``fold, predicted, actual, n``."""
    return pred.groupBy(F.col(fold), F.col("predicted").cast("int").alias("predicted"),
                        F.col("actual").cast("int").alias("actual")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


def mean_fold_accuracy(pred: DataFrame, fold: str = "fold", actual: str = "actual",
                       predicted: str = "predicted") -> DataFrame:
    """Plain mean of the per-fold accuracies: ``n_folds, mean_accuracy``."""
    hit = F.col(actual).eqNullSafe(F.col(predicted)).cast("double")
    per_fold = pred.groupBy(fold).agg(F.avg(hit).alias("acc"))
    return per_fold.agg(F.count(F.lit(1)).cast("bigint").alias("n_folds"),
                        F.avg("acc").alias("mean_accuracy"))


def class_counts(pred: DataFrame, n_classes: int = 10, actual: str = "actual",
                 predicted: str = "predicted") -> DataFrame:
    """Per class: ``tp``, ``n_actual`` (column sum), ``n_pred`` (row sum), and
    ``total`` (all predictions). The cells that occur are counted once; classes
    without predictions join as one row each, not as a grid."""
    cells = pred.groupBy(F.col(predicted).cast("int").alias("predicted"), F.col(actual).cast("int").alias("actual")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))
    return class_counts_from_matrix(cells, n_classes)


def class_counts_from_matrix(matrix: DataFrame, n_classes: int = 0) -> DataFrame:
    """The same per-class counts from a long-form matrix ``predicted, actual, n``
    and the classes ``0..n_classes-1``."""
    rows = matrix.select(F.explode(F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("is_a"), F.lit(0).cast("bigint").alias("is_p"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("predicted").alias("label"), F.lit(0).cast("bigint").alias("is_a"), F.col("n").alias("is_p"),
                 F.lit(0).cast("bigint").alias("tp")))).alias("r")).select("r.*")
    if n_classes:
        zero = F.lit(0).cast("bigint")
        rows = rows.unionByName(matrix.sparkSession.range(n_classes).select(
            F.col("id").cast("int").alias("label"), zero.alias("is_a"), zero.alias("is_p"), zero.alias("tp")))
    per = rows.groupBy("label").agg(
        F.sum("tp").cast("bigint").alias("tp"), F.sum("is_a").cast("bigint").alias("n_actual"),
        F.sum("is_p").cast("bigint").alias("n_pred"))
    return per.withColumn("total", F.sum("n_actual").over(Window.partitionBy()))


def metrics_from_counts(counts: DataFrame, compat: bool = False, digits: int = 3) -> DataFrame:
    """Per-class metrics from ``label, tp, n_actual, n_pred, total``.

    Standard (default): precision = TP / predicted count, recall = TP / actual
    count, F1 = 2TP / (2TP + FP + FN), support = actual count.

    ``compat=True`` reproduces the original report, which reads the
    row-predicted matrix as if rows were actual classes: its "precision" is
    TP / actual count, "recall" TP / predicted count, F = TP / (2TP + FP + FN)
    (half of F1) and support the predicted count.

    Undefined ratios (zero denominators) are NULL. Output: ``label, tp, fp,
    fn, tn, precision, recall, f_measure, support``.
    """
    tp, na, np_, total = (F.col(c) for c in ("tp", "n_actual", "n_pred", "total"))
    fp = np_ - tp
    fn = na - tp
    tn = total - tp - fp - fn
    d = lambda num, den: F.round(F.try_divide(num.cast("double"), den.cast("double")), digits)
    if compat:
        precision, recall, f, support = d(tp, na), d(tp, np_), d(tp, na + np_), np_
        fp, fn = na - tp, np_ - tp
    else:
        precision, recall, f, support = d(tp, np_), d(tp, na), d(2 * tp, na + np_), na
    return counts.select(F.col("label").cast("int").alias("label"), tp.alias("tp"), fp.alias("fp"),
                         fn.alias("fn"), tn.alias("tn"), precision.alias("precision"), recall.alias("recall"),
                         f.alias("f_measure"), support.cast("bigint").alias("support"))


def class_metrics(pred: DataFrame, n_classes: int = 10, compat: bool = False, actual: str = "actual",
                  predicted: str = "predicted", digits: int = 3) -> DataFrame:
    """Per-class metrics straight from prediction rows (see
    ``metrics_from_counts`` for the two modes)."""
    return metrics_from_counts(class_counts(pred, n_classes, actual, predicted), compat, digits)


def metrics_from_matrix(matrix: DataFrame, compat: bool = False, digits: int = 3) -> DataFrame:
    """Per-class metrics from a stored long-form matrix."""
    return metrics_from_counts(class_counts_from_matrix(matrix), compat, digits)


def show_metrics(metrics: DataFrame) -> None:
    """Print the metric table: one row per class, all of them."""
    metrics.orderBy("label").show(max(1, metrics.count()), truncate=False)
