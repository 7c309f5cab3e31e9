"""MLlib classifiers, PCA, contiguous folds and cross-validation.

Training is MLlib's distributed optimisation (tree-aggregated gradients);
predictions are plain DataFrame columns. ``cross_validate`` starts one
distributed fit per fold, a few at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator
from pyspark.ml.classification import (LinearSVC, LogisticRegression, MultilayerPerceptronClassifier,
                                       NaiveBayes, OneVsRest)
from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.fold_statistics import fold_moments, project, training_moments
from quarry.operators.neighbors import knn_classify
from quarry.session import checkpoint_dir, default_parallelism


def assemble_features(df: DataFrame, inputs: Sequence[str] | str, output: str = "features",
                      keep: Sequence[str] = (), invalid: str = "error") -> DataFrame:
    """Column slice -> one MLlib vector. A single ``array`` column is converted
    with ``array_to_vector``; several numeric columns go through
    ``VectorAssembler``, where ``invalid`` says what a missing value does
    (``error``, ``skip`` or ``keep`` as NaN)."""
    if isinstance(inputs, str):
        return df.select(*keep, array_to_vector(F.col(inputs)).alias(output))
    assembler = VectorAssembler(inputCols=list(inputs), outputCol=output, handleInvalid=invalid)
    return assembler.transform(df).select(*keep, output)


def fit_pca(train: DataFrame, k: int, input_col: str = "features", output_col: str = "pca") -> PCAModel:
    """Fit PCA on the training rows only (distributed Gramian; the d x d
    decomposition runs on the driver, so d must stay in the low thousands)."""
    return PCA(k=k, inputCol=input_col, outputCol=output_col).fit(train)


def pca_project(train: DataFrame, others: Sequence[DataFrame], k: int, input_col: str = "features",
                output_col: str = "pca") -> tuple[PCAModel, DataFrame, list[DataFrame]]:
    """Fit on ``train`` and project ``train`` and every frame in ``others``.
    The projection is not mean-centred (distances are unchanged at full k)."""
    model = fit_pca(train, k, input_col, output_col)
    return model, model.transform(train), [model.transform(o) for o in others]


def vector_as_array(col: str | Column) -> Column:
    return vector_to_array(F.col(col) if isinstance(col, str) else col, "float64")


def _predict(model, test: DataFrame, label: str, keep: Sequence[str]) -> DataFrame:
    return model.transform(test).select(*keep, F.col(label).cast("int").alias("actual"),
                                        F.col("prediction").cast("int").alias("predicted"))


def ovr_logistic(max_iter: int = 200, tol: float = 1e-6, fit_intercept: bool = True,
                 features: str = "features", label: str = "label", parallelism: int = 4,
                 reg_param: float = 0.0, standardize: bool = True) -> Estimator:
    """One-vs-rest logistic regression (defaults: maxIter 200, tol 1e-6).
    ``parallelism`` binary models are fitted concurrently."""
    lr = LogisticRegression(maxIter=max_iter, tol=tol, fitIntercept=fit_intercept, regParam=reg_param,
                            standardization=standardize, featuresCol=features, labelCol=label)
    return OneVsRest(classifier=lr, featuresCol=features, labelCol=label, parallelism=parallelism)


def ovr_linear_svm(max_iter: int = 100, reg_param: float = 0.01, features: str = "features",
                   label: str = "label", parallelism: int = 4) -> Estimator:
    """One-vs-rest linear SVM (defaults: maxIter 100, regParam 0.01)."""
    svm = LinearSVC(maxIter=max_iter, regParam=reg_param, featuresCol=features, labelCol=label)
    return OneVsRest(classifier=svm, featuresCol=features, labelCol=label, parallelism=parallelism)


def naive_bayes(smoothing: float = 1.0, features: str = "features", label: str = "label") -> Estimator:
    """Multinomial naive Bayes (features must be non-negative)."""
    return NaiveBayes(smoothing=smoothing, modelType="multinomial", featuresCol=features, labelCol=label)


def mlp(layers: Sequence[int] = (200, 150, 150, 10), max_iter: int = 100, block_size: int = 128,
        seed: int = 123, features: str = "features", label: str = "label") -> Estimator:
    """Multilayer perceptron; ``layers[0]`` must equal the feature count."""
    return MultilayerPerceptronClassifier(layers=list(layers), maxIter=max_iter, blockSize=block_size,
                                          seed=seed, featuresCol=features, labelCol=label)


def train_and_predict(estimator: Estimator, train: DataFrame, test: DataFrame, label: str = "label",
                      keep: Sequence[str] = ()) -> DataFrame:
    """Fit on ``train``; return ``*keep, actual, predicted`` for ``test``."""
    model = estimator.fit(train.withColumn(label, F.col(label).cast("double")))
    return _predict(model, test, label, keep)


def classify(estimator: Estimator, train: DataFrame, test: DataFrame, pca_k: int | None = None,
             features: str = "features", label: str = "label", keep: Sequence[str] = ()) -> DataFrame:
    """Optional PCA (fit on train) followed by a classifier."""
    if pca_k:
        model = fit_pca(train, pca_k, features, "_pca")
        train = model.transform(train).drop(features).withColumnRenamed("_pca", features)
        test = model.transform(test).drop(features).withColumnRenamed("_pca", features)
    return train_and_predict(estimator, train, test, label, keep)


def pca_knn_classify(train: DataFrame, test: DataFrame, dim: int = 10, k: int = 5, *, tid: str = "tid",
                     tlabel: str = "tlabel", tvec: str = "tvec", qid: str = "qid", qlabel: str = "qlabel",
                     qvec: str = "qvec", block_rows: int | None = None, **sizes) -> DataFrame:
    """The full KNN classifier: PCA to ``dim`` fitted on the train side, both
    sides projected, then exact KNN with ``k`` neighbours and a majority vote.
    Inputs hold ``array`` vectors; output ``qid, actual, predicted, votes``.
    ``sizes`` (``n_query, n_train, check_ids``) go to ``knn_candidates``."""
    tv = assemble_features(train, tvec, "_features", keep=[tid, tlabel])
    qv = assemble_features(test, qvec, "_features", keep=[qid, qlabel])
    model = fit_pca(tv, dim, "_features", "_pca")
    tp = model.transform(tv).select(F.col(tid).alias("tid"), F.col(tlabel).alias("tlabel"),
                                    vector_as_array("_pca").alias("tvec"))
    qp = model.transform(qv).select(F.col(qid).alias("qid"), F.col(qlabel).alias("qlabel"),
                                    vector_as_array("_pca").alias("qvec"))
    return knn_classify(qp, tp, k, block_rows=block_rows, **sizes)


def row_position(df: DataFrame, order_col: str, n_buckets: int | None = None,
                 pos_col: str = "pos") -> DataFrame:
    """0-based position of every row in the order of ``order_col`` (rows with
    equal values are ordered by a row hash), without a single-partition sort.
    See ``row_position_and_count``."""
    return row_position_and_count(df, order_col, n_buckets, pos_col)[0]


def row_position_and_count(df: DataFrame, order_col: str, n_buckets: int | None = None,
                           pos_col: str = "pos") -> tuple[DataFrame, int]:
    """Row positions plus the total row count.

    Rows are range-partitioned into ``n_buckets`` buckets and sorted inside
    each; the bucket id and in-bucket index are materialised with a reliable
    checkpoint (stable across task retries). The bucket sizes (``n_buckets``
    numbers) come back to the driver once and give both the offsets (a
    bounded table, broadcast) and the total.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n_buckets = n_buckets or default_parallelism(spark)
    # Equal ordering keys are ordered by a hash of the whole row, so a hot key
    # is split across range buckets instead of landing in one task; exact
    # copies of a row are further ordered by the input split they were read
    # from (deterministic for file sources), so at most one split's worth of
    # copies can share a bucket.
    order = [F.col(order_col), F.xxhash64(*[F.col(c) for c in df.columns]),
             F.input_file_name(), F.input_file_block_start()]
    local = (df.repartitionByRange(n_buckets, *order).sortWithinPartitions(*order)
             .withColumn("_bucket", F.spark_partition_id())
             .withColumn("_local", F.monotonically_increasing_id()
                         - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)))
    local = local.checkpoint(eager=True)
    sizes = sorted((r["_bucket"], r["_n"]) for r in
                   local.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).collect())
    offsets, total = [], 0
    for bucket, n in sizes:
        offsets.append((int(bucket), total))
        total += int(n)
    # A literal table built on the JVM side (no Python rows to convert).
    off = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(b).cast("int").alias("_bucket"), F.lit(o).cast("bigint").alias("_offset"))
        for b, o in (offsets or [(0, 0)])])))
    positioned = (local.join(F.broadcast(off), "_bucket")
                  .withColumn(pos_col, (F.col("_offset") + F.col("_local")).cast("bigint"))
                  .drop("_bucket", "_local", "_offset"))
    return positioned, total


def contiguous_folds(df: DataFrame, order_col: str, n_folds: int = 10, fold_size: int | None = None,
                     fold_col: str = "fold", n_buckets: int | None = None) -> DataFrame:
    """Contiguous folds in the order of ``order_col``.

    Default: ``fold = floor(pos * n_folds / n)`` - folds tile every row.
    With ``fold_size`` the fixed-size layout is used: fold i covers
    ``[i * size, (i + 1) * size)`` and the last fold the final ``size`` rows;
    rows in neither get a NULL fold (never held out).
    """
    positioned, n = row_position_and_count(df, order_col, n_buckets)
    pos = F.col("pos")
    if fold_size is None:
        fold = F.floor(pos * F.lit(n_folds) / F.lit(n)).cast("int") if n else F.lit(None).cast("int")
    else:
        first = F.floor(pos / F.lit(fold_size)).cast("int")
        fold = (F.when(pos >= F.lit(n - fold_size), F.lit(n_folds - 1))
                .when(first < F.lit(n_folds - 1), first))
    return positioned.withColumn(fold_col, fold)


def cross_validate(df: DataFrame, make_estimator: Callable[[], Estimator], n_folds: int,
                   fold_col: str = "fold", pca_k: int | None = None, features: str = "features",
                   label: str = "label", keep: Sequence[str] = (), parallelism: int = 4) -> DataFrame:
    """For each fold: fit (PCA +) classifier on the other folds, predict the
    held-out fold; ``parallelism`` folds are fitted at a time. Returns all
    held-out predictions with their fold: ``fold, *keep, actual, predicted``."""
    def one(i: int) -> DataFrame:
        held = df.where(F.col(fold_col) == i)
        rest = df.where(F.col(fold_col).isNull() | (F.col(fold_col) != i))
        pred = classify(make_estimator(), rest, held, pca_k, features, label, keep)
        return pred.withColumn(fold_col, F.lit(i))

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, n_folds))) as pool:
        parts = list(pool.map(one, range(n_folds)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(fold_col, *keep, "actual", "predicted")


def cross_validate_arrays(df: DataFrame, make_estimator: Callable[[], Estimator], n_folds: int, pca_k: int, vec_col: str,
                          fold_col: str = "fold", label: str = "label", keep: Sequence[str] = (), parallelism: int = 4) -> DataFrame:
    """``cross_validate`` over array vectors, with the PCA of every fold taken
    from the moments of one pass (``fold_statistics``) instead of a fit each."""
    matrices = {i: m.components(pca_k)[0] for i, m in training_moments(fold_moments(df, vec_col, fold_col)).items()}

    def one(i: int) -> DataFrame:
        vectors = project(df.select(*keep, fold_col, label, vec_col), vec_col, matrices[i])
        rows = vectors.select(*keep, fold_col, label, array_to_vector(vec_col).alias("features"))
        rest = rows.where(F.col(fold_col).isNull() | (F.col(fold_col) != i))
        return train_and_predict(make_estimator(), rest, rows.where(F.col(fold_col) == i), label, keep).withColumn(fold_col, F.lit(i))

    held = [i for i in range(n_folds) if i in matrices]
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, n_folds))) as pool:
        parts = list(pool.map(one, held))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(fold_col, *keep, "actual", "predicted")
