"""The registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the driver tables, plus, where SQL can
express it, the equivalent DuckDB query (``ORACLE``).

Columns are aliased identically on both sides. Doubles whose summation order
can differ between engines are rounded on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.scalars import date_key, parse_long, squared_distance, to_int
from quarry.operators import evaluation as ev
from quarry.operators import fold_statistics as fs
from quarry.operators import logistic_optimum as lo
from quarry.operators import models as ml
from quarry.operators import neighbors as nn
from quarry.operators import pivots as pv
from quarry.operators import trending as tr
from quarry.plans import fixtures as fx
from quarry.plans import jobs
from quarry.plans import oracle as sql
from quarry.session import scratch_path
from quarry.sources import csv as csvio
from quarry.sources import records
from quarry.sources import text as textio
from quarry.sources.positions import with_file_position

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


# ---------------------------------------------------------------- observations

@register("category_overlap", sql.CATEGORY_OVERLAP)
def q_category_overlap(spark, sf_dir):
    return tr.category_overlap(fx.overlap_observations(spark, sf_dir), fx.MARKET_1, fx.MARKET_2)


@register("category_overlap_text", sql.CATEGORY_OVERLAP_TEXT)
def q_category_overlap_text(spark, sf_dir):
    return tr.category_overlap_text(q_category_overlap(spark, sf_dir), fx.MARKET_2)


def _growth(spark, sf_dir):
    return tr.growth_first_two(fx.growth_observations(spark, sf_dir), keys=("market", "item_id"),
                               date="date_key", views="views", tiebreak="obs_id")


@register("growth_first_two", sql.GROWTH_FIRST_TWO)
def q_growth_first_two(spark, sf_dir):
    return _growth(spark, sf_dir).select("market", "item_id", "n_used", "early", "late", "pct")


@register("growth_over_1000", sql.GROWTH_OVER_1000)
def q_growth_over_1000(spark, sf_dir):
    return tr.growth_report(_growth(spark, sf_dir), 1000).select("market", "item_id", "pct_trunc", "line")


@register("date_key", sql.DATE_KEY)
def q_date_key(spark, sf_dir):
    d = fx.dated_events(spark, sf_dir)
    return d.select("event_id", "obs_date", date_key("obs_date").alias("date_key"))


@register("split_quoted", sql.SPLIT_QUOTED)
def q_split_quoted(spark, sf_dir):
    lines = fx.quoted_lines(spark, sf_dir)
    fields = textio.split_quoted("line")
    return lines.select("event_id", F.size(fields).cast("int").alias("n_fields"),
                        F.get(fields, 0).alias("f0"), F.get(fields, 1).alias("f1"),
                        F.get(fields, 2).alias("f2"))


@register("parse_long", sql.PARSE_LONG)
def q_parse_long(spark, sf_dir):
    v = fx.view_text_events(spark, sf_dir)
    return v.select("event_id", "views_text", parse_long("views_text").alias("views"))


@register("growth_from_lines", sql.GROWTH_FROM_LINES)
def q_growth_from_lines(spark, sf_dir):
    """Growth report from raw text lines: orders written as observation CSV
    (date as ``yy.dd.MM`` text, views as integer text, a quoted comma field),
    read back line by line (headers included), split outside quotes, picked
    by position."""
    o = fx.table(spark, sf_dir, "orders")
    path = scratch_path(spark, "growth-lines")
    textio.write_observations(o, {
        "item_id": F.col("o_custkey"),
        "obs_date": F.date_format("o_orderdate", "yy.dd.MM"),
        2: F.col("o_orderkey"),
        3: F.concat(F.col("o_orderstatus"), F.lit(", "), F.col("o_orderpriority")),
        4: F.concat(F.lit('say "'), F.col("o_orderstatus"), F.lit('"')),
        "category": F.lit("orders"),
        "views": F.floor("o_totalprice").cast("bigint"),
        "market": F.col("o_orderpriority"),
    }, path)
    fields = textio.split_quoted("value")
    lines = textio.read_lines(spark, path).select(*textio.observations_from_fields(fields),
                                                  parse_long(F.get(fields, 2)).alias("obs_id"))
    obs = lines.withColumn("date_key", date_key("obs_date"))
    g = tr.growth_first_two(obs, keys=("market", "item_id"), date="date_key", views="views",
                            tiebreak="obs_id")
    return tr.growth_report(g, 1000).select("market", "item_id", "pct_trunc", "line")


@register("overlap_from_csv", sql.CATEGORY_OVERLAP)
def q_overlap_from_csv(spark, sf_dir):
    """Category overlap from an observation CSV read with the CSV reader."""
    path = scratch_path(spark, "overlap-csv")
    obs = fx.overlap_observations(spark, sf_dir)
    textio.write_observations(obs, {"item_id": F.col("item_id"), "category": F.col("category"),
                           "market": F.col("market"), "obs_date": F.lit("01.01.01"), "views": F.lit(0),
                           3: F.lit('a "quoted, text"')}, path)
    return tr.category_overlap(textio.read_observations(spark, path), fx.MARKET_1, fx.MARKET_2)


@register("keyed_text_roundtrip", sql.CATEGORY_OVERLAP_TEXT)
def q_keyed_text_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "keyed-text")
    textio.write_keyed_text(q_category_overlap_text(spark, sf_dir), "category", "line", path, 3)
    return textio.read_keyed_text(spark, path, "category", "line")


@register("sorted_text_roundtrip", sql.GROWTH_LINES)
def q_sorted_text_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "sorted-text")
    report = tr.growth_report(_growth(spark, sf_dir), 1000)
    textio.write_sorted_text(report, [F.col("market").desc(), F.col("pct_trunc").desc(), F.col("item_id")],
                             "line", path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@register("csv_roundtrip", sql.CSV_ROUNDTRIP)
def q_csv_roundtrip(spark, sf_dir):
    """Headerless labelled samples: part rows (key first, two numeric
    features) written and read back with an explicit schema."""
    path = scratch_path(spark, "labelled-csv")
    part = fx.table(spark, sf_dir, "part")
    part.select("p_partkey", "p_size", "p_retailprice").write.mode("overwrite").option("header", False).csv(path)
    back = csvio.read_labelled_csv(spark, path, n_features=2, label_first=True, label_type=T.LongType())
    arr = ml.vector_as_array("features")
    return back.select(F.col("label").alias("p_partkey"), arr[0].alias("f0"), arr[1].alias("f1"))


@register("multiline_observations", sql.MULTILINE_OBSERVATIONS)
def q_multiline_observations(spark, sf_dir):
    """Observation CSV whose quoted field holds whole document texts (commas,
    quotes, line breaks), read back with the multi-line CSV reader."""
    path = scratch_path(spark, "multiline-csv")
    docs = fx.table(spark, sf_dir, "documents")
    textio.write_observations(docs, {"item_id": F.col("doc_id"), "obs_date": F.lit("01.01.01"), 2: F.col("text"),
                            "category": F.col("lang"), "views": F.col("n_chars"), "market": F.col("source")},
                     path)
    obs = textio.read_observations(spark, path, multiline=True, more={"body": 2})
    return obs.select("item_id", "category", "views", "market", "body")


@register("multiline_split_observations", sql.MULTILINE_OBSERVATIONS)
def q_multiline_split_observations(spark, sf_dir):
    """The same records from split files: each file is read by as many tasks as its size asks for."""
    path = scratch_path(spark, "multiline-split")
    docs = fx.table(spark, sf_dir, "documents")
    textio.write_observations(docs, {"item_id": F.col("doc_id"), "obs_date": F.lit("01.01.01"), 2: F.col("text"),
                            "category": F.col("lang"), "views": F.col("n_chars"), "market": F.col("source")},
                     path)
    obs = records.read_split_observations(spark, path, more={"body": 2})
    return obs.select("item_id", "category", "views", "market", "body")


# --------------------------------------------------------------- projections

@register("project_cast", sql.PROJECT_CAST)
def q_project_cast(spark, sf_dir):
    e = fx.table(spark, sf_dir, "embeddings")
    score = F.col("label").cast("double")
    return e.select(F.col("vec_id").alias("id"), F.col("label").alias("label_test"), score.alias("prediction"),
                    to_int(score).alias("prediction_int"))


@register("row_id", sql.ROW_ID)
def q_row_id(spark, sf_dir):
    """Row ids that the sample reader of the jobs gives to a written table."""
    path = scratch_path(spark, "row-id")
    e = fx.embeddings(spark, sf_dir)
    csvio.write_labelled_csv(e, "label", "vec", path, n_features=64)
    rows = jobs.read_samples(spark, path, 64, True, "row_id")
    return rows.agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                    F.count_distinct("row_id").cast("bigint").alias("n_distinct"))


@register("file_position", sql.FILE_POSITION)
def q_file_position(spark, sf_dir):
    """Row ids by place in the files of a table written in the order of its key."""
    path = scratch_path(spark, "file-position")
    e = fx.embeddings(spark, sf_dir).orderBy("vec_id")
    csvio.write_labelled_csv(e, "label", "vec", path, n_features=64)
    rows = with_file_position(csvio.read_labelled_csv(spark, path, 64, True))
    return rows.select("row_id", F.col("label").cast("int").alias("label"), ml.vector_as_array("features")[0].alias("f0"))


@register("assemble_features", sql.ASSEMBLE_FEATURES)
def q_assemble_features(spark, sf_dir):
    """All values of the assembled vectors, one row each."""
    e = fx.table(spark, sf_dir, "embeddings")
    v = ml.assemble_features(e, "embedding", "features", keep=["vec_id"])
    return v.select("vec_id", F.posexplode(ml.vector_as_array("features")).alias("i", "value"))


@register("pca_project", sql.PCA_PROJECT)
def q_pca_project(spark, sf_dir):
    """Projection of both sides at full dimension, which keeps squared norms."""
    e = fx.embeddings(spark, sf_dir)
    test, train = fx.holdout(ml.assemble_features(e, "vec", "features", keep=["vec_id", "label"]))
    _, train_p, (test_p,) = ml.pca_project(train, [test], 64, "features", "pca")
    norm = F.aggregate(ml.vector_as_array("pca"), F.lit(0.0), lambda a, x: a + x * x)
    return train_p.unionByName(test_p).select("vec_id", "label", F.round(norm, 6).alias("norm"))


@register("principal_components", sql.PRINCIPAL_COMPONENTS)
def q_principal_components(spark, sf_dir):
    """The ten principal directions of all vectors, with their variances."""
    found = fs.principal_components(fx.embeddings(spark, sf_dir), "vec", 10)
    return found.select("component", F.round("variance", 7).alias("variance"), "i", (F.round("loading", 5) + 0.0).alias("loading"))


# ----------------------------------------------------------------------- KNN

def _knn_neighbours(spark, sf_dir, block_rows=None):
    q, t = fx.knn_sides(spark, sf_dir)
    return nn.knn_candidates(q, t, fx.K_NEIGHBOURS, block_rows=block_rows)


def _knn_predictions(spark, sf_dir, block_rows=None):
    return nn.majority_vote(_knn_neighbours(spark, sf_dir, block_rows))


@register("knn_topk", sql.KNN_TOPK)
def q_knn_topk(spark, sf_dir):
    return _knn_neighbours(spark, sf_dir).select("qid", "qlabel", "tid", "tlabel", "rank",
                                                 F.round("dist", 6).alias("dist"))


@register("knn_pruned", sql.KNN_TOPK)
def q_knn_pruned(spark, sf_dir):
    """The neighbours by pivot cells: only cells that may hold one are compared."""
    q, t = fx.knn_sides(spark, sf_dir)
    return pv.knn_pruned(q, t, fx.K_NEIGHBOURS).select("qid", "qlabel", "tid", "tlabel", "rank", F.round("dist", 6).alias("dist"))


@register("knn_distance", sql.KNN_TOPK)
def q_knn_distance(spark, sf_dir):
    """The native distance expression on the selected neighbour pairs only:
    the k neighbours of each query are joined back to both vectors by id
    (equi-joins, k rows per query) and their distance is recomputed on the
    JVM side."""
    q, t = fx.knn_sides(spark, sf_dir)
    nb = _knn_neighbours(spark, sf_dir).select("qid", "qlabel", "tid", "tlabel", "rank")
    pairs = nb.join(q.select("qid", "qvec"), "qid").join(t.select("tid", "tvec"), "tid")
    return pairs.select("qid", "qlabel", "tid", "tlabel", "rank",
                        F.round(squared_distance("qvec", "tvec"), 6).alias("dist"))


@register("knn_vote", sql.KNN_PREDICT)
def q_knn_vote(spark, sf_dir):
    return _knn_predictions(spark, sf_dir)


@register("knn_predict", sql.KNN_PREDICT)
def q_knn_predict(spark, sf_dir):
    q, t = fx.knn_sides(spark, sf_dir)
    return nn.knn_classify(q, t, fx.K_NEIGHBOURS)


@register("knn_blocked", sql.KNN_PREDICT)
def q_knn_blocked(spark, sf_dir):
    """Small blocks: many train blocks, so the cross-block top-k merge runs."""
    return _knn_predictions(spark, sf_dir, block_rows=64)


@register("knn_pca_full", sql.KNN_PREDICT)
def q_knn_pca_full(spark, sf_dir):
    """PCA at full dimension (fit on the train side) leaves the neighbours
    unchanged."""
    q, t = fx.knn_sides(spark, sf_dir)
    return ml.pca_knn_classify(t, q, dim=64, k=fx.K_NEIGHBOURS)


@register("knn_pca_classify", sql.KNN_PCA_CLASSIFY)
def q_knn_pca_classify(spark, sf_dir):
    """The default classifier: PCA to 10 dimensions, then 5 neighbours, on
    classes far apart."""
    e = fx.separable_embeddings(spark, sf_dir, FAR)
    test, train = fx.holdout(e)
    q = test.select(F.col("vec_id").alias("qid"), F.col("label").alias("qlabel"), F.col("feat_array").alias("qvec"))
    t = train.select(F.col("vec_id").alias("tid"), F.col("label").alias("tlabel"), F.col("feat_array").alias("tvec"))
    return ml.pca_knn_classify(t, q, dim=10, k=fx.K_NEIGHBOURS).select("qid", "actual", "predicted")


@register("predictions_roundtrip", sql.KNN_PREDICT)
def q_predictions_roundtrip(spark, sf_dir):
    """KNN predictions written as CSV with a header and read back."""
    path = scratch_path(spark, "predictions-csv")
    csvio.write_predictions(_knn_predictions(spark, sf_dir), path, order=["qid"])
    return spark.read.option("header", True).schema(
        "qid bigint, actual int, predicted int, votes bigint").csv(path)


# ------------------------------------------------------------ MLlib classifiers

#: Distance of the classes at which any sound fit predicts every label.
FAR = 8.0


def _separable_split(spark, sf_dir, apart=FAR):
    e = ml.assemble_features(fx.separable_embeddings(spark, sf_dir, apart), "feat_array", "features",
                             keep=["vec_id", "label"])
    test, train = fx.holdout(e)
    return train, test


@register("ovr_logistic", sql.CLASSIFY_FAR)
def q_ovr_logistic(spark, sf_dir):
    train, test = _separable_split(spark, sf_dir)
    return ml.classify(ml.ovr_logistic(max_iter=50), train, test, pca_k=32, keep=["vec_id"])


#: Penalty of the fits whose optimum is checked; the classes overlap.
LOGISTIC_REG = 0.02


def _logistic_fits(spark, sf_dir):
    """MLlib's fit and the optimum of its objective, on the train side."""
    test, train = fx.holdout(fx.embeddings(spark, sf_dir))
    rows = ml.assemble_features(train, "vec", "features", keep=["label"]).withColumn("label", F.col("label").cast("double"))
    estimator = ml.ovr_logistic(max_iter=300, tol=1e-12, reg_param=LOGISTIC_REG, standardize=False)
    weights = lo.fitted_weights(estimator.fit(rows))
    return train, test, weights, lo.optimum(train, weights, LOGISTIC_REG)


@register("logistic_optimum", sql.LOGISTIC_OPTIMUM)
def q_logistic_optimum(spark, sf_dir):
    """Optimal weights of every class (i = 64: intercept), its objective there,
    and whether MLlib's own fit reaches it to one millionth."""
    train, _, weights, best = _logistic_fits(spark, sf_dir)
    fitted = {f.label: f.loss for f in lo.losses_at(train, weights, LOGISTIC_REG)}
    rows = [(f.label, f.n, f.loss, fitted[f.label] - f.loss <= 1e-6, f.weights.tolist()) for f in best]
    found = spark.createDataFrame(rows, "label int, n long, loss double, fit_is_optimal boolean, weights array<double>")
    cells = found.select("label", "n", F.round("loss", 9).alias("loss"), "fit_is_optimal", F.posexplode("weights").alias("i", "weight"))
    return cells.withColumn("weight", F.round("weight", 6) + 0.0)


@register("logistic_overlap", sql.LOGISTIC_OVERLAP)
def q_logistic_overlap(spark, sf_dir):
    """Predictions on overlapping classes, by the optimal weights."""
    _, test, _, best = _logistic_fits(spark, sf_dir)
    return lo.predict(test.select("vec_id", F.col("label").alias("actual"), "vec"), best)


@register("ovr_linear_svm", sql.CLASSIFY_FAR)
def q_ovr_linear_svm(spark, sf_dir):
    train, test = _separable_split(spark, sf_dir)
    return ml.classify(ml.ovr_linear_svm(max_iter=50), train, test, pca_k=32, keep=["vec_id"])


@register("naive_bayes", sql.NAIVE_BAYES)
def q_naive_bayes(spark, sf_dir):
    train, test = _separable_split(spark, sf_dir, apart=1.0)
    return ml.classify(ml.naive_bayes(), train, test, keep=["vec_id"])


@register("mlp_classify", sql.CLASSIFY_FAR)
def q_mlp_classify(spark, sf_dir):
    train, test = _separable_split(spark, sf_dir)
    return ml.classify(ml.mlp(layers=(32, 24, 24, 10), max_iter=100), train, test, pca_k=32, keep=["vec_id"])


@register("cross_validate", sql.CROSS_VALIDATE_FAR)
def q_cross_validate(spark, sf_dir):
    e = ml.assemble_features(fx.separable_embeddings(spark, sf_dir, FAR), "feat_array", "features",
                             keep=["vec_id", "label"])
    folded = ml.contiguous_folds(e, "vec_id", n_folds=3)
    return ml.cross_validate(folded, lambda: ml.mlp(layers=(32, 24, 10), max_iter=60), 3, pca_k=32,
                             keep=["vec_id"])


# ---------------------------------------------------------------- evaluation

def _pred(spark, sf_dir):
    return _knn_predictions(spark, sf_dir)


@register("error_count", sql.ERROR_COUNT)
def q_error_count(spark, sf_dir):
    return ev.error_count(_pred(spark, sf_dir))


@register("accuracy", sql.ACCURACY)
def q_accuracy(spark, sf_dir):
    return ev.accuracy(_pred(spark, sf_dir))


@register("prediction_count", sql.PREDICTION_COUNT)
def q_prediction_count(spark, sf_dir):
    return ev.prediction_count(_pred(spark, sf_dir))


@register("confusion_matrix", sql.CONFUSION_MATRIX)
def q_confusion_matrix(spark, sf_dir):
    return ev.confusion_matrix(_pred(spark, sf_dir), fx.N_CLASSES)


@register("confusion_wide", sql.CONFUSION_WIDE)
def q_confusion_wide(spark, sf_dir):
    return ev.confusion_wide(q_confusion_matrix(spark, sf_dir), fx.N_CLASSES)


@register("class_metrics", sql.CLASS_METRICS)
def q_class_metrics(spark, sf_dir):
    return ev.class_metrics(_pred(spark, sf_dir), fx.N_CLASSES)


@register("class_metrics_compat", sql.CLASS_METRICS_COMPAT)
def q_class_metrics_compat(spark, sf_dir):
    return ev.class_metrics(_pred(spark, sf_dir), fx.N_CLASSES, compat=True)


def _stored_matrix(spark, sf_dir):
    path = scratch_path(spark, "confusion-csv")
    csvio.write_confusion_csv(q_confusion_wide(spark, sf_dir), path)
    return csvio.read_confusion_csv(spark, path)


@register("confusion_other_labels", sql.CONFUSION_OTHER_LABELS)
def q_confusion_other_labels(spark, sf_dir):
    """Labels outside 0..9 and missing ones, through the wide form and the
    stored file: the cells still add up to the rows."""
    e = fx.table(spark, sf_dir, "embeddings")
    pred = e.select(F.when(F.col("vec_id") % 7 == 0, F.col("label") + 10).when(F.col("vec_id") % 11 != 0, F.col("label")).alias("actual"),
                    F.when(F.col("vec_id") % 5 == 0, F.lit(-1)).otherwise(F.col("label")).alias("predicted"))
    path = scratch_path(spark, "confusion-other")
    csvio.write_confusion_csv(ev.confusion_wide(ev.confusion_matrix(pred, fx.N_CLASSES), fx.N_CLASSES), path)
    return csvio.read_confusion_csv(spark, path).where("n > 0")


@register("confusion_from_csv", sql.CONFUSION_MATRIX)
def q_confusion_from_csv(spark, sf_dir):
    return _stored_matrix(spark, sf_dir)


@register("metrics_from_stored_matrix", sql.CLASS_METRICS_COMPAT)
def q_metrics_from_stored_matrix(spark, sf_dir):
    return ev.metrics_from_matrix(_stored_matrix(spark, sf_dir), compat=True)


@register("fold_covariances", sql.FOLD_COVARIANCES)
def q_fold_covariances(spark, sf_dir):
    """Covariances of the rows outside each contiguous fold, by subtraction from the totals of one pass."""
    folded = ml.contiguous_folds(fx.embeddings(spark, sf_dir), "vec_id", fx.N_FOLDS)
    return fs.fold_covariances(folded, "vec").withColumn("cov", F.round("cov", 7) + 0.0)


@register("contiguous_folds", sql.CONTIGUOUS_FOLDS)
def q_contiguous_folds(spark, sf_dir):
    e = fx.table(spark, sf_dir, "embeddings").select("vec_id")
    return ml.contiguous_folds(e, "vec_id", fx.N_FOLDS).select("vec_id", "pos", "fold")


def _fold_predictions(spark, sf_dir):
    """Every row predicted by KNN from the rows of the other folds."""
    e = fx.embeddings(spark, sf_dir)
    folded = ml.contiguous_folds(e, "vec_id", fx.N_FOLDS)
    q = folded.select(F.col("vec_id").alias("qid"), F.col("label").alias("qlabel"),
                      F.col("vec").alias("qvec"), "fold")
    t = folded.select(F.col("vec_id").alias("tid"), F.col("label").alias("tlabel"),
                      F.col("vec").alias("tvec"), "fold")
    return nn.knn_classify(q, t, fx.K_NEIGHBOURS, exclude="fold", carry=["fold"])


@register("knn_fold_predict", sql.KNN_FOLD_PREDICT)
def q_knn_fold_predict(spark, sf_dir):
    """Every row of the table classified by its 5 nearest rows in the other
    folds (10 contiguous folds): whole-table KNN with no id-based split."""
    return _fold_predictions(spark, sf_dir).select("qid", "fold", "actual", "predicted", "votes")


@register("merge_confusion", sql.MERGE_CONFUSION)
def q_merge_confusion(spark, sf_dir):
    return ev.merge_confusion(ev.per_fold_confusion(_fold_predictions(spark, sf_dir)))


@register("mean_fold_accuracy", sql.MEAN_FOLD_ACCURACY)
def q_mean_fold_accuracy(spark, sf_dir):
    m = ev.mean_fold_accuracy(_fold_predictions(spark, sf_dir))
    return m.select("n_folds", F.round("mean_accuracy", 9).alias("mean_accuracy"))
