"""Command line for the file jobs (``spark-submit -m quarry ...`` or
``python -m quarry ...``)::

    python -m quarry overlap  IN OUT MARKET1 MARKET2
    python -m quarry growth   IN OUT [--threshold 1000]
    python -m quarry knn      TEST TRAIN OUT [--dim 10] [--k 5]
    python -m quarry classify TEST TRAIN OUT --model logistic|svm|bayes|mlp [--pca 200]
    python -m quarry cv       TRAIN OUT [--folds 10] [--fold-size N] [--pca 200] [--layers 200,150,150,10]

Metric tables are printed; everything else is written under OUT.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from quarry.operators.evaluation import show_metrics
from quarry.plans import jobs


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quarry")
    sub = p.add_subparsers(dest="job", required=True)
    o = sub.add_parser("overlap")
    o.add_argument("input"), o.add_argument("output"), o.add_argument("market1"), o.add_argument("market2")
    o.add_argument("--files", type=int, default=3)
    o.add_argument("--raw-lines", action="store_true")
    o.add_argument("--multiline", action="store_true", help="records may hold line breaks in quotes")
    g = sub.add_parser("growth")
    g.add_argument("input"), g.add_argument("output")
    g.add_argument("--threshold", type=int, default=1000)
    g.add_argument("--csv", action="store_true", help="read with the CSV reader instead of line by line")
    g.add_argument("--multiline", action="store_true", help="with --csv: records may hold line breaks in quotes")
    for name in ("knn", "classify"):
        c = sub.add_parser(name)
        c.add_argument("test"), c.add_argument("train"), c.add_argument("output")
        c.add_argument("--features", type=int, default=None)
        c.add_argument("--label-last", action="store_true")
        c.add_argument("--compat", action="store_true")
        c.add_argument("--classes", type=int, default=10, help="classes listed even if they never occur")
    sub.choices["knn"].add_argument("--dim", type=int, default=10)
    sub.choices["knn"].add_argument("--k", type=int, default=5)
    sub.choices["classify"].add_argument("--model", required=True, choices=sorted(jobs.CLASSIFIERS))
    sub.choices["classify"].add_argument("--pca", type=int, default=200)
    sub.choices["classify"].add_argument("--max-iter", type=int, default=None)
    sub.choices["classify"].add_argument("--reg-param", type=float, default=None, help="svm only")
    sub.choices["classify"].add_argument("--layers", default=None, help="mlp only: sizes, the first the PCA size or the feature count")
    v = sub.add_parser("cv")
    v.add_argument("train"), v.add_argument("output")
    v.add_argument("--folds", type=int, default=10)
    v.add_argument("--fold-size", type=int, default=None)
    v.add_argument("--pca", type=int, default=200)
    v.add_argument("--features", type=int, default=None)
    v.add_argument("--label-first", action="store_true")
    v.add_argument("--compat", action="store_true")
    v.add_argument("--classes", type=int, default=10)
    v.add_argument("--layers", default="200,150,150,10",
                   help="MLP layer sizes; the first must equal the PCA size (or the feature count)")
    v.add_argument("--max-iter", type=int, default=400)
    return p


def main(argv: list[str] | None = None) -> int:
    a = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"quarry-{a.job}").getOrCreate()
    if a.job == "overlap":
        jobs.overlap_job(spark, a.input, a.output, a.market1, a.market2, a.files, a.raw_lines, a.multiline)
    elif a.job == "growth":
        jobs.growth_job(spark, a.input, a.output, a.threshold, raw_lines=not a.csv, multiline=a.multiline)
    elif a.job == "knn":
        res = jobs.knn_job(spark, a.test, a.train, a.output, a.dim or None, a.k, a.features,
                           not a.label_last, n_classes=a.classes, compat=a.compat)
        res["accuracy"].show()
        show_metrics(res["metrics"])
    elif a.job == "classify":
        params = {"max_iter": a.max_iter, "reg_param": a.reg_param,
                  "layers": [int(x) for x in a.layers.split(",")] if a.layers else None}
        res = jobs.classifier_job(spark, a.test, a.train, a.output, a.model, {k: x for k, x in params.items() if x is not None},
                                  pca_k=a.pca or None, n_features=a.features, label_first=not a.label_last,
                                  n_classes=a.classes, compat=a.compat)
        res["accuracy"].show()
        show_metrics(res["metrics"])
    elif a.job == "cv":
        layers = [int(x) for x in a.layers.split(",")]
        res = jobs.cross_validation_job(spark, a.train, a.output, a.folds, a.fold_size, a.pca or None,
                                        layers=layers, max_iter=a.max_iter, n_features=a.features,
                                        label_first=a.label_first, n_classes=a.classes, compat=a.compat)
        res["mean_accuracy"].show()
        show_metrics(res["metrics"])
    return 0


if __name__ == "__main__":
    sys.exit(main())
