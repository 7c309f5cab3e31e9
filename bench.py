"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run to completion through the ``noop`` sink (full execution,
nothing collected) after one untimed warm-up pass over the same query set at
sf0.001; the reported time per query is the median of ``BENCH_REPEAT``
(default 3) runs. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quarry.plans.catalog import QUERIES  # noqa: E402
from quarry.session import local_session  # noqa: E402

HEADLINE = [
    "category_overlap",
    "category_overlap_text",
    "growth_first_two",
    "growth_over_1000",
    "growth_from_lines",
    "overlap_from_csv",
    "date_key",
    "split_quoted",
    "parse_long",
    "knn_topk",
    "knn_predict",
    "knn_blocked",
    "knn_pca_full",
    "confusion_matrix",
    "class_metrics",
    "contiguous_folds",
    "merge_confusion",
    "naive_bayes",
    "mlp_classify",
    "ovr_logistic",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    spark = local_session(cpus, shuffle_partitions=max(cpus, 8), app="quarry-bench")
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm):
        for n in names:
            run(spark, n, warm)
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "3")))
    times = {n: round(statistics.median(run(spark, n, sf_dir) for _ in range(repeat)), 3) for n in names}
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
