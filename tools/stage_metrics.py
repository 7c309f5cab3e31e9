"""Per-query stage metrics from Spark's event log.

    python tools/stage_metrics.py SCRATCH_DIR [sf_dir] [name ...]

Runs each query once (noop sink) with the event log written under
SCRATCH_DIR (a fresh folder per run), then sums, per query, the stages, task
time, input rows and shuffle records/bytes written, and writes STAGES.md.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from quarry.plans.catalog import QUERIES  # noqa: E402

HEADLINE = ["category_overlap", "growth_over_1000", "growth_from_lines", "knn_predict", "knn_blocked",
            "merge_confusion", "class_metrics", "contiguous_folds", "naive_bayes"]


def _acc(stage_info: dict, name: str) -> int:
    for a in stage_info.get("Accumulables", []):
        if a.get("Name") == name:
            try:
                return int(a.get("Value", 0))
            except (TypeError, ValueError):
                return 0
    return 0


def main(argv):
    scratch = argv[1]
    sf_dir = argv[2] if len(argv) > 2 else "/root/testdata/sf0.1"
    names = argv[3:] or HEADLINE
    log_dir = os.path.join(scratch, "eventlog")
    os.makedirs(log_dir, exist_ok=True)
    spark = (SparkSession.builder.master("local[8]").appName("quarry-stages")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false")
             .config("spark.sql.adaptive.enabled", "true").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    wall = {}
    for n in names:
        spark.sparkContext.setJobGroup(n, n)
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        wall[n] = time.perf_counter() - t0
    spark.stop()

    stage_query, stats = {}, {}
    for path in sorted(p for p in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True) if os.path.isfile(p)):
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        stage_query[sid] = group
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    q = stage_query.get(info["Stage ID"])
                    if q is None:
                        continue
                    s = stats.setdefault(q, {"stages": 0, "tasks": 0, "task_ms": 0, "input_rows": 0,
                                             "shuffle_rows": 0, "shuffle_bytes": 0})
                    s["stages"] += 1
                    s["tasks"] += info.get("Number of Tasks", 0)
                    s["task_ms"] += _acc(info, "internal.metrics.executorRunTime")
                    s["input_rows"] += _acc(info, "internal.metrics.input.recordsRead")
                    s["shuffle_rows"] += _acc(info, "internal.metrics.shuffle.write.recordsWritten")
                    s["shuffle_bytes"] += _acc(info, "internal.metrics.shuffle.write.bytesWritten")
    rows = ["# Stage metrics per query", "",
            f"From Spark's event log (`python tools/stage_metrics.py <scratch> {sf_dir}`), local[8], one run per",
            "query, no warm-up. Shuffle columns are rows and bytes written to shuffle files by all stages of",
            "the query, including the count job that sizes the KNN blocks.", "",
            "| query | wall s | stages | tasks | task s | input rows | shuffle rows | shuffle MB |",
            "| --- | --- | --- | --- | --- | --- | --- | --- |"]
    for n in names:
        s = stats.get(n, {})
        rows.append(f"| {n} | {wall[n]:.2f} | {s.get('stages', 0)} | {s.get('tasks', 0)} | "
                    f"{s.get('task_ms', 0) / 1000:.1f} | {s.get('input_rows', 0)} | {s.get('shuffle_rows', 0)} | "
                    f"{s.get('shuffle_bytes', 0) / 1e6:.2f} |")
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "STAGES.md")
    with open(out, "w") as f:
        f.write("\n".join(rows) + "\n")
    print("\n".join(rows))


if __name__ == "__main__":
    main(sys.argv)
