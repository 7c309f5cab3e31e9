import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quarry.llm import importance as im
from quarry.llm import kernels as kn
from quarry.llm import queries as Q

SF = "/root/testdata/sf0.01"


def test_scores_match_a_plain_count(spark, documents):
    rows = [(1, "good words here"), (2, "Good  words\nbad"), (3, None), (4, ""), (5, "bad bad"), (5, "bad bad"), (None, "x")]
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (None, 1, 0), (77, 1, 0)], "doc_id long, quality int, toxic int")
    docs = documents(rows)
    ratios = im.log_ratios(docs, labels, buckets=64)
    raw, target = np.ones(64), np.ones(64)

    def buckets(text):
        part = pa.RecordBatch.from_pydict({"text": pa.array([text], pa.string())})
        return im.features(part, kn.Powers(), 64)[0]

    for i, text in rows:
        for b in buckets(text):
            raw[b] += 1
            target[b] += i == 1
    assert np.allclose(ratios, np.log(target / target.sum()) - np.log(raw / raw.sum()))
    got = im.importance_scores(docs, ratios).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id in (1, 2, 5):
            assert math.isclose(r.log_weight, ratios[buckets(dict(rows)[r.doc_id])].sum(), abs_tol=1e-9)
    assert [r.log_weight for r in got if r.doc_id in (3, 4)] == [0.0, 0.0]
    assert len({r.noisy_weight for r in got if r.doc_id == 5}) == 1


def test_threshold_is_the_kth_greatest(spark):
    rng = random.Random(5)
    values = [rng.choice([rng.gauss(0, 1), rng.gauss(0, 1e-9) + 1e6, 3.5]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 2, 700, 1500, 2999, 3000, 5000):
        assert im.threshold_of_rank(df, "v", k, cells=4) == sorted(values, reverse=True)[min(k, 3000) - 1]


def test_query_selects_good_text(spark):
    rows = Q.QUERIES["op6_quality_classifier"](spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    share = sum(labels.values()) / len(labels)
    assert len(rows) == 1000 and abs(sum(r.selected for r in rows) - round(share * 1000)) <= 5
    rate = [np.mean([r.selected for r in rows if labels.get(r.doc_id) == q]) for q in (0, 1)]
    assert rate[1] > rate[0] + 0.3


def test_no_labels_and_empty_table(spark, documents):
    docs = documents([(1, "a"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.selected for r in im.resample(docs.withColumn("good", F.lit(2)), none).collect()] == [True, True]
    assert im.resample(docs.limit(0), none).count() == 0
    assert im.resample(docs, none, share=0.0).where("selected").count() == 0


def test_target_counts_cover_all_good_documents(spark):
    docs = spark.range(20_500).select(F.col("id").alias("doc_id"), F.lit("word").alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    assert not im.log_ratios(docs, labels, buckets=64).any()  # target and raw counts are the same
