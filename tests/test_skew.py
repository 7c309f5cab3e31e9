"""Hot keys: one key (or one group of exact copies) holding a third of the
rows must give the same answers as a plain-Python reference."""

import random

from pyspark.sql import functions as F

from quarry.operators import evaluation as ev
from quarry.operators import models as ml
from quarry.operators import trending as tr
from test_properties import _py_growth, _py_overlap


def _rows_with_hot_key(n, hot_share=1 / 3, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i < n * hot_share:
            rows.append(("US", "hot", rng.randrange(1000), float(rng.randrange(1, 100)), i))
        else:
            rows.append((rng.choice(["US", "GB"]), f"i{rng.randrange(200)}", rng.randrange(1000),
                         float(rng.randrange(1, 100)), i))
    return rows


def test_growth_with_a_hot_key(spark):
    rows = _rows_with_hot_key(3000)
    df = spark.createDataFrame(rows, "market string, item_id string, date_key int, views double, obs_id long")
    got = {(r.market, r.item_id): r.pct for r in
           tr.growth_first_two(df.repartition(12), tiebreak="obs_id").collect()}
    assert got == _py_growth(rows)


def test_overlap_with_a_hot_category_and_item(spark):
    rng = random.Random(9)
    rows = [("hot", "x", rng.choice(["US", "GB"])) for _ in range(1000)]
    rows += [(rng.choice(["c1", "c2"]), str(rng.randrange(300)), rng.choice(["US", "GB", "FR"])) for _ in range(2000)]
    df = spark.createDataFrame(rows, "category string, item_id string, market string").repartition(12)
    got = {r.category: (r.count_m1, r.overlap, r.pct) for r in tr.category_overlap(df, "US", "GB").collect()}
    assert got == _py_overlap(rows, "US", "GB")


def test_confusion_with_a_hot_cell(spark):
    rows = [(3, 3)] * 1000 + [(a % 10, (a * 7) % 10) for a in range(2000)]
    pred = spark.createDataFrame(rows, "actual int, predicted int").repartition(12)
    cells = {(r.predicted, r.actual): r.n for r in ev.confusion_matrix(pred, 10).collect()}
    want = {}
    for a, p in rows:
        want[(p, a)] = want.get((p, a), 0) + 1
    assert all(cells[k] == want.get(k, 0) for k in cells) and sum(cells.values()) == 3000


def test_row_positions_with_exact_copies(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, F.lit(7)).otherwise(F.col("id")).alias("key"))
    pos = ml.row_position(df.repartition(6), "key", n_buckets=6).collect()
    assert sorted(r.pos for r in pos) == list(range(3000))
    keys = [r.key for r in sorted(pos, key=lambda r: r.pos)]
    assert keys == sorted(keys)


def test_hot_order_key_is_split_by_adaptive_skew_join(spark):
    """A third of the fact rows share one order key; with the skew thresholds
    scaled down to test size, AQE splits that partition of the sort-merge
    join, and the overlap stays exact."""
    from quarry.plans import fixtures as fx
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        n = 30000
        li = spark.range(n).select(F.when(F.col("id") < n / 3, F.lit(0)).otherwise(F.col("id") % 5000)
                                   .alias("l_orderkey"), (F.col("id") % 997).alias("l_partkey"))
        o = spark.range(5000).select(F.col("id").alias("o_orderkey"), (F.col("id") % 300).alias("o_custkey"),
                                     F.concat(F.lit("P"), (F.col("id") % 5).cast("string")).alias("o_orderpriority"))
        c = spark.range(300).select(F.col("id").alias("c_custkey"),
                                    F.when(F.col("id") % 2 == 0, F.lit("BUILDING")).otherwise(F.lit("AUTOMOBILE"))
                                    .alias("c_mktsegment"))
        df = tr.category_overlap(fx.overlap_observations_from(li, o, c), "BUILDING", "AUTOMOBILE")
        got = {r.category: (r.count_m1, r.overlap, r.pct) for r in df.collect()}
        assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    cust = {i: ("BUILDING" if i % 2 == 0 else "AUTOMOBILE") for i in range(300)}
    rows = []
    for i in range(n):
        ok = 0 if i < n / 3 else i % 5000
        rows.append((f"P{ok % 5}", str(i % 997), cust[ok % 300]))
    assert got == _py_overlap(rows, "BUILDING", "AUTOMOBILE")
