import math

import pytest
from pyspark.sql import functions as F

from quarry.functions.scalars import (date_key, format_pct, growth_pct, overlap_line, parse_long,
                                      trunc_long)
from quarry.operators import trending as tr


def _obs(spark, rows):
    return spark.createDataFrame(rows, "category string, item_id string, market string")


def test_category_overlap_counts_distinct_items(spark):
    obs = _obs(spark, [
        ("c1", "a", "US"), ("c1", "a", "US"), ("c1", "a", "GB"),   # a: both markets, duplicated
        ("c1", "b", "US"),                                          # b: US only
        ("c1", "c", "GB"),                                          # c: GB only (not counted)
        ("c1", "d", "FR"),                                          # other market: ignored
        ("c2", "e", "GB"),                                          # no US item: category dropped
    ])
    out = {r.category: r for r in tr.category_overlap(obs, "US", "GB").collect()}
    assert set(out) == {"c1"}
    assert (out["c1"].count_m1, out["c1"].overlap, out["c1"].pct) == (2, 1, 50.0)


def test_category_overlap_is_case_sensitive_and_rejects_same_market(spark):
    obs = _obs(spark, [("c1", "a", "us"), ("c1", "a", "GB")])
    assert tr.category_overlap(obs, "US", "GB").count() == 0
    with pytest.raises(ValueError):
        tr.category_overlap(obs, "US", "US")


def test_pct_format_matches_decimal_pattern(spark):
    vals = [0.25, 12.25, 0.0, 66.66666, 100.0, 12.35]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(format_pct("x")).collect()]
    assert got == [".2", "12.2", ".0", "66.7", "100.0", "12.3"]


def test_overlap_line(spark):
    df = spark.createDataFrame([(12, 50.0)], "n long, pct double")
    assert df.select(overlap_line("n", "pct", "GB")).first()[0] == "total 12.0; 50.0% in GB"


def test_date_key_and_malformed(spark):
    df = spark.createDataFrame([("17.14.11",), ("17-14-11",), ("17.14",), ("a.b.c",), (None,)], "d string")
    assert [r[0] for r in df.select(date_key("d")).collect()] == [171114, None, None, None, None]


def test_parse_long_is_strict(spark):
    df = spark.createDataFrame([("42",), ("-7",), ("4.0",), (" 4",), ("",), ("99999999999999999999",)],
                               "s string")
    assert [r[0] for r in df.select(parse_long("s")).collect()] == [42, -7, None, None, None, None]


def test_growth_pct_and_trunc(spark):
    df = spark.createDataFrame([(100.0, 1200.0), (0.0, 5.0), (0.0, 0.0), (10.0, 5.0)], "e double, l double")
    rows = df.select(growth_pct("e", "l").alias("p"), growth_pct("e", "l", "infinite").alias("q")).collect()
    assert rows[0].p == 1100.0 and rows[3].p == -50.0
    assert rows[1].p is None and rows[1].q == math.inf
    assert rows[2].p is None and rows[2].q is None
    t = spark.createDataFrame([(1099.9,), (-3.7,), (float("inf"),), (None,)], "x double")
    assert [r[0] for r in t.select(trunc_long("x")).collect()] == [1099, -3, 9223372036854775807, None]


def _growth_obs(spark):
    rows = [
        # market, item, date_key, views, obs_id
        ("US", "v1", 171102, 10, 1), ("US", "v1", 171101, 1, 2), ("US", "v1", 171103, 500, 3),
        ("US", "v2", 171101, 7, 4),                              # single observation -> 0
        ("US", "v3", None, 1, 5), ("US", "v3", 171105, 1, 6),    # one valid row -> 0
        ("GB", "v4", 171101, 2, 8), ("GB", "v4", 171101, 30, 7),  # tie on date: obs_id decides
        ("GB", "v5", 171101, 0, 9), ("GB", "v5", 171102, 4, 10),  # zero base
        ("GB", "v6", None, 3, 11),                               # no valid date -> 0
    ]
    return spark.createDataFrame(rows, "market string, item_id string, date_key int, views long, obs_id long")


def test_growth_first_two(spark):
    g = tr.growth_first_two(_growth_obs(spark), tiebreak="obs_id")
    out = {r.item_id: r for r in g.collect()}
    assert out["v1"].early == 1 and out["v1"].late == 10 and out["v1"].pct == 900.0
    assert out["v2"].pct == 0.0 and out["v3"].pct == 0.0 and out["v6"].pct == 0.0
    assert out["v4"].early == 30 and out["v4"].late == 2
    assert out["v5"].pct is None
    inf = {r.item_id: r.pct for r in tr.growth_first_two(_growth_obs(spark), tiebreak="obs_id",
                                                          zero_base="infinite").collect()}
    assert inf["v5"] == math.inf


def test_growth_report_threshold_and_order(spark):
    rows = [("US", "a", 1000.0), ("US", "b", 999.99), ("GB", "c", 5000.0), ("US", "d", 2500.5), ("GB", "e", None)]
    g = spark.createDataFrame(rows, "market string, item_id string, pct double")
    rep = tr.growth_report(g, 1000).collect()
    assert [(r.market, r.item_id) for r in rep] == [("US", "d"), ("US", "a"), ("GB", "c")]
    assert rep[0].line == "US;  d,  2500.5%"
    assert rep[0].pct_trunc == 2500


def test_first_n_by_date_keeps_n_per_key(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("d"))
    out = tr.first_n_by_date(df, ["k"], ["d"], 2).orderBy("k", "d").collect()
    assert [(r.k, r.d) for r in out] == [(0, 0), (0, 3), (1, 1), (1, 4), (2, 2), (2, 5)]


def test_overlap_ignores_null_market_and_keeps_null_item_group(spark):
    obs = _obs(spark, [("c1", "a", None), ("c1", "a", "US"), ("c1", None, "US"), ("c1", None, "GB"),
                       (None, "z", "US")])
    out = {r.category: (r.count_m1, r.overlap) for r in tr.category_overlap(obs, "US", "GB").collect()}
    # the NULL item is one group (seen in both markets); the NULL category is its own group
    assert out == {"c1": (2, 1), None: (1, 0)}


def test_tied_dates_put_a_missing_count_last(spark):
    rows = [("m", "i", 170101, None), ("m", "i", 170101, 5), ("m", "i", 170101, 100)]
    obs = spark.createDataFrame(rows, "market string, item_id string, date_key int, views long")
    r = tr.growth_first_two(obs, tiebreak="views").first()
    assert (r.early, r.late, r.n_used, r.pct) == (5, 100, 2, 1900.0)


def test_date_key_pieces(spark):
    from quarry.functions.scalars import date_key, is_well_formed_date
    texts = ["17.14.11", "17.14.", "17.14.11.", "17..11", "17.14.11.x", "a.b.c", "", "...", None, ".14.11"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(date_key("t").alias("k"), is_well_formed_date("t").alias("w"))
    got = df.collect()
    assert [r.k for r in got] == [171114, None, 171114, 1711, None, None, None, None, None, 1114]
    assert [r.w for r in got] == [True, False, True, True, False, True, False, False, None, True]
