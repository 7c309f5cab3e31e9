"""Property tests: invariance under repartitioning, and generated inputs
checked against plain-Python references (one Spark job per example batch)."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators import trending as tr
from quarry.plans import catalog
from quarry.plans import fixtures as fx
from quarry.sources import text as textio

from sf_paths import SF001

FIELD = st.text(alphabet=st.sampled_from(list('ab ,"x1')), max_size=8)


def _csv_field(s: str) -> str:
    """Quote a field when it holds a comma or quote (quotes doubled)."""
    return '"' + s.replace('"', '""') + '"' if ("," in s or '"' in s) else s


@settings(max_examples=5, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(FIELD, min_size=1, max_size=6), min_size=1, max_size=40))
def test_split_quoted_recovers_quoted_fields(spark, records):
    lines = [",".join(_csv_field(f) for f in rec) for rec in records]
    want = [[_csv_field(f) for f in rec] for rec in records]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    got = [list(r[1]) for r in sorted(df.select("i", textio.split_quoted("line")).collect())]
    assert got == want


def _py_growth(rows):
    groups = {}
    for market, item, d, views, oid in rows:
        groups.setdefault((market, item), []).append((d, oid, views))
    out = {}
    for key, obs in groups.items():
        obs.sort()
        if len(obs) < 2:
            out[key] = 0.0
        else:
            e, l_ = obs[0][2], obs[1][2]
            out[key] = None if e == 0 else (l_ - e) / e * 100.0
    return out


@settings(max_examples=5, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["US", "GB"]), st.integers(0, 6), st.integers(0, 5),
                          st.integers(0, 50)), min_size=1, max_size=80))
def test_growth_matches_python_reference(spark, obs):
    rows = [(m, str(i), d, float(v), n) for n, (m, i, d, v) in enumerate(obs)]
    df = spark.createDataFrame(rows, "market string, item_id string, date_key int, views double, obs_id long")
    got = {(r.market, r.item_id): r.pct for r in tr.growth_first_two(df, tiebreak="obs_id").collect()}
    assert got == _py_growth(rows)


def _py_overlap(rows, m1, m2):
    per = {}
    for cat, item, market in rows:
        per.setdefault(cat, {}).setdefault(item, set()).add(market)
    out = {}
    for cat, items in per.items():
        n1 = sum(1 for s in items.values() if m1 in s)
        both = sum(1 for s in items.values() if m1 in s and m2 in s)
        if n1:
            out[cat] = (n1, both, both / n1 * 100.0)
    return out


@settings(max_examples=5, deadline=None, derandomize=True,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["c1", "c2", "c3"]), st.integers(0, 9),
                          st.sampled_from(["US", "GB", "FR"])), min_size=1, max_size=80))
def test_overlap_matches_python_reference(spark, obs):
    rows = [(c, str(i), m) for c, i, m in obs]
    df = spark.createDataFrame(rows, "category string, item_id string, market string")
    got = {r.category: (r.count_m1, r.overlap, r.pct) for r in tr.category_overlap(df, "US", "GB").collect()}
    assert got == _py_overlap(rows, "US", "GB")


def test_flagships_invariant_under_repartition(spark):
    base = sorted(map(tuple, catalog.q_category_overlap(spark, SF001).collect()))
    obs = fx.overlap_observations(spark, SF001).repartition(13, "item_id")
    again = sorted(map(tuple, tr.category_overlap(obs, fx.MARKET_1, fx.MARKET_2).collect()))
    assert base == again
    g1 = sorted(map(tuple, catalog.q_growth_first_two(spark, SF001).collect()))
    shuffled = fx.growth_observations(spark, SF001).repartition(7).orderBy(F.rand(3))
    g2 = sorted(map(tuple, tr.growth_first_two(shuffled, tiebreak="obs_id").select(
        "market", "item_id", "n_used", "early", "late", "pct").collect()))
    assert g1 == g2


def test_knn_invariant_under_repartition(spark):
    q, t = fx.knn_sides(spark, SF001)
    from quarry.operators import neighbors as nn
    a = sorted(map(tuple, nn.knn_classify(q, t, 5).collect()))
    b = sorted(map(tuple, nn.knn_classify(q.repartition(5), t.repartition(3), 5, block_rows=50).collect()))
    assert a == b


def test_confusion_total_equals_rows(spark):
    from quarry.operators import evaluation as ev
    random.seed(1)
    rows = [(random.randrange(10), random.randrange(10)) for _ in range(500)]
    pred = spark.createDataFrame(rows, "actual int, predicted int")
    m = ev.confusion_matrix(pred, 10)
    assert m.agg(F.sum("n")).first()[0] == 500 and m.count() == 100
