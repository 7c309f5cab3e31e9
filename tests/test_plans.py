"""Plan-shape tests: the scale properties the design relies on."""

import contextlib
import io
import re

from quarry.plans import catalog

from sf_paths import SF001


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _no_pair_joins(plan: str):
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_overlap_pushes_filter_and_prunes_columns(spark):
    plan = _plan(catalog.q_category_overlap(spark, SF001))
    assert "PushedFilters: [In(c_mktsegment, [AUTOMOBILE,BUILDING])" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    # the lineitem side is never the broadcast side
    tree = plan.split("\n\n")[0]
    assert re.search(r"SortMergeJoin", tree)
    # partial aggregation before each exchange
    assert plan.count("HashAggregate") >= 4
    _no_pair_joins(plan)


def test_growth_limits_rows_before_the_shuffle(spark):
    plan = _plan(catalog.q_growth_over_1000(spark, SF001))
    tree = plan.split("\n\n")[0].splitlines()
    partial = next(i for i, ln in enumerate(tree) if "WindowGroupLimit" in ln and i > 0
                   and any("Exchange" in x for x in tree[:i]))
    assert any("Exchange" in x for x in tree[:partial])
    assert "Partial" in plan and "Final" in plan
    # exactly one hash exchange on the keys (the aggregate reuses it) plus the range sort
    assert plan.count("hashpartitioning(market") == 1
    assert "rangepartitioning(market" in plan


def test_knn_has_no_pair_join_and_vote_reuses_partitioning(spark):
    for q in (catalog.q_knn_predict, catalog.q_knn_blocked, catalog.q_merge_confusion):
        plan = _plan(q(spark, SF001))
        _no_pair_joins(plan)
        assert "FlatMapCoGroupsInPandas" in plan
    fold_plan = _plan(catalog.q_merge_confusion(spark, SF001)).split("\n\n")[0]
    # the fold travels with the candidates: no shuffle join (only the bounded
    # bucket-offset broadcast inside the fold positions remains)
    assert "SortMergeJoin" not in fold_plan and "ShuffledHashJoin" not in fold_plan
    plan = _plan(catalog.q_knn_blocked(spark, SF001))
    assert "WindowGroupLimit" in plan
    assert plan.count("hashpartitioning(qid") == 1  # merge window and vote share one exchange


def test_evaluation_has_no_join(spark):
    for q in (catalog.q_confusion_matrix, catalog.q_class_metrics):
        plan = _plan(q(spark, SF001))
        _no_pair_joins(plan)
        assert "Join" not in plan.split("\n\n")[0]


def test_bucketed_fact_tables_join_without_exchange(spark):
    from quarry.operators import trending as tr
    from quarry.plans import fixtures as fx
    from quarry.sources.tables import overlap_inputs_bucketed
    li, o = overlap_inputs_bucketed(spark, SF001, 8, prefix="t_bucket")
    c = fx.table(spark, SF001, "customer").select("c_custkey", "c_mktsegment")
    result = tr.category_overlap(fx.overlap_observations_from(li, o, c), fx.MARKET_1, fx.MARKET_2)
    plan = _plan(result)
    assert "SortMergeJoin" in plan
    # both sides of the order-key join are read in bucket order: no exchange on the key
    assert "hashpartitioning(l_orderkey" not in plan and "hashpartitioning(o_orderkey" not in plan
    want = sorted(map(tuple, catalog.q_category_overlap(spark, SF001).collect()))
    assert sorted(map(tuple, result.collect())) == want


def test_knn_sizing_job_reads_only_ids(spark):
    from quarry.operators import neighbors as nn
    from quarry.plans import fixtures as fx
    q, t = fx.knn_sides(spark, SF001)
    plan = _plan(nn._id_counts(q, t, "qid", "tid"))
    schemas = [ln for ln in plan.splitlines() if "ReadSchema" in ln]
    assert schemas and all(ln.strip() == "ReadSchema: struct<vec_id:bigint>" for ln in schemas)
