"""What the plans look like: no Python workers, pruned scans, few shuffles, bounded broadcasts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskflow.operators import classify, features, quality, sampling
from riskflow.plans import catalog, stand_ins
from riskflow.sources import read_table

from conftest import SMALL

EAGER = {
    "prepared_rows",
    "train_predict",
    "train_metrics",
    "training_summary",
    "train_leak_free",
    "grid_search",
    "cross_validation",
    "score_saved",
    "model_comparison",
    "stream_decode",
    "stream_landing",
    "landed_files",
    "changed_files",
    "fast_credit_stream",
    "stream_windows",
    "stream_dedupe",
    "stream_blacklist",
    "runs_compacted",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - EAGER))
def test_no_python_and_no_cartesian_product(spark, name):
    plan = plan_of(catalog.queries()[name](spark, SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert node not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    lines = catalog._lineitem(spark, SMALL)
    label = read_table(spark, SMALL, "lineitem").filter(F.col("l_returnflag") == "R").select("l_suppkey")
    assert "EqualTo(l_returnflag,R)" in plan_of(label)
    scan = plan_of(features.terminal_profile(lines))
    assert "ReadSchema: struct<l_suppkey:bigint,l_returnflag:string>" in scan


def test_one_shuffle_for_audit_and_clean(spark):
    raw = stand_ins.raw_transactions(read_table(spark, SMALL, "events"))
    for df in (quality.audit(raw), quality.clean(raw)):
        plan = plan_of(df)
        assert plan.count("Exchange hashpartitioning") == 1
        assert plan.count("HashAggregate") == 2


def test_row_tests_run_before_the_shuffle(spark):
    raw = stand_ins.raw_transactions(read_table(spark, SMALL, "events"))
    plan = plan_of(quality.clean(raw))
    assert plan.index("Exchange hashpartitioning") < plan.index("Filter")


def test_terminal_profile_is_one_partial_aggregate(spark):
    plan = plan_of(features.terminal_profile(catalog._lineitem(spark, SMALL)))
    assert plan.count("Exchange") == 1 and "partial_count" in plan and "Join" not in plan


def test_enrichment_broadcasts_terminals_only(spark):
    df = features.enrich(catalog._stored(spark, SMALL))
    plan = plan_of(df)
    assert "BroadcastHashJoin" in plan and "LeftOuter, BuildRight" in plan
    assert "SortMergeJoin" not in plan
    left = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in left.split("BroadcastHashJoin")[1]


def test_oversampling_moves_no_rows(spark):
    df = sampling.oversample(catalog._lineitem(spark, SMALL))
    body = plan_of(df).split("Subquery")[0]
    assert "Exchange hashpartitioning" not in body


def test_predictions_stay_in_the_jvm(spark):
    ready = catalog.jobs.prepare(catalog._features(spark, SMALL))
    model = classify.logistic().fit(ready.train)
    plan = plan_of(classify.predict(model, ready.test, [catalog.jobs.ID]))
    assert "EvalPython" not in plan and "Exchange" not in plan
