"""Every registered query: result against its SQL, and the shape of its plan."""

import re

import pytest

import __spark_entry__ as contract
from check import connect, difference
from riskweave.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"
PYTHON_STAGES = {"ann_topk", "ann_recall", "cosine_topk", "context_blocks", "tree_shap", "tree_shap_additive", "train_second_order", "second_order_additive", "interventional_additive"}
# One row per model, or per range of rows.
SMALL_WINDOW = {"leaderboard", "numbered_applicants"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_oracle_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "model_lifecycle"])  # see test_lifecycle
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
    if name not in PYTHON_STAGES:
        assert not re.search(r"Python|InPandas|Arrow", plan)
    if name not in SMALL_WINDOW:  # one task may order the totals of a level of buckets, a few thousand rows at any size, not rows
        single = re.findall(r"(Window.*)\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan)
        assert all("_s_" in window for window in single)
    got = df.toPandas()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
    else:
        assert difference(got, duck.execute(sql).df()) == ""


def test_entry_is_stable(spark):
    assert contract.entry(spark).columns == ["feature_name", "psi_score", "drift_status"]


def test_scan_prunes_columns_and_pushes_filters(spark):
    plan = contract.queries()["drift_psi_injected"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_quantity)" in plan
    assert "l_partkey" not in plan and "l_orderkey" not in plan


def test_policy_index_is_broadcast_and_tokens_are_not_shuffled_alone(spark):
    plan = contract.queries()["grounding_score"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [term" in plan
