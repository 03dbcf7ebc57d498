import uuid

import pytest
from pyspark.sql import functions as F

from riskweave.plans import fixtures as fx
from riskweave.plans.lifecycle import COMPARISON_SCHEMA, Lifecycle
from riskweave.sources.shared import fresh_path
from riskweave.sources.tables import latest_run

SF_DIR = "/root/testdata/sf0.001"
SMALL = {"logistic": {"maxIter": 5}, "forest": {"numTrees": 3, "maxDepth": 3}, "boosting": {"maxIter": 2, "maxDepth": 3}}


def rows_of(steps, name):
    """Rows but for the model version, which counts registrations, and for ids of fits."""
    schema = COMPARISON_SCHEMA if name == "model_comparison" else None
    df = steps.read(name, schema)
    return sorted(map(repr, df.drop("model_version").collect()))


def test_steps_hand_over_through_tables(spark):
    steps = Lifecycle(spark, fresh_path(spark, "lifecycle"), "run-1", "2026-01-01", SMALL)
    batch = fx.batch_like(spark, SF_DIR)
    audit = steps.run(
        fx.home_like(spark, SF_DIR), batch, fx.table(spark, SF_DIR, "benchmark"), passage_id="item_id"
    )
    assert audit.count() == batch.count() == audit.select("applicant_id").distinct().count()
    assert audit.where(F.col("shap_summary").contains("primarily driven UP")).count() == audit.count()
    drifted = latest_run(steps.read("drift_metrics"))
    assert drifted.count() == 5
    compared = steps.read("model_comparison", COMPARISON_SCHEMA).count()
    assert compared == int(drifted.where("psi_score >= 0.2").count() > 0)
    # Every step again under the same run: the tables hold the same rows.
    names = ["silver_home", "silver_batch", "leaderboard", "drift_metrics", "model_comparison", "explanations", "hallucination_cost", "audit_table"]
    held = {n: rows_of(steps, n) for n in names}
    steps.run(fx.home_like(spark, SF_DIR), batch, fx.table(spark, SF_DIR, "benchmark"), passage_id="item_id")
    for n in names:
        assert rows_of(steps, n) == held[n], n
    log = steps.read("run_log")
    assert {r["model"] for r in log.select("model").distinct().collect()} == {"logistic", "forest", "boosting"}
    assert log.where("kind = 'param' and key = 'maxDepth'").count() == 2 and log.where("kind = 'importance'").count() == 15
    # A second run appends to the histories; readers see the new run only.
    again = Lifecycle(spark, steps.root, "run-2", "2026-02-01", SMALL)
    again.monitor()
    assert again.read("drift_metrics").count() == 10
    assert {r["run_id"] for r in latest_run(again.read("drift_metrics")).collect()} == {"run-2"}


def test_tables_in_a_schema_of_a_catalog(spark):
    schema = f"riskweave_{uuid.uuid4().hex}"
    spark.sql(f"CREATE SCHEMA {schema} LOCATION '{fresh_path(spark, schema)}'")
    root = f"spark_catalog.{schema}"
    try:
        steps = Lifecycle(spark, root, "run-1", "2026-01-01", SMALL, files=fresh_path(spark, "files"))
        loans = fx.home_like(spark, SF_DIR), fx.batch_like(spark, SF_DIR), fx.table(spark, SF_DIR, "benchmark")
        audit = steps.run(*loans, passage_id="item_id")
        rows = audit.count()
        assert rows == loans[1].count() and spark.table(f"{root}.audit_table").count() == rows
        drifted = rows_of(steps, "drift_metrics")
        steps.monitor()  # again: replaces the rows of its run
        assert rows_of(steps, "drift_metrics") == drifted and len(drifted) == 5
        Lifecycle(spark, root, "run-2", "2026-02-01", SMALL, files=steps.files).monitor()
        assert steps.read("drift_metrics").count() == 10
    finally:
        spark.sql(f"DROP SCHEMA {schema} CASCADE")


def test_a_schema_as_root_needs_a_folder_for_files(spark):
    with pytest.raises(ValueError, match="folder"):
        Lifecycle(spark, "spark_catalog.none", "run-1", "2026-01-01").folder("models")


def test_equal_sentences_are_looked_up_once(spark, monkeypatch):
    from riskweave.plans import lifecycle

    steps = Lifecycle(spark, fresh_path(spark, "lifecycle"), "run-1", "2026-01-01", SMALL)
    said = [(k, ("high income loan", "short loan", None)[k % 3], 0.4) for k in range(30)]
    steps.append(spark.createDataFrame(said, "applicant_id long, explanation_summary string, total_risk_score double"), "explanations")
    asked, score = [], lifecycle.grounding.grounding_scores
    monkeypatch.setattr(lifecycle.grounding, "grounding_scores", lambda q, *rest, **more: asked.append(q.count()) or score(q, *rest, **more))
    policy = spark.createDataFrame([(1, "income of a loan"), (2, "short terms")], "paragraph_id long, text string")
    steps.ground(policy)
    costs = steps.read("hallucination_cost")
    assert asked == [3] and costs.count() == costs.select("applicant_id").distinct().count() == 30
