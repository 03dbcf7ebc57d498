import pytest
from pyspark.sql import functions as F

from riskweave.functions import fixed
from riskweave.operators import audit

EXPLAINED = "applicant_id long, explanation_summary string"
COST = "applicant_id long, impact_band string, review_flag string"
DRIFT = "feature_name string, psi_score double"
COMPARED = "timestamp string, promotion_action string"


def assemble(spark, explained, costs, drift, compared):
    scores = spark.createDataFrame([(1, 0.51), (2, 0.5), (3, 0.3)], "applicant_id long, model_prediction double")
    frames = [spark.createDataFrame(r, s) for r, s in ((explained, EXPLAINED), (costs, COST), (drift, DRIFT), (compared, COMPARED))]
    return audit.assemble_audit(scores, *frames, "m/1", F.lit("2026-01-01"))


def test_matched_first_and_default_values(spark):
    rows = assemble(
        spark, [(2, "own"), (9, "later")], [(3, "LOW", "ok")], [("a", 0.1), ("b", 0.2)], [("t1", "REJECTED"), ("t2", fixed.PROMOTED)]
    ).orderBy("applicant_id").collect()
    assert [r["shap_summary"] for r in rows] == ["own" + fixed.TEMPLATE_SUFFIX, "own", "own" + fixed.TEMPLATE_SUFFIX]
    assert [r["risk_classification"] for r in rows] == [fixed.RISK_HIGH, fixed.RISK_MEDIUM, fixed.RISK_LOW]
    assert {r["explanation_label"] for r in rows} == {"ok"}
    assert rows[0]["drift_score_avg_psi"] == 0.15 and rows[0]["retraining_status"] == fixed.PROMOTED


def test_empty_upstream_tables(spark):
    row = assemble(spark, [], [], [], []).first()
    assert row["shap_summary"] == fixed.NO_EXPLANATION and row["drift_score_avg_psi"] == 0.0
    assert row["explanation_label"] == fixed.NOT_EVALUATED and row["hallucination_cost_band"] == fixed.NOT_SCORED
    assert row["retraining_status"] == fixed.NO_RETRAINING


def test_latest_kpis_and_badges(spark):
    rows = [(1, "t1", 0.1, fixed.REVIEW_FLAGS["HIGH"], "HIGH"), (2, "t2", 0.3, fixed.REVIEW_FLAGS["LOW"], "LOW"), (3, "t2", 0.2, fixed.REVIEW_FLAGS["MEDIUM"], "MEDIUM")]
    df = spark.createDataFrame(rows, "applicant_id int, timestamp string, drift_score_avg_psi double, explanation_label string, hallucination_cost_band string")
    assert [r["applicant_id"] for r in audit.latest_audit(df, 2).collect()] == [2, 3]
    kpis = audit.dashboard_kpis(df).first()
    assert (kpis["total_audited"], kpis["blocks_prevented"], kpis["hallucination_rate_pct"], kpis["avg_drift_psi"]) == (3, 1, 33.3, 0.2)
    badges = [r[0] for r in df.orderBy("applicant_id").select(audit.badge(F.col("explanation_label"))).collect()]
    assert badges == ["BLOCKED", "APPROVED", "REVIEW"]
    assert spark.range(1).select(audit.short_class(F.lit(fixed.RISK_HIGH))).first()[0] == "HIGH RISK "


@pytest.mark.parametrize("age, income, duration, risk, label", [
    (24, 9999, 60, 0.65, "MEDIUM RISK"), (30, 149999, 6, 0.202, "LOW RISK"), (20, 9999, 72, 0.71, "HIGH RISK"), (40, -1, 10, None, "MEDIUM RISK")])
def test_scenarios(spark, age, income, duration, risk, label):
    df = spark.createDataFrame([(age, income, duration)], "age int, income int, duration int")
    row = audit.score_scenarios(df).first()
    assert row["predicted_risk"] == (None if risk is None else pytest.approx(risk)) and row["classification"] == label


def test_slider_grid_and_snap(spark):
    grid = audit.what_if(spark.range(1), age=fixed.SLIDER_AGE, income=fixed.SLIDER_INCOME, duration=fixed.SLIDER_DURATION)
    assert grid.count() == 63 * 29 * 67
    values = spark.createDataFrame([(5.0,), (14999.0,), (999999.0,)], "v double").select(audit.snap(F.col("v"), fixed.SLIDER_INCOME))
    assert [r[0] for r in values.collect()] == [10000, 10000, 150000]


def test_positions_and_audit_read_what_they_need(spark, monkeypatch):
    from riskweave.plans import catalog

    seen, kept, place, store = [], {}, catalog.ranking.with_ordinal, catalog.fx.stored
    monkeypatch.setattr(catalog.ranking, "with_ordinal", lambda df, *rest: seen.append(df) or place(df, *rest))
    monkeypatch.setattr(catalog.fx, "stored", lambda df, name: kept.setdefault(name, df.columns) and store(df, name))
    assert catalog.applicant_ordinal(spark, "/root/testdata/sf0.001").count() > 0
    assert "md5" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert catalog._assembled_audit(spark, "/root/testdata/sf0.001").count() > 0
    assert kept["explanations"] == ["applicant_id", "explanation_summary"] and kept["costs"] == ["applicant_id", "impact_band", "review_flag"]
