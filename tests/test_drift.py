import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskweave.functions import fixed
from riskweave.operators import drift


def reference_psi(base, incoming, bins=10, eps=1e-4):
    """Plain numpy form: quantile edges, right-closed bins, epsilon for empty shares."""
    inner = np.unique(np.quantile(base, np.linspace(0, 1, bins + 1)))[1:-1]
    e, a = (np.bincount(np.searchsorted(inner, x, side="left"), minlength=len(inner) + 1) / len(x) for x in (base, incoming))
    e, a = np.where(e == 0, eps, e), np.where(a == 0, eps, a)
    return round(float(((a - e) * np.log(a / e)).sum()), 4)


def frames(spark, base, incoming):
    return (spark.createDataFrame(pd.DataFrame({"x": np.asarray(v, dtype=float)})) for v in (base, incoming))


def psi(spark, base, incoming):
    return drift.drift_psi(*frames(spark, base, incoming), ["x"]).first()["psi_score"]


def test_psi_matches_plain_form(spark):
    rng = np.random.default_rng(1)
    base, moved = rng.normal(0, 1, 2000), rng.normal(0.7, 1.3, 900)
    assert psi(spark, base, moved) == pytest.approx(reference_psi(base, moved), abs=1e-4)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-20, 20), min_size=1, max_size=60), st.lists(st.integers(-30, 30), min_size=1, max_size=60))
def test_psi_properties(spark, base, incoming):
    assert psi(spark, base, base) == 0.0
    score = psi(spark, base, incoming)
    assert score >= 0 and score == pytest.approx(reference_psi(base, incoming), abs=1e-4)


def test_constant_feature_is_stable(spark):
    assert psi(spark, [3.0] * 20, [8.0, 1.0]) == 0.0


def test_bins_are_right_closed_and_hold_every_complete_row(spark):
    base, incoming = frames(spark, range(1, 101), [10.9, -500.0, 900.0, float("nan")])
    edges = drift.fit_edges(base, ["x"])
    assert len(edges["x"]) == 9
    on_edge = spark.createDataFrame([(edges["x"][0],)], "x double")
    hist = {r["bin"]: r for r in drift.drift_histogram(base, on_edge, edges).collect()}
    assert hist[0]["actual_rows"] == 1 and sum(r["expected_rows"] for r in hist.values()) == 100
    hist = {r["bin"]: r["actual_rows"] for r in drift.drift_histogram(base, incoming, edges).collect()}
    assert hist[0] == 2 - 1 + (10.9 <= edges["x"][0]) and hist[9] == 1 and sum(hist.values()) == 3


def test_rows_missing_any_feature_are_left_out(spark):
    rows = spark.createDataFrame([(float(i), float(i)) for i in range(50)] + [(1000.0, None), (float("nan"), 2.0)], "x double, y double")
    hist = drift.drift_histogram(rows, rows, drift.fit_edges(rows, ["x", "y"]))
    assert {r["n"] for r in hist.groupBy("feature_name").agg({"expected_rows": "sum"}).toDF("f", "n").collect()} == {50}


def test_status_thresholds_and_trigger(spark):
    scores = spark.createDataFrame([("a", 0.0999), ("b", 0.1), ("c", 0.2)], "feature_name string, psi_score double")
    report = scores.withColumn("drift_status", drift.drift_status(scores["psi_score"]))
    assert [r["drift_status"] for r in report.orderBy("feature_name").collect()] == [fixed.DRIFT_STABLE, fixed.DRIFT_MONITOR, fixed.DRIFT_RETRAIN]
    summary = drift.drift_trigger(report).first()
    assert summary["max_feature"] == "c" and summary["retraining_trigger"] and summary["avg_psi"] == 0.1333
    assert not drift.drift_trigger(report.where("psi_score < 0.2")).first()["retraining_trigger"]
