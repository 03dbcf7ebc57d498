import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import boosting, export, models

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    n = spark.range(600)
    a, b = F.pmod(F.xxhash64("id"), F.lit(97)) / 10.0, F.pmod(F.xxhash64("id", F.lit(7)), F.lit(31)) - 15.0
    c = F.when(F.col("id") % 5 == 0, 0.0).otherwise(F.col("id") / 100.0)
    y = (F.col("id") % 3 == 0) | (a > 6) & (b < 4)
    return n.select("id", a.alias("a"), b.cast("double").alias("b"), c.alias("c"), y.cast("int").alias("y"))


@pytest.mark.parametrize(
    ("kind", "params"),
    [("logistic", {"maxIter": 20}), ("forest", {"numTrees": 4, "maxDepth": 4}), ("boosting", {"maxIter": 3, "maxDepth": 3})],
)
def test_expression_gives_the_scores_of_the_model(spark, rows, kind, params):
    model = models.fit(kind, rows, FEATURES, "y", params)
    scored = models.score(model, rows).withColumn("own", export.score_expression(model, FEATURES, spark))
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()
    assert scored.agg(F.max(F.abs(F.col("own") - F.col("score")))).first()[0] < 1e-12


def test_missing_values_take_the_side_that_was_learnt(spark, rows):
    gapped = rows.withColumns({
        "a": F.when(F.col("id") % 4 != 0, F.col("a")), "b": F.when(F.col("id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("b")),
    })
    model = boosting.fit(gapped, FEATURES, "y", {"rounds": 4, "depth": 3, "bins": 8})
    held = boosting.score(model, gapped).withColumn("own", export.score_expression(model, FEATURES, spark)).toPandas()
    assert held["a"].isna().sum() == 150 and np.allclose(held["own"], held["score"], atol=1e-12, rtol=0)


def test_a_model_without_a_split(spark, rows):
    alike = rows.withColumns({f: F.lit(1.0) for f in FEATURES})
    model = models.fit("forest", alike, FEATURES, "y", {"numTrees": 2, "maxDepth": 3})
    scored = models.score(model, alike).withColumn("own", export.score_expression(model, FEATURES, spark))
    assert scored.agg(F.max(F.abs(F.col("own") - F.col("score")))).first()[0] < 1e-12
    assert {r["importance"] for r in export.split_importances(model, FEATURES, spark).collect()} == {0.0}


def test_importances_from_nodes(spark, rows):
    model = models.fit("forest", rows, FEATURES, "y", {"numTrees": 5, "maxDepth": 4})
    own = {r["feature"]: r["importance"] for r in export.split_importances(model, FEATURES, spark).collect()}
    assert sum(own.values()) == pytest.approx(1)
    for r in models.importances(model, FEATURES, spark).collect():
        assert own[r["feature"]] == pytest.approx(r["importance"], abs=1e-9)
