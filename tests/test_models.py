import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.functions import fixed
from riskweave.operators import attribution, metrics, models, registry, split
from riskweave.sources.shared import fresh_path
from riskweave.sources.tables import read_table, save_table

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] * x[:, 2] + rng.normal(0, 0.5, 600) > 0.4).astype(int)
    return spark.createDataFrame(pd.DataFrame(x, columns=FEATURES).assign(id=range(600), y=y)).cache()


def pair_auc(labels, scores):
    pos, neg = scores[labels == 1], scores[labels == 0]
    return ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))


@pytest.mark.parametrize("rows_per_part", [250_000, 40])
def test_auc_equals_pair_counting(spark, rows_per_part):
    rng = np.random.default_rng(2)
    y, s = rng.integers(0, 2, 300), np.round(rng.random(300), 1)
    frame = pd.concat([pd.DataFrame({"model": m, "label": y, "score": v}) for m, v in (("plain", s), ("flipped", -s))])
    got = {r["model"]: r["roc_auc"] for r in metrics.roc_auc(spark.createDataFrame(frame), rows_per_part=rows_per_part).collect()}
    assert got["plain"] == pytest.approx(pair_auc(y, s), abs=1e-6)
    assert got["flipped"] == pytest.approx(1 - got["plain"], abs=2e-6)


@pytest.mark.parametrize("rows_per_part", [250_000, 3])
def test_missing_scores_and_labels_are_left_out(spark, rows_per_part):
    rng = np.random.default_rng(3)
    y, s = rng.integers(0, 2, 100), np.round(rng.random(100), 2)
    whole = [("m", int(a), float(b)) for a, b in zip(y, s)]
    holes = [("m", 1, None)] * 20 + [("m", 0, float("nan"))] * 7 + [("m", None, 0.9)] * 5
    frame = spark.createDataFrame(whole + holes, "model string, label int, score double")
    assert metrics.roc_auc(frame, rows_per_part=rows_per_part).first()["roc_auc"] == pytest.approx(pair_auc(y, s), abs=1e-6)
    row = metrics.classification_metrics(frame, 0.5).first()
    assert row["accuracy"] == pytest.approx(((s > 0.5) == (y == 1)).mean(), abs=1e-6)
    assert metrics.confusion(frame, 0.5).agg(F.sum("row_count")).first()[0] == 100


def test_single_class_and_zero_denominators(spark):
    frame = spark.createDataFrame([("m", 0, 0.5), ("m", 0, 0.1)], "model string, label int, score double")
    row = metrics.evaluate(frame).first()
    assert row["roc_auc"] is None and row["accuracy"] == 1.0
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)
    assert metrics.confusion(frame).first()["predicted"] == 0


def test_leaderboard_and_strict_gate(spark):
    board = spark.createDataFrame([("x", 0.7, 0.2), ("y", 0.7, 0.3), ("z", 0.6, 0.9)], "model string, roc_auc double, f1 double")
    assert [r["model"] for r in metrics.leaderboard(board).collect()] == ["y", "x", "z"]
    equal = metrics.promotion_gate(board, "x", "y", F.lit("now")).first()
    assert (equal["better_model"], equal["promotion_action"]) == ("Champion", fixed.REJECTED)
    assert metrics.promotion_gate(board, "z", "y", F.lit("now")).first()["promotion_action"] == fixed.PROMOTED


def test_split_is_stratified_and_survives_repartition(rows):
    def members(df):
        return {r["id"] for r in split.stratified_split(df, "id", "y", 0.3, 101).where("is_test").collect()}

    first = members(rows)
    assert first == members(rows.repartition(7, "b"))
    for label, n in rows.groupBy("y").count().collect():
        got = rows.where((F.col("y") == label) & F.col("id").isin(list(first))).count()
        assert got == int(np.ceil(0.3 * n))


def test_class_weights(rows):
    counts = dict(rows.groupBy("y").count().collect())
    weights = dict(models.with_class_weight(rows, "y").select("y", "class_weight").distinct().collect())
    assert weights[1] == pytest.approx(600 / (2 * counts[1])) and weights[0] == pytest.approx(600 / (2 * counts[0]))
    lifted = dict(models.with_class_weight(rows, "y", "positive_ratio").select("y", "class_weight").distinct().collect())
    assert lifted == {0: 1.0, 1: round(counts[0] / counts[1], 2)}


def test_linear_attribution_adds_up(rows):
    weights = {"a": 0.5, "b": -1.0, "c": 2.0}
    means = attribution.background_means(rows, FEATURES)
    out = attribution.linear_shap(rows, weights, means).withColumn("m", attribution.logistic_margin(weights, 0.1)).toPandas()
    base = 0.1 + sum(w * means[f] for f, w in weights.items())
    np.testing.assert_allclose(out[[f"shap_{f}" for f in FEATURES]].sum(axis=1) + base, out["m"])


@pytest.mark.parametrize("kind, params", [("boosting", {"maxIter": 3, "maxDepth": 3}), ("forest", {"numTrees": 4, "maxDepth": 4})])
def test_tree_attribution_adds_up_and_equals_brute_force(rows, kind, params):
    model = models.fit(kind, rows, FEATURES, "y", params)
    out = attribution.tree_shap(models.score(model, rows), model, FEATURES).toPandas()
    total = out[[f"shap_{f}" for f in FEATURES]].sum(axis=1) + out["shap_base"]
    expected = out["score"] if kind == "forest" else np.log(out["score"] / (1 - out["score"])) / 2
    np.testing.assert_allclose(total, expected, atol=1e-9)

    trees = attribution.ensemble_nodes(model, rows.sparkSession)

    def value(tree, x, inside, node=0):
        f = tree.feature[node]
        if f < 0:
            return tree.value[node]
        lo, hi = tree.left[node], tree.right[node]
        if f in inside:
            return value(tree, x, inside, lo if x[f] <= tree.threshold[node] else hi)
        n_lo, n_hi = tree.cover[lo], tree.cover[hi]
        return (n_lo * value(tree, x, inside, lo) + n_hi * value(tree, x, inside, hi)) / (n_lo + n_hi)

    for _, r in out.head(5).iterrows():
        x = r[FEATURES].to_numpy(dtype=float)
        v = {s: sum(value(t, x, s) for t in trees) for s in map(frozenset, ([], [0], [1], [2], [0, 1], [0, 2], [1, 2], [0, 1, 2]))}
        phi = (v[frozenset([0])] - v[frozenset()]) / 3 + (v[frozenset([0, 1, 2])] - v[frozenset([1, 2])]) / 3
        phi += (v[frozenset([0, 1])] - v[frozenset([1])]) / 6 + (v[frozenset([0, 2])] - v[frozenset([2])]) / 6
        assert r["shap_a"] == pytest.approx(phi, abs=1e-9)


def test_drivers_and_sentence(spark):
    df = spark.createDataFrame([(7, 0.4715, 0.3, -0.2, 0.1)], "applicant_id int, score double, shap_a double, shap_b double, shap_c double")
    drivers = attribution.local_drivers(df, FEATURES)
    row = drivers.first()
    assert [d["feature"] for d in row["drivers_up"]] == ["a", "c", "b"]
    assert [d["feature"] for d in row["drivers_down"]] == ["b", "c", "a"]
    record = attribution.explanation_records(drivers, "score", "m/1", F.lit("now")).first()
    assert record["explanation_summary"] == "Risk 47.1% primarily driven UP by a and driven DOWN by b."
    assert (record["top_positive_shap"], record["top_negative_shap"]) == (0.3, -0.2)


def test_fit_quality_and_importance(rows):
    model = models.fit("logistic", rows, FEATURES, "y", {"maxIter": 30})
    auc = metrics.roc_auc(metrics.long_scores(models.score(model, rows), "y", {"m": "score"})).first()["roc_auc"]
    assert auc > 0.8
    assert models.importances(model, FEATURES, rows.sparkSession).first()["feature"] == "a"


def test_registry_versions_alias_and_fallback(spark, rows):
    store, where = fresh_path(spark, "registry"), fresh_path(spark, "models")
    model = models.fit("logistic", rows, FEATURES, "y", {"maxIter": 2})
    assert registry.register(spark, store, "risk", model, where, "Champion", {"auc": 0.6}, "t1") == 1
    assert registry.register(spark, store, "risk", model, where, "Challenger", {"auc": 0.7}, "t2") == 2
    table = read_table(spark, store)
    assert registry.resolve_alias(table, "risk", "Champion").first()["version"] == 1
    assert registry.resolve_alias(table, "risk", "Challenger").first()["version"] == 2
    assert registry.resolve_alias(table, "risk", "Unknown").first()["version"] == 1
    loaded, version = registry.load_by_alias(table, "risk", "Champion")
    assert version == 1 and models.score(loaded, rows).count() == 600
    with pytest.raises(LookupError):
        registry.load_by_alias(table, "other", "Champion")
    log = fresh_path(spark, "runs")
    save_table(registry.run_log(spark, "r1", {"depth": 3}, {"auc": 0.6}, {"a": 0.5}, "forest"), log, mode="append")
    assert {tuple(r) for r in read_table(spark, log).collect()} == {
        ("r1", "forest", "param", "depth", "3"), ("r1", "forest", "metric", "auc", "0.6"), ("r1", "forest", "importance", "a", "0.5")
    }
    registry.set_alias(spark, store, "risk", "Champion", 2, "t3")
    registry.set_alias(spark, store, "risk", "Champion", 1, "t3")
    registry.set_alias(spark, store, "risk", "Shadow", 1, "t3")
    table = read_table(spark, store)
    assert [registry.resolve_alias(table, "risk", a).first()["version"] for a in ("Champion", "Challenger", "Shadow")] == [1, 2, 1]
    with pytest.raises(LookupError):
        registry.set_alias(spark, store, "risk", "Champion", 9, "t4")


def test_synthetic_labels_follow_probability(spark):
    df = spark.range(4000).selectExpr("id", "1000.0D AS credit_amount", "499.0D AS income_proxy", "20.0D AS age", "0 AS target")
    out = split.synthetic_labels(df, "id")
    assert out.first()["label_probability"] == pytest.approx(0.4)
    assert out.agg(F.avg("target")).first()[0] == pytest.approx(0.4, abs=0.03)


def test_a_split_hashes_its_rows_before_the_passes(spark, monkeypatch):
    from riskweave.operators import split

    seen, quantiles = [], split.exact_quantiles
    monkeypatch.setattr(split, "exact_quantiles", lambda df, *rest, **more: seen.append(df) or quantiles(df, *rest, **more))
    rows = spark.range(1000).select(F.col("id"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    parts = split.stratified_split(rows, "id", "y", 0.2)
    assert parts.columns == ["id", "y", "is_test"] and parts.where("is_test").groupBy("y").count().orderBy("y").collect() == [(0, 134), (1, 67)]
    assert "Range" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
