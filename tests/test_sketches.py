import random

import pytest
from pyspark.sql import functions as F

from riskweave.operators import drift, impute, sketches
from riskweave.sources.shared import fresh_path


def off_rank(values, p, v):
    below, upto = sum(x < v for x in values) / len(values), sum(x <= v for x in values) / len(values)
    return max(below - p, p - upto, 0)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(6)
    return [(k % 3 if k % 2 else 0, rng.gauss(0, 1), rng.choice([None, float("nan"), 1.0, 2.0, rng.random()])) for k in range(30_000)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "g int, a double, b double").repartition(9)


def present(rows, column, group=None):
    return [r[column] for r in rows if r[column] is not None and r[column] == r[column] and (group is None or r[0] == group)]


@pytest.mark.parametrize("fan_in", [2, 3, 64])
def test_levels_of_merges_keep_the_rank_error(frame, rows, monkeypatch, fan_in):
    monkeypatch.setattr(sketches, "FAN_IN", fan_in)
    found = sketches.quantiles(sketches.build(frame, ["a", "b"], ["g"], 512), [0.0, 0.2, 0.5, 0.99, 1.0]).collect()
    assert len(found) == 3 * 2 * 5
    for r in found:
        values = present(rows, 1 if r["feature"] == "a" else 2, r["g"])
        assert r["n"] == len(values) and off_rank(values, r["probability"], r["value"]) <= 3 * sketches.rank_error(512)


def test_no_task_merges_more_than_the_fan_in(frame, monkeypatch):
    monkeypatch.setattr(sketches, "FAN_IN", 2)
    seen = []
    merge = F.kll_merge_agg_double
    monkeypatch.setattr(F, "kll_merge_agg_double", lambda c, k: seen.append(k) or merge(c, k))
    sketches.build(frame, ["a"], size=128).collect()
    assert len(seen) >= 3  # nine tasks: five parts, three, two, one


def test_history_needs_no_rows_and_a_batch_replaces_itself(spark, frame, rows):
    path = fresh_path(spark, "history")
    for batch in (0, 1, 2, 1):
        sketches.append_batch(frame.where(F.col("g") == batch), ["a"], path, str(batch), "2026-01-01")
    got = {r["probability"]: r for r in sketches.history_quantiles(spark, path, [0.1, 0.5]).collect()}
    for p, r in got.items():
        assert r["n"] == len(rows) and off_rank(present(rows, 1), p, r["value"]) <= 3 * sketches.rank_error()
    some = sketches.history_quantiles(spark, path, [0.5], ["1", "2"]).first()
    values = present(rows, 1, 1) + present(rows, 1, 2)
    assert some["n"] == len(values) and off_rank(values, 0.5, some["value"]) <= 3 * sketches.rank_error()
    assert sketches.history_quantiles(spark, fresh_path(spark, "absent"), [0.5]).count() == 0


def test_bin_shares_follow_the_drift_histogram(frame):
    edges = {"a": [-1.0, 0.0, 0.7], "b": []}
    got = {(r["feature"], r["bin"]): r["share"] for r in sketches.bin_shares(sketches.build(frame, ["a", "b"]), edges).collect()}
    complete = frame.select("a").where("a is not null")
    want = {r["bin"]: r["expected_share"] for r in drift.drift_histogram(complete, complete, {"a": edges["a"]}).collect()}
    assert got[("b", 0)] == 1.0 and all(got["a", b] == pytest.approx(s, abs=4 * sketches.rank_error()) for b, s in want.items())


def test_medians_and_empty_columns(spark, frame, rows):
    held = frame.withColumn("none", F.lit(None).cast("double"))
    medians = impute.fit_medians(held, ["a", "b", "none"])
    assert set(medians) == {"a", "b"}
    assert off_rank(present(rows, 1), 0.5, medians["a"]) <= 0.001
    small = spark.createDataFrame([(v,) for v in (5.0, 1.0, 4.0, 2.0)], "x double")
    assert impute.fit_medians(small, ["x"]) == impute.fit_medians(small, ["x"], exact=True) == {"x": 2.0}
    assert impute.fit_medians(small.where("x > 9"), ["x"]) == {}


def test_size_and_error_belong_together():
    assert sketches.size_for(sketches.rank_error(4096)) in (4096, 4097) and sketches.size_for(1e-9) == 65_535


def test_ranks_are_checked_without_sending_all_values_to_every_task(spark):
    """What is broadcast are the few quantiles, not the values, which are as many as the rows."""
    from riskweave.plans import catalog

    rows = spark.range(4000).select(*[(F.col("id") * k).cast("double").alias(c) for k, c in enumerate(catalog.LINE_FEATURES, 1)])
    found = spark.createDataFrame([(c, 4000, 0.5, 2000.0 * k) for k, c in enumerate(catalog.LINE_FEATURES, 1)], "feature string, n long, probability double, value double")
    checked = catalog._off_rank(rows, found, [])
    assert checked.count() == 3 and all(r["off"] <= 0.001 for r in checked.collect())
    plan = checked._jdf.queryExecution().sparkPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-|"))
    joins = [i for i, line in enumerate(plan) if "BroadcastHashJoin" in line]
    assert len(joins) == 1 and "BuildRight" in plan[joins[0]]
    sides = [i for i in range(joins[0] + 1, len(plan)) if depth(plan[i]) == depth(plan[joins[0] + 1])]
    assert len(sides) == 2 and not any("Aggregate" in line for line in plan[sides[1] :])
