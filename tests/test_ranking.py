import numpy as np
import pandas as pd
import pytest

from riskweave.operators.ranking import exact_quantiles, running_before, with_ordinal

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def samples():
    rng = np.random.default_rng(3)
    return {
        "uniform": rng.random(3000),
        "heavy_tail": np.exp(rng.normal(0, 6, 3000)) * rng.choice([-1, 1], 3000),
        "hot_value": np.where(rng.random(3000) < 0.4, 7.5, rng.normal(0, 1, 3000)),
        "constant": np.full(50, 2.0),
        "pair": np.array([1.0, 4.0]),
        "single": np.array([-3.25]),
        "with_infinity": np.array([-np.inf, 1.0, 2.0, 3.0, np.inf]),
        "narrow_clump": np.concatenate([1 + rng.random(2500) * 1e-9, [-1e6, 1e6]]),
        "big_ids": rng.integers(0, 2**52, 2000).astype(float),
    }


def frame(spark, data):
    rows = pd.concat([pd.DataFrame({"k": k, "v": v}) for k, v in data.items()])
    return spark.createDataFrame(rows).repartition(5)


@pytest.mark.parametrize("bucket_rows", [1_000_000, 5])
def test_linear_quantiles_equal_numpy(spark, bucket_rows):
    data = samples()
    del data["with_infinity"]
    found = exact_quantiles(frame(spark, data), ["k"], "v", PROBS, bucket_rows=bucket_rows)
    for name, values in data.items():
        np.testing.assert_allclose(found[(name,)], np.quantile(values, PROBS), rtol=1e-12)


@pytest.mark.parametrize("bucket_rows", [1_000_000, 5])
def test_discrete_quantiles_are_elements(spark, bucket_rows):
    data = samples()
    found = exact_quantiles(frame(spark, data), ["k"], "v", PROBS, "discrete", bucket_rows)
    for name, values in data.items():
        ordered = np.sort(values)
        expected = [ordered[max(int(np.ceil(p * len(ordered))) - 1, 0)] for p in PROBS]
        assert found[(name,)] == expected


def test_missing_values_and_empty_input(spark):
    rows = spark.createDataFrame(
        [("a", None), ("a", float("nan")), ("a", 5.0), (None, 1.0)], "k string, v double"
    )
    assert exact_quantiles(rows, ["k"], "v", [0.5]) == {("a",): [5.0]}
    assert exact_quantiles(rows.where("false"), ["k"], "v", [0.5]) == {}


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        exact_quantiles(spark.range(2), [], "id", [0.5], "nearest")


@pytest.mark.parametrize("rows_per_part", [250_000, 3])
def test_running_before_equals_cumulative_sum(spark, rows_per_part):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 400), "v": np.round(rng.normal(0, 50, 400), 1)})
    pdf = pdf.drop_duplicates().assign(n=lambda d: rng.integers(1, 9, len(d)))
    holes = pd.DataFrame({"g": ["a", "b", None], "v": [None, float("nan"), 1.5], "n": [5, 6, 7]})
    df = spark.createDataFrame(pdf).union(spark.createDataFrame(holes)).repartition(6)
    got = running_before(df, ["g"], "v", ["n"], rows_per_part).where("g is not null")
    expected = pdf.sort_values(["g", "v"]).assign(n_before=lambda d: d.groupby("g")["n"].cumsum() - d["n"])
    got = got.toPandas().sort_values(["g", "v"])
    assert got["n_before"].tolist() == expected["n_before"].tolist()


@pytest.mark.parametrize("rows_per_part", [250_000, 2])
def test_ordinal_counts_from_zero(spark, rows_per_part):
    ids = [5, -3, 2**59, 2**59 + 1, 0]
    df = with_ordinal(spark.createDataFrame([(i,) for i in [*ids, None]], "id long"), "id", "n", rows_per_part)
    assert {r["id"]: r["n"] for r in df.collect()} == {i: n for n, i in enumerate(sorted(ids))}


def test_ordinal_needs_unique_numbers(spark):
    with pytest.raises(ValueError, match="not unique"):
        with_ordinal(spark.createDataFrame([(1,), (1,)], "id long"), "id", "n")


def test_quantiles_of_a_crowded_axis_are_cut_until_small(spark):
    values = [1.0 + i * 2**-40 for i in range(3000)] + [5.0] * 3000
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_quantiles(df, [], "v", [0.25, 0.75], "discrete", bucket_rows=2)[()] == [values[1499], 5.0]
