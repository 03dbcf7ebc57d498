import math

import pytest
from pyspark.sql import functions as F

from riskweave.functions import fixed
from riskweave.functions import scalars as sc
from riskweave.operators import aggregates, impute, profile, silver

HOME = (
    "SK_ID_CURR int, TARGET int, DAYS_BIRTH int, DAYS_EMPLOYED int, AMT_CREDIT double, AMT_ANNUITY double, "
    "AMT_INCOME_TOTAL double, AMT_GOODS_PRICE double, EXT_SOURCE_1 double, EXT_SOURCE_2 double, "
    "EXT_SOURCE_3 double, CODE_GENDER string, NAME_EDUCATION_TYPE string, NAME_FAMILY_STATUS string, CNT_CHILDREN int"
)
BATCH = "row_key string, Age int, Sex string, Job int, Housing string, Credit_amount int, Duration int, Purpose string"
NAN, INF = float("nan"), float("inf")


def home(spark):
    return silver.silver_home(
        spark.createDataFrame(
            [
                (1, 0, -14610, -3652, 1000.0, 50.0, 500.0, 800.0, 0.1, None, 0.3, "M", "e", "f", 2),
                (2, 1, -7305, 365243, 1000.0, 0.0, 0.0, 0.0, None, None, None, "F", "e", "f", 0),
                (3, None, 0, -10, None, None, None, None, NAN, None, None, "XNA", "e", "f", 0),
            ],
            HOME,
        )
    )


def batch(spark):
    rows = [("a", 40, "male", 3, "own", 1200, 12, "car"), ("b", 20, "female", 7, "rent", 100, 0, "tv"), ("c", None, None, None, None, None, None, None)]
    return silver.silver_batch(spark.createDataFrame(rows, BATCH), sc.stable_id(F.col("row_key")))


def test_home_projection(spark):
    first, second, third = home(spark).orderBy("applicant_id").collect()
    assert (first["age"], first["employment_years"], first["duration_months"]) == (40.0, 10.0, 20.0)
    assert (first["debt_to_income_ratio"], first["financial_stress_index"]) == (2.0, 0.1)
    assert first["credit_to_goods_ratio"] == 1.25 and first["employment_to_age_ratio"] == 0.25
    assert (first["gender"], second["gender"], third["gender"]) == ("Male", "Female", "Other")
    empty = ["duration_months", "employment_years", "debt_to_income_ratio", "financial_stress_index", "credit_to_goods_ratio", "employment_to_age_ratio"]
    assert all(second[c] is None for c in empty)
    assert third["employment_to_age_ratio"] is None


def test_batch_projection(spark):
    rows = {r["education_level"]: r for r in batch(spark).collect()}
    assert rows["own"]["employment_years"] == 10.0 and rows["rent"]["employment_years"] == 3.0
    assert rows[None]["employment_years"] == 3.0 and rows[None]["gender"] == "Other"
    assert rows["own"]["income_proxy"] == 100.0 and rows["own"]["financial_stress_index"] == 1.0
    assert rows["rent"]["income_proxy"] is None and rows["rent"]["financial_stress_index"] is None
    kept = silver.drop_incomplete(batch(spark), [*fixed.PROXY_FEATURES, "target"])
    assert kept.count() == 1


def test_both_sources_share_one_schema(spark):
    a, b = home(spark), batch(spark)
    assert a.schema.simpleString() == b.schema.simpleString() and len(a.columns) == 19
    profile.require_aligned(a, b, fixed.PROXY_FEATURES)
    with pytest.raises(ValueError):
        profile.require_aligned(a, b.drop("age"))
    diff = profile.schema_diff(a, b.drop("age"), ["age"]).where(~F.col("in_right")).collect()
    assert [r["column_name"] for r in diff] == ["age"] and diff[0]["required"]


@pytest.mark.parametrize("exact", [True, False])
def test_median_imputation_leaves_nan_out(spark, exact):
    df = spark.createDataFrame([(1.0, None), (3.0, None), (NAN, None), (None, None), (9.0, None)], "a double, b double")
    medians = impute.fit_medians(df, ["a", "b"], exact=exact)
    assert medians == {"a": 3.0}
    assert sorted(r["a"] for r in impute.impute(df, medians).collect()) == [1.0, 3.0, 3.0, 3.0, 9.0]


def test_non_finite_rows_are_dropped(spark):
    df = spark.createDataFrame([(1.0,), (INF,), (-INF,), (NAN,), (None,)], "a double")
    assert [r["a"] for r in silver.drop_non_finite(df, ["a"]).collect()] == [1.0]


def test_null_profile_counts_nan_only_where_possible(spark):
    df = spark.createDataFrame([(NAN, "x", 1), (None, None, 2), (1.0, "z", None)], "a double, b string, c int")
    assert [(r[0], r[1]) for r in profile.null_profile(df).collect()] == [("a", 2), ("b", 1), ("c", 1)]
    assert {r[0]: r[1] for r in profile.null_profile(df, count_nan=False).collect()}["a"] == 1


def test_zero_counts_and_single_class(spark):
    df = spark.createDataFrame([("HIGH", 0), ("HIGH", 0)], "band string, y int")
    shares = {r["category"]: (r["row_count"], r["percent"]) for r in aggregates.category_share(df, "band", fixed.IMPACT_BANDS).collect()}
    assert shares == {"LOW": (0, 0.0), "MEDIUM": (0, 0.0), "HIGH": (2, 100.0), "VERY HIGH": (0, 0.0)}
    assert aggregates.class_ratio(df, "y").first()["imbalance_ratio"] is None
    assert aggregates.category_share(df.where("false"), "band", ["LOW"]).first()["percent"] == 0.0


@pytest.mark.parametrize("value", [0.4715, 0.25, 0.1225, 0.12345, 0.0, 1.0, 0.9996, 0.99949, 0.0005, 0.00049, 0.5544, 0.0725])
def test_percent_text_equals_python(spark, value):
    row = spark.createDataFrame([(value,)], "p double").select(sc.percent_text(F.col("p")), sc.fixed_text(F.col("p"), 2)).first()
    assert row[0] == f"{value:.1%}" and row[1] == f"{value:.2f}"


def test_clip_and_draw(spark):
    df = spark.createDataFrame([(-1.0,), (0.5,), (2.0,), (None,)], "a double")
    assert [r[0] for r in df.select(sc.clip(F.col("a"), 0.0, 1.0)).collect()] == [0.0, 0.5, 1.0, None]
    draws = [r[0] for r in spark.range(2000).select(sc.uniform_draw(F.col("id"), F.lit(1))).collect()]
    assert all(0 <= d < 1 for d in draws) and math.isclose(sum(draws) / 2000, 0.5, abs_tol=0.03)
