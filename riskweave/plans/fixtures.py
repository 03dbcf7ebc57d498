"""Loan-shaped views over the given tables, and the parameters the registered queries use."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions import fixed
from riskweave.functions import scalars as sc
from riskweave.operators import attribution, grounding, impute, silver
from riskweave.sources import tables
from riskweave.sources.shared import exists, fresh_path

RUN_AT = datetime(2026, 1, 1)
SPLIT_AT = datetime(1998, 1, 1)
EVENTS_SPLIT_AT = datetime(2024, 1, 16)
MODEL_VERSION = "scorecard_a/1"

# Scorecards with fixed coefficients on the five monitored features.
SCORECARDS = {
    "scorecard_a": (-0.5, {"age": -0.02, "credit_amount": 0.000004, "duration_months": 0.005,
                           "employment_years": -0.03, "income_proxy": -0.00005}),
    "scorecard_b": (0.25, {"age": -0.01, "credit_amount": -0.000002, "duration_months": 0.002,
                           "employment_years": 0.05, "income_proxy": -0.0002}),
    "scorecard_c": (-1.0, {"age": 0.015, "credit_amount": 0.000001, "duration_months": -0.01,
                           "employment_years": 0.02, "income_proxy": 0.0001}),
}

# Keywords that occur in the given documents.
DOCUMENT_KEYWORDS = ["license", "copyright", "password", "secret", "token", "email", "phone",
                     "warranty", "permission", "act"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def home_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baseline loans: one per order."""
    c = F.col
    lines = table(spark, sf_dir, "lineitem").groupBy(c("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_extendedprice").alias("top_price"), F.min("l_extendedprice").alias("low_price")
    )
    customers = table(spark, sf_dir, "customer").select(
        c("c_custkey").alias("o_custkey"), "c_acctbal", "c_mktsegment"
    )
    key, cust = c("o_orderkey"), c("o_custkey")

    def partial(absent: int, modulus: int):
        return F.when(key % absent != 0, (key % modulus) / F.lit(float(modulus)))

    return (
        table(spark, sf_dir, "orders")
        .join(customers, "o_custkey")
        .join(lines, "o_orderkey", "left")
        .select(
            key.alias("SK_ID_CURR"),
            F.when(c("o_orderpriority") == "1-URGENT", 1).otherwise(0).alias("TARGET"),
            (-(cust * 37 % 15000 + 6570)).alias("DAYS_BIRTH"),
            F.when(key % 6 == 0, fixed.EMPLOYMENT_SENTINEL).otherwise(-(cust * 13 % 6000)).alias("DAYS_EMPLOYED"),
            c("o_totalprice").alias("AMT_CREDIT"),
            F.when(key % 50 == 0, 0.0).otherwise(c("top_price") / 12).alias("AMT_ANNUITY"),
            c("c_acctbal").alias("AMT_INCOME_TOTAL"),
            (c("low_price") * 4).alias("AMT_GOODS_PRICE"),
            partial(2, 1000).alias("EXT_SOURCE_1"),
            partial(9, 777).alias("EXT_SOURCE_2"),
            partial(5, 333).alias("EXT_SOURCE_3"),
            sc.recode(c("o_orderstatus"), {"O": "M", "F": "F"}, "XNA").alias("CODE_GENDER"),
            c("c_mktsegment").alias("NAME_EDUCATION_TYPE"),
            c("o_orderpriority").alias("NAME_FAMILY_STATUS"),
            (key % 4).cast("int").alias("CNT_CHILDREN"),
        )
    )


def batch_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming batch: one loan per order line shipped from the split date on."""
    c = F.col
    names = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    parts = [*(c(n).cast("string") for n in names), c("l_quantity").cast("int").cast("string")]
    return (
        table(spark, sf_dir, "lineitem")
        .where(c("l_shipdate") >= F.lit(SPLIT_AT).cast("timestamp_ntz"))
        .select(
            F.md5(F.concat_ws("|", *parts)).alias("row_key"),
            (c("l_quantity").cast("int") + 18).alias("Age"),
            sc.recode(c("l_returnflag"), {"A": "male", "R": "female"}, "unknown").alias("Sex"),
            (c("l_linenumber") % 5).alias("Job"),
            c("l_linestatus").alias("Housing"),
            (c("l_extendedprice") / 10).alias("Credit_amount"),
            (c("l_linenumber") * 6).alias("Duration"),
            c("l_returnflag").alias("Purpose"),
        )
    )


def projected_home(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_home(home_like(spark, sf_dir))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once, read many times: later passes scan columns instead of repeating joins."""
    path = fresh_path(df.sparkSession, name)
    tables.save_table(df, path)
    return tables.read_table(df.sparkSession, path)


_HELD: dict[tuple[str, str, str], str] = {}


def once_path(spark: SparkSession, sf_dir: str, name: str, fill: Callable[[str], object]) -> str:
    """Folder that ``fill`` wrote for a data folder, filled by the first query of a session that asks for it."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _HELD or not exists(spark, _HELD[key]):
        path = fresh_path(spark, name)
        fill(path)
        _HELD[key] = path
    return _HELD[key]


def once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table that ``build`` makes of a data folder, stored by the first query of a session that asks for it."""
    return tables.read_table(spark, once_path(spark, sf_dir, name, lambda path: tables.save_table(build(), path)))


def silver_home(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projected, imputed with the exact medians and filtered."""
    projected = stored(projected_home(spark, sf_dir), "projected_home")
    medians = impute.fit_medians(projected, fixed.MEDIAN_FEATURES, exact=True)
    return silver.keep_labelled_known_gender(impute.impute(projected, medians))


def silver_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = silver.silver_batch(batch_like(spark, sf_dir), sc.stable_id(F.col("row_key")))
    filled = impute.impute_constant(aligned, {s: 0.5 for s in fixed.EXTERNAL_SCORES})
    return silver.drop_incomplete(filled, [*fixed.PROXY_FEATURES, "target"])


def scored_home(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imputed loans with one score column per scorecard, stored as several passes read them."""
    scores = {name: attribution.logistic_score(w, b) for name, (b, w) in SCORECARDS.items()}
    return stored(silver_home(spark, sf_dir).withColumns(scores), "scored_home")


def scored_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incoming batch with one score column per scorecard, stored."""
    scores = {name: attribution.logistic_score(w, b) for name, (b, w) in SCORECARDS.items()}
    return stored(silver_batch(spark, sf_dir).withColumns(scores), "scored_batch")


def policy_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "policy_index")
    return grounding.write_index(table(spark, sf_dir, "benchmark"), "item_id", "text", path)


def grounded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as explanations, with their support in the policy corpus."""
    docs = documents(spark, sf_dir).select(F.col("doc_id").alias("applicant_id"), "text")
    scores = grounding.grounding_scores(docs, "applicant_id", "text", policy_index(spark, sf_dir))
    return docs.join(scores, "applicant_id")
