"""Alignment of two loan sources on one feature schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions import fixed
from riskweave.functions import scalars as sc


def silver_home(raw: DataFrame, source: str = "home_credit") -> DataFrame:
    """Project the wide loan table on the 19 shared columns."""
    c = F.col
    credit, income, annuity = c("AMT_CREDIT"), c("AMT_INCOME_TOTAL"), c("AMT_ANNUITY")
    goods, born, employed = c("AMT_GOODS_PRICE"), F.abs("DAYS_BIRTH"), F.abs("DAYS_EMPLOYED")
    has_job = c("DAYS_EMPLOYED") != fixed.EMPLOYMENT_SENTINEL
    return raw.select(
        c("SK_ID_CURR").cast("long").alias("applicant_id"),
        sc.years(c("DAYS_BIRTH")).alias("age"),
        credit.cast("double").alias("credit_amount"),
        sc.ratio(credit, annuity, 1).alias("duration_months"),
        F.when(has_job, sc.years(c("DAYS_EMPLOYED"))).alias("employment_years"),
        income.cast("double").alias("income_proxy"),
        sc.ratio(credit, income, 4).alias("debt_to_income_ratio"),
        sc.ratio(annuity, income, 4).alias("financial_stress_index"),
        F.when(goods > 0, sc.ratio(credit, goods, 4)).alias("credit_to_goods_ratio"),
        F.when(has_job & (born > 0), sc.ratio(employed, born, 4)).alias("employment_to_age_ratio"),
        *[c(s.upper()).cast("double").alias(s) for s in fixed.EXTERNAL_SCORES],
        sc.recode(c("CODE_GENDER"), {"M": "Male", "F": "Female"}, "Other").alias("gender"),
        c("NAME_EDUCATION_TYPE").alias("education_level"),
        c("NAME_FAMILY_STATUS").alias("family_status"),
        c("CNT_CHILDREN").cast("int").alias("num_children"),
        c("TARGET").cast("int").alias("target"),
        F.lit(source).alias("source_dataset"),
    )


def silver_batch(
    raw: DataFrame, applicant_id: Column, source: str = "german_credit"
) -> DataFrame:
    """Project the narrow incoming batch on the same 19 columns, with proxies for absent ones.

    ``applicant_id`` is an expression over the raw row; derive it from a natural key so that the
    id survives recomputation and repartitioning.
    """
    c = F.col
    credit, duration = c("Credit_amount").cast("double"), c("Duration").cast("double")
    age = c("Age").cast("double")
    job_years = sc.recode(c("Job"), fixed.JOB_YEARS, fixed.JOB_YEARS_DEFAULT)
    yearly_income = F.try_divide(credit, duration) * 12
    return raw.select(
        applicant_id.alias("applicant_id"),
        age.alias("age"),
        credit.alias("credit_amount"),
        duration.alias("duration_months"),
        job_years.alias("employment_years"),
        sc.ratio(credit, duration, 2).alias("income_proxy"),
        sc.ratio(duration, F.lit(12.0), 4).alias("debt_to_income_ratio"),
        sc.ratio(credit, yearly_income, 4).alias("financial_stress_index"),
        F.lit(1.0).alias("credit_to_goods_ratio"),
        sc.ratio(job_years, age, 4).alias("employment_to_age_ratio"),
        *[F.lit(None).cast("double").alias(s) for s in fixed.EXTERNAL_SCORES],
        sc.recode(c("Sex"), {"male": "Male", "female": "Female"}, "Other").alias("gender"),
        c("Housing").alias("education_level"),
        c("Purpose").alias("family_status"),
        F.lit(0).alias("num_children"),
        F.lit(0).alias("target"),
        F.lit(source).alias("source_dataset"),
    )


def keep_labelled_known_gender(df: DataFrame) -> DataFrame:
    return df.where(F.col("target").isNotNull() & (F.col("gender") != "Other"))


def drop_incomplete(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop rows with a NULL or NaN in any of the columns."""
    return df.dropna(subset=columns)


def drop_non_finite(df: DataFrame, columns: list[str]) -> DataFrame:
    """Treat both infinities as missing, then drop incomplete rows."""
    infinite = {c: F.abs(F.col(c)) == F.lit(float("inf")) for c in columns}
    cleaned = df.withColumns({c: F.when(~hit, F.col(c)) for c, hit in infinite.items()})
    return drop_incomplete(cleaned, columns)


def union_sources(home: DataFrame, batch: DataFrame) -> DataFrame:
    return home.unionByName(batch)
