"""Compliance claims, impact bands and the cost record of each explanation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions import fixed
from riskweave.functions import scalars as sc
from riskweave.functions import text as tx


def compliance_hits(text: Column, keywords: Sequence[str] = tuple(fixed.COMPLIANCE_KEYWORDS), whole_word: bool = False) -> Column:
    return tx.keyword_hits(text, keywords, whole_word)


def joined_hits(hits: Column) -> Column:
    return F.when(F.size(hits) > 0, F.array_join(hits, ", ")).otherwise(F.lit("None"))


def impact_band(grounding: Column, hits: Column) -> Column:
    weak = F.when(F.size(hits) > 0, F.lit("VERY HIGH")).otherwise(F.lit("HIGH"))
    return (
        F.when(grounding < fixed.GROUNDING_WEAK, weak)
        .when(grounding < fixed.GROUNDING_FAIR, F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )


def review_flag(band: Column) -> Column:
    strict = {b: flag for b, flag in fixed.REVIEW_FLAGS.items() if b != "LOW"}
    return sc.recode(band, strict, fixed.REVIEW_FLAGS["LOW"])


def exposure(band: Column) -> Column:
    return sc.recode(band, fixed.EXPOSURES, "Unknown")


def cost_records(
    scored: DataFrame,
    grounding: str,
    text: str,
    risk: str,
    at: Column,
    keywords: Sequence[str] = tuple(fixed.COMPLIANCE_KEYWORDS),
) -> DataFrame:
    """One record per applicant; banding uses the unrounded grounding score."""
    banded = scored.withColumn("_hits", compliance_hits(F.col(text), keywords))
    banded = banded.withColumn("_band", impact_band(F.col(grounding), F.col("_hits")))
    return banded.select(
        "applicant_id",
        F.col(risk).alias("ml_risk_score"),
        F.col(text).alias("explanation"),
        F.round(grounding, 4).alias("grounding_score"),
        F.round(1 - F.col(grounding), 4).alias("hallucination_risk"),
        joined_hits(F.col("_hits")).alias("compliance_claims_detected"),
        F.col("_band").alias("impact_band"),
        review_flag(F.col("_band")).alias("review_flag"),
        exposure(F.col("_band")).alias("estimated_financial_exposure"),
        at.alias("audit_timestamp"),
    )


def score_metrics(df: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
    """Add every registered per-row metric in one projection."""
    return df.withColumns(dict(metrics))


def aggregate_metrics(df: DataFrame, aggregates: Mapping[str, Column]) -> DataFrame:
    """One row with every registered aggregate, from one pass."""
    return df.agg(*[c.alias(name) for name, c in aggregates.items()])
