"""Audit table, its dashboard aggregates and the serving expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions import fixed
from riskweave.functions import scalars as sc


def risk_class(probability: Column) -> Column:
    return sc.above(probability, [(0.5, fixed.RISK_HIGH), (0.3, fixed.RISK_MEDIUM)], fixed.RISK_LOW)


def _first(df: DataFrame, *columns: str) -> Column:
    """Values of the row with the smallest applicant id, as one scalar subquery."""
    values = F.struct(*columns)
    return df.agg(F.min_by(values, F.col("applicant_id")).alias("f")).scalar()


def assemble_audit(
    scores: DataFrame,
    explanations: DataFrame,
    costs: DataFrame,
    drift: DataFrame,
    comparisons: DataFrame,
    model_version: str,
    at: Column,
) -> DataFrame:
    """One row per scored applicant (``applicant_id``, ``model_prediction``).

    Explanations and costs join on the applicant id. An applicant without one takes the values
    of the first record, and fixed texts when the upstream table is empty. Drift and retraining
    facts are scalar subqueries over their small histories.
    """
    avg_psi = drift.agg(F.round(F.coalesce(F.avg("psi_score"), F.lit(0.0)), 4).alias("a")).scalar()
    action = comparisons.agg(
        F.coalesce(F.max_by("promotion_action", F.struct("timestamp", *(["run_id"] if "run_id" in comparisons.columns else []))), F.lit(fixed.NO_RETRAINING)).alias("a")
    ).scalar()
    own_text = explanations.select("applicant_id", "explanation_summary")
    own_cost = costs.select("applicant_id", "impact_band", "review_flag")
    joined = (
        scores.join(own_text, "applicant_id", "left")
        .join(own_cost, "applicant_id", "left")
        .withColumn("_text", _first(own_text, "explanation_summary"))
        .withColumn("_cost", _first(own_cost, "impact_band", "review_flag"))
    )
    summary = F.coalesce(
        F.col("explanation_summary"),
        F.concat(F.col("_text.explanation_summary"), F.lit(fixed.TEMPLATE_SUFFIX)),
        F.lit(fixed.NO_EXPLANATION),
    )
    return joined.select(
        "applicant_id",
        F.round("model_prediction", 4).alias("model_prediction"),
        risk_class(F.col("model_prediction")).alias("risk_classification"),
        summary.alias("shap_summary"),
        avg_psi.alias("drift_score_avg_psi"),
        action.alias("retraining_status"),
        F.coalesce("review_flag", "_cost.review_flag", F.lit(fixed.NOT_EVALUATED)).alias("explanation_label"),
        F.coalesce("impact_band", "_cost.impact_band", F.lit(fixed.NOT_SCORED)).alias("hallucination_cost_band"),
        F.lit(model_version).alias("model_version"),
        at.alias("timestamp"),
    )


def latest_audit(audit: DataFrame, n: int = 50) -> DataFrame:
    """Newest n rows; planned as a top-k per partition, not a full sort."""
    return audit.orderBy(F.desc("timestamp"), F.asc("applicant_id")).limit(n)


def dashboard_kpis(audit: DataFrame) -> DataFrame:
    """Totals of the audit table in one aggregate."""
    blocked = F.count_if(F.contains(F.col("explanation_label"), F.lit("BLOCK")))
    exposed = F.count_if(F.col("hallucination_cost_band") == "VERY HIGH")
    return audit.agg(
        F.count("*").alias("total_audited"),
        F.round(F.avg("drift_score_avg_psi"), 4).alias("avg_drift_psi"),
        F.round(F.try_divide(blocked * 100.0, F.count("*")), 1).alias("hallucination_rate_pct"),
        blocked.alias("blocks_prevented"),
        exposed.alias("severe_exposures"),
    )


def badge(label: Column) -> Column:
    return (
        F.when(F.contains(label, F.lit("BLOCK")), "BLOCKED")
        .when(F.contains(label, F.lit("MANUAL")), "REVIEW")
        .otherwise("APPROVED")
    )


def context_sentence() -> Column:
    """Sentence about one audit row."""
    return F.concat(
        F.lit("Applicant #"),
        F.col("applicant_id").cast("string"),
        F.lit(" has Risk: "),
        sc.percent_text(F.col("model_prediction")),
        F.lit(". Class: "),
        F.col("risk_classification"),
        F.lit(". SHAP: "),
        F.col("shap_summary"),
        F.lit(". Label: "),
        F.col("explanation_label"),
        F.lit("."),
    )


def short_class(classification: Column) -> Column:
    return sc.prefix(classification, "—")


def scenario_risk(age: Column, income: Column, duration: Column) -> Column:
    """Point score of one scenario, clipped to [0.01, 0.99]."""
    base = F.when(age < 25, F.lit(0.35)).otherwise(F.lit(0.20))
    return sc.clip(base + F.try_divide(duration * 1000, income + 1) * 0.05, 0.01, 0.99)


def score_scenarios(df: DataFrame, age: str = "age", income: str = "income", duration: str = "duration") -> DataFrame:
    """Add risk, class, review label and summary to a table of scenarios."""
    risk = F.col("predicted_risk")
    years = sc.fixed_text(F.col(duration).cast("double") / 10, 2)

    def banded(high: str, medium: str, low: str) -> Column:
        return F.when(risk > 0.65, high).when(risk < 0.25, low).otherwise(medium)

    return df.withColumn("predicted_risk", scenario_risk(F.col(age), F.col(income), F.col(duration))).withColumns(
        {
            "classification": banded(fixed.SCENARIO_HIGH, fixed.SCENARIO_MEDIUM, fixed.SCENARIO_LOW),
            "hallucination_flag": banded(
                fixed.SCENARIO_HIGH_LABEL, fixed.SCENARIO_MEDIUM_LABEL, fixed.SCENARIO_LOW_LABEL
            ),
            "shap_summary": F.concat(
                F.lit("Risk primarily driven UP by loan_duration (+"), years, F.lit(") and driven DOWN by income_proxy")
            ),
        }
    )


def what_if(df: DataFrame, **sliders: tuple[int, int, int]) -> DataFrame:
    """One row per slider position (low, high, step) of each named column, for every input row.

    A map-only expansion: positions are generated beside each row, nothing is joined.
    """
    for name, (low, high, step) in sliders.items():
        df = df.withColumn(name, F.explode(F.sequence(F.lit(low), F.lit(high), F.lit(step))))
    return df


def whole_grid(cells: DataFrame, **sliders: tuple[int, int, int]) -> DataFrame:
    """Every position of all sliders together, with what ``cells`` (one row per occupied position) holds there, else NULL.

    The positions are as many as the sliders have, whatever the rows behind ``cells``; a plain join on all of them follows.
    """
    positions = what_if(cells.sparkSession.range(1), **sliders).drop("id")
    return positions.join(cells, list(sliders), "left")


def snap(value: Column, slider: tuple[int, int, int]) -> Column:
    """Nearest lower slider position, clamped to the slider's range."""
    low, high, step = slider
    inside = F.greatest(F.lit(low), F.least(F.lit(high), value))
    return (F.floor((inside - low) / step) * step + low).cast("int")
