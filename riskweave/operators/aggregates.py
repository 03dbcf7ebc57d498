"""Grouped counts, rates and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions import fixed
from riskweave.functions import scalars as sc
from riskweave.operators.ranking import exact_quantiles


def crosstab(df: DataFrame, first: str, second: str) -> DataFrame:
    return df.groupBy(first, second).agg(F.count("*").alias("row_count")).orderBy(first, second)


def approval_rate(df: DataFrame, group: str, target: str = "target") -> DataFrame:
    """Share of rows with target 0, in percent, per group."""
    approved = F.count_if(F.col(target) == 0)
    return df.groupBy(group).agg(
        F.count("*").alias("total"),
        approved.alias("approved"),
        F.round(approved / F.count("*") * 100, 2).alias("approval_rate_pct"),
    )


def fairness_gap(df: DataFrame, group: str, target: str = "target") -> DataFrame:
    """Approval rate of each group against the best group, as ratio and difference."""
    rates = approval_rate(df, group, target)
    best = rates.agg(F.max("approval_rate_pct").alias("b")).scalar()
    rate = F.col("approval_rate_pct")
    gaps = rates.withColumn("_best", best).withColumns(
        {
            "impact_ratio": F.round(F.try_divide(rate, F.col("_best")), 4),
            "rate_gap_pct": F.round(F.col("_best") - rate, 2),
        }
    )
    return gaps.drop("_best")


def class_ratio(df: DataFrame, label: str) -> DataFrame:
    """Counts of both classes and negatives per positive."""
    neg, pos = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    return df.agg(
        neg.alias("negatives"),
        pos.alias("positives"),
        F.round(F.try_divide(neg.cast("double"), pos.cast("double")), 2).alias("imbalance_ratio"),
    )


def column_stats(df: DataFrame, columns: list[str], name: str, stats: dict) -> DataFrame:
    """One row per column with its statistics; rows are not multiplied before they are aggregated."""
    wide = df.agg(*[F.struct(*[f(F.col(c)).alias(s) for s, f in stats.items()]).alias(c) for c in columns])
    rows = [F.struct(F.lit(c).alias(name), *[F.col(c).getField(s).alias(s) for s in stats]) for c in columns]
    return wide.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def distribution(df: DataFrame, columns: list[str], exact_median: bool = False) -> DataFrame:
    """Mean, sample deviation, median, min and max per column: one wide aggregate, turned to rows."""
    numbers = df.select([F.col(c).cast("double") for c in columns])
    stats = column_stats(
        numbers,
        columns,
        "feature",
        {"mean": F.mean, "std": F.stddev, "min": F.min, "max": F.max}
        | ({} if exact_median else {"median": lambda c: F.percentile_approx(c, 0.5)}),
    )
    if not exact_median:
        return stats
    long = numbers.unpivot([], columns, "feature", "value")
    mids = exact_quantiles(long, ["feature"], "value", [0.5], method="discrete")
    return stats.withColumn("median", sc.recode(F.col("feature"), {f: v[0] for (f,), v in mids.items()}, None))


def compare_distributions(
    left: DataFrame, right: DataFrame, columns: list[str], exact_median: bool = False, digits: int = 4
) -> DataFrame:
    """Side-by-side statistics of two tables with the absolute change of the mean."""

    def named(df: DataFrame, side: str) -> DataFrame:
        s = distribution(df, columns, exact_median)
        return s.select(
            "feature",
            *[
                F.round(m, digits).alias(f"{side}_{m}")
                for m in ("mean", "std", "median", "min", "max")
            ],
            F.col("mean").alias(f"_{side}"),
        )

    both = named(left, "left").join(named(right, "right"), "feature")
    gap = F.round(F.abs(F.col("_left") - F.col("_right")), digits)
    return both.withColumn("mean_change", gap).drop("_left", "_right")


def category_share(df: DataFrame, column: str, categories: list[str]) -> DataFrame:
    """Count and whole percent for a fixed list of categories; absent ones show zero.

    One aggregate with a counter per category, so no join is needed to keep the zeros.
    """
    counters = [F.count_if(F.col(column) == c).alias(c) for c in categories]
    wide = df.agg(F.count("*").alias("total"), *counters)
    long = wide.unpivot(["total"], categories, "category", "row_count")
    share = F.try_divide(F.col("row_count").cast("double"), F.col("total").cast("double"))
    return long.select(
        "category",
        "row_count",
        "total",
        F.coalesce(F.round(share * 100, 0), F.lit(0.0)).alias("percent"),
    )


def alert_summary(df: DataFrame, grounding: str, risk: str) -> DataFrame:
    """Average grounding and hallucination risk with the alert level of the average."""
    level = sc.above(
        F.col("avg_hallucination_risk"),
        [(fixed.ALERT_HIGH, "ALERT"), (fixed.ALERT_MODERATE, "NOTICE")],
        "HEALTHY",
    )
    averages = df.agg(F.avg(grounding).alias("avg_grounding"), F.avg(risk).alias("avg_hallucination_risk"))
    return averages.select(
        F.round("avg_grounding", 4).alias("avg_grounding"),
        F.round("avg_hallucination_risk", 4).alias("avg_hallucination_risk"),
        level.alias("alert_level"),
    )
