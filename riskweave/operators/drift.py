"""Population stability index between a baseline and an incoming table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.functions import fixed
from riskweave.functions import scalars as sc
from riskweave.operators.ranking import exact_quantiles
from riskweave.operators.silver import drop_incomplete
from riskweave.sources.local import small_frame


def _complete(df: DataFrame, features: list[str]) -> DataFrame:
    """Rows with a value in every monitored feature, and those columns only."""
    return drop_incomplete(df.select([F.col(f).cast("double") for f in features]), features)


def fit_edges(baseline: DataFrame, features: list[str], bins: int = fixed.PSI_BINS) -> dict[str, list[float]]:
    """Inner bin edges per feature: distinct baseline quantiles without the two outer ones.

    The outer bins are open, so only inner edges decide where a value falls. Keep the result to
    score later batches against frozen edges.
    """
    long = _complete(baseline, features).unpivot([], features, "feature_name", "value")
    cuts = exact_quantiles(long, ["feature_name"], "value", [i / bins for i in range(bins + 1)])
    return {f: sorted(set(cuts.get((f,), [])))[1:-1] for f in features}


def bin_index(feature: str, inner_edges: list[float]) -> Column:
    """Right-closed bin of a value: the number of inner edges strictly below it."""
    under = [f"CAST(CAST('{edge!r}' AS DOUBLE) < `{feature}` AS INT)" for edge in inner_edges]
    return F.expr(" + ".join(["0", *under]))


def drift_histogram(baseline: DataFrame, incoming: DataFrame, edges: Mapping[str, list[float]]) -> DataFrame:
    """Rows and shares per (feature, bin) on both sides, empty bins included.

    Each row finds the bin of all its features in one projection; what is shuffled is at most
    features x bins counters per task and side.
    """
    features = list(edges)

    def placed(df: DataFrame, expected: int, actual: int) -> DataFrame:
        bins = _complete(df, features).select(*[bin_index(f, edges[f]).alias(f) for f in features])
        return bins.unpivot([], features, "feature_name", "bin").select(
            "feature_name", "bin", F.lit(expected).alias("e"), F.lit(actual).alias("a")
        )

    slots = [(f, b, 0, 0) for f in features for b in range(len(edges[f]) + 1)]
    grid = small_frame(baseline.sparkSession, slots, "feature_name string, bin int, e int, a int")
    counts = (
        placed(baseline, 1, 0).unionByName(placed(incoming, 0, 1)).unionByName(grid)
        .groupBy("feature_name", "bin")
        .agg(F.sum("e").alias("expected_rows"), F.sum("a").alias("actual_rows"))
    )

    def share(rows: str) -> Column:
        total = F.sum(rows).over(Window.partitionBy("feature_name"))
        return F.coalesce(F.try_divide(F.col(rows).cast("double"), total.cast("double")), F.lit(0.0))

    return counts.withColumns({"expected_share": share("expected_rows"), "actual_share": share("actual_rows")})


def drift_status(psi: Column) -> Column:
    cuts = [(fixed.PSI_MONITOR, fixed.DRIFT_STABLE), (fixed.PSI_RETRAIN, fixed.DRIFT_MONITOR)]
    return sc.below(psi, cuts, fixed.DRIFT_RETRAIN)


def psi_from_histogram(hist: DataFrame, epsilon: float = fixed.PSI_EPSILON, keys: Sequence[str] = ("feature_name",)) -> DataFrame:
    """Index and status per feature, or per ``keys``. An empty share becomes epsilon, without renormalising."""

    def floored(name: str) -> Column:
        return F.when(F.col(name) == 0, F.lit(epsilon)).otherwise(F.col(name))

    e, a = floored("expected_share"), floored("actual_share")
    scores = hist.groupBy(*keys).agg(F.round(F.sum((a - e) * F.log(a / e)), 4).alias("psi_score"))
    return scores.withColumn("drift_status", drift_status(F.col("psi_score")))


def drift_psi(
    baseline: DataFrame,
    incoming: DataFrame,
    features: list[str],
    bins: int = fixed.PSI_BINS,
    epsilon: float = fixed.PSI_EPSILON,
) -> DataFrame:
    edges = fit_edges(baseline, features, bins)
    return psi_from_histogram(drift_histogram(baseline, incoming, edges), epsilon)


def drift_trigger(report: DataFrame) -> DataFrame:
    """Average score, worst feature and whether any feature calls for retraining."""
    return report.agg(
        F.round(F.avg("psi_score"), 4).alias("avg_psi"),
        F.max_by("feature_name", F.struct(F.col("psi_score"), F.col("feature_name"))).alias("max_feature"),
        F.bool_or(F.col("drift_status") == fixed.DRIFT_RETRAIN).alias("retraining_trigger"),
    )
