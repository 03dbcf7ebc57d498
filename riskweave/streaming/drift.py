"""Drift over time: rows that arrive as files are counted per event-time window against frozen bin edges.

The stream keeps counters, one per window, feature and bin, and upserts those that changed into a committed table; a batch
that is repeated after a failure writes the same numbers again. The index per window is a query over that table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskweave.functions import fixed
from riskweave.operators.drift import bin_index, psi_from_histogram
from riskweave.operators.silver import drop_incomplete
from riskweave.sources.committed import Committed
from riskweave.sources.local import small_frame

KEYS = ("window_start", "feature_name", "bin")


def window_counts(rows: DataFrame, time: str, edges: Mapping[str, Sequence[float]], window: str, lateness: str) -> DataFrame:
    """(window_start, feature_name, bin, actual_rows) of a stream, or of a table, of rows with a time.

    Rows without a time, or with a missing feature, have no part. In a stream, windows that end more than ``lateness``
    before the latest time seen by earlier batches are closed: rows that come for them later are dropped, and their
    counters leave the state. A table has no late rows.
    """
    features = list(edges)
    timed = rows.where(F.col(time).isNotNull()).select(F.col(time).cast("timestamp").alias("_at"), *[F.col(f).cast("double").alias(f) for f in features])
    placed = drop_incomplete(timed, features).select("_at", *[bin_index(f, list(edges[f])).alias(f) for f in features])
    long = placed.unpivot(["_at"], features, "feature_name", "bin").withWatermark("_at", lateness)
    counts = long.groupBy(F.window("_at", window).alias("_w"), "feature_name", "bin").agg(F.count(F.lit(1)).alias("actual_rows"))
    return counts.select(F.col("_w.start").alias("window_start"), "feature_name", "bin", "actual_rows")


def follow(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    time: str,
    edges: Mapping[str, Sequence[float]],
    window: str = "1 day",
    lateness: str = "2 days",
    files_per_batch: int = 100,
) -> int:
    """Count all files of ``source`` that were not counted yet, then stop; returns the number of batches.

    ``source`` holds parquet files; a file that is added later is counted by the next call. Edges, window and lateness
    belong to the checkpoint and must stay the same.
    """
    table = Committed(spark, target)
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    counts = window_counts(rows, time, edges, window, lateness)

    def keep(changed: DataFrame, batch: int) -> None:
        table.upsert(changed, KEYS, buckets=8)

    query = counts.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(p["numInputRows"] > 0 for p in query.recentProgress)


def window_drift(counts: DataFrame, expected: DataFrame, epsilon: float = fixed.PSI_EPSILON) -> DataFrame:
    """(window_start, feature_name, psi_score, drift_status) of (window_start, feature_name, bin, actual_rows).

    ``expected`` is (feature_name, bin, expected_share), a row for every bin of the frozen edges; a bin without rows in a
    window counts as empty there.
    """
    whole = counts.groupBy("window_start", "feature_name").agg(
        F.sum("actual_rows").alias("_total"), F.map_from_entries(F.collect_list(F.struct("bin", "actual_rows"))).alias("_bins")
    )  # a window and feature has as many rows as bins
    slots = whole.join(F.broadcast(expected), "feature_name")
    share = F.coalesce(F.try_element_at("_bins", F.col("bin")), F.lit(0)) / F.col("_total")
    return psi_from_histogram(slots.withColumn("actual_share", share), epsilon, ["window_start", "feature_name"])


def expected_shares(baseline: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """(feature_name, bin, expected_share) of a baseline in its frozen edges, empty bins included; one row per bin."""
    features = list(edges)
    bins = drop_incomplete(baseline.select(*[F.col(f).cast("double").alias(f) for f in features]), features)
    long = bins.select(*[bin_index(f, list(edges[f])).alias(f) for f in features]).unpivot([], features, "feature_name", "bin")
    counts = {(r["feature_name"], r["bin"]): r["n"] for r in long.groupBy("feature_name", "bin").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = {f: sum(n for (g, _), n in counts.items() if g == f) for f in features}
    rows = [(f, b, counts.get((f, b), 0) / total[f] if total[f] else 0.0) for f in features for b in range(len(edges[f]) + 1)]
    return small_frame(baseline.sparkSession, rows, "feature_name string, bin int, expected_share double")
