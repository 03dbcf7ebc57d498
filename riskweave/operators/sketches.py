"""Approximate quantiles from mergeable sketches, merged in levels and kept per batch, so that history needs no rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.sources.shared import fresh_path
from riskweave.sources.tables import append_history, read_or_empty

#: Most sketches that one task merges into one.
FAN_IN = 64
SIZE = 4096
#: Normalised rank error of a sketch of size k, at 99 % confidence: factor over k to the power.
_ERROR_FACTOR, _ERROR_POWER = 2.296, 0.9723
_LARGEST = 65_535
_HISTORY = "feature string, n long, sketch binary, run_id string, run_at string, run_part string"


def rank_error(size: int = SIZE) -> float:
    """Share of the rows by which a quantile may be off its rank; the same after any number of merges."""
    return _ERROR_FACTOR / size**_ERROR_POWER


def size_for(error: float) -> int:
    """Sketch size with at most this rank error, as far as sizes go."""
    return min(_LARGEST, max(8, -int(-((_ERROR_FACTOR / error) ** (1 / _ERROR_POWER)) // 1)))


def _merged(parts: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """One row per key from (keys..., part, sketch): ``FAN_IN`` neighbouring parts are merged at a time.

    The parts are stored once, as sketches are no larger than their size allows. The levels grow with the logarithm of the
    number of parts; what is shuffled are sketches, not rows.
    """
    path = fresh_path(parts.sparkSession, "sketches")
    parts.write.parquet(path)
    parts = parts.sparkSession.read.schema(parts.schema).parquet(path)
    last = parts.agg(F.max("part")).first()[0] or 0
    while last:
        parts = parts.withColumn("part", F.floor(F.col("part") / FAN_IN)).groupBy(*keys, "part").agg(F.kll_merge_agg_double("sketch", size).alias("sketch"))
        last //= FAN_IN
    return parts.drop("part")


def build(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """(keys..., feature, n, sketch) of double columns, NULL and NaN left out; a group without a value has no row.

    Each task sketches its own rows. No more than ``FAN_IN`` sketches of one key meet in a task, however many tasks there
    are, and a key that holds most rows costs no more than another.
    """
    values = [F.col(c).cast("double").alias(c) for c in columns]
    long = df.select(*keys, *values, F.spark_partition_id().alias("_task")).unpivot([*keys, "_task"], list(columns), "feature", "value")
    usable = long.where(F.col("value").isNotNull() & ~F.isnan("value"))
    group = [*keys, "feature"]
    parts = usable.groupBy(*group, F.floor(F.col("_task") / FAN_IN).alias("part")).agg(F.kll_sketch_agg_double("value", size).alias("sketch"))
    return _merged(parts, group, size).select(*group, F.kll_sketch_get_n_double("sketch").alias("n"), "sketch")


def merge(sketches: DataFrame, keys: Sequence[str] = (), size: int = SIZE) -> DataFrame:
    """(keys..., feature, n, sketch): the sketches of equal keys and feature as one."""
    group = [*keys, "feature"]
    number = F.row_number().over(Window.partitionBy(*group).orderBy("sketch")) - 1
    whole = _merged(sketches.select(*group, "sketch", number.alias("part")), group, size)
    return whole.select(*group, F.kll_sketch_get_n_double("sketch").alias("n"), "sketch")


def quantiles(sketches: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """One row per sketch and probability with ``value``: an element whose rank is off by at most ``rank_error``."""
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    values = F.kll_sketch_get_quantile_double("sketch", wanted)
    others = [c for c in sketches.columns if c != "sketch"]
    rows = sketches.select(*others, F.explode(F.arrays_zip(wanted.alias("probability"), values.alias("value"))).alias("_q"))
    return rows.select(*others, "_q.probability", "_q.value")


def share_at_most(value: float, sketch: str = "sketch") -> Column:
    """Approximate share of the sketched values that are not above ``value``."""
    return F.kll_sketch_get_rank_double(sketch, F.lit(float(value)))


def bin_shares(sketches: DataFrame, edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """(..., feature, bin, share) over right-closed bins between inner ``edges``: a histogram for drift without the rows."""
    empty = F.array().cast("array<double>")
    ranks = empty
    for f, e in edges.items():  # the function takes constants only
        own = F.kll_sketch_get_rank_double("sketch", F.array(*[F.lit(float(v)) for v in e])) if e else empty
        ranks = F.when(F.col("feature") == f, own).otherwise(ranks)
    others = [c for c in sketches.columns if c != "sketch"]
    rows = sketches.where(F.col("feature").isin(list(edges))).select(*others, F.concat(F.array(F.lit(0.0)), ranks, F.array(F.lit(1.0))).alias("_r"))
    bins = rows.withColumn("bin", F.explode(F.sequence(F.lit(0), F.size("_r") - 2)))
    return bins.select(*others, "bin", (F.col("_r")[F.col("bin") + 1] - F.col("_r")[F.col("bin")]).alias("share"))


def append_batch(df: DataFrame, columns: Sequence[str], target: str, batch: str, at: str, size: int = SIZE) -> None:
    """Sketch one batch and keep it under its name; writing the batch again replaces its sketches."""
    append_history(build(df, columns, size=size), target, batch, at)


def history_quantiles(spark: SparkSession, target: str, probabilities: Sequence[float], batches: Sequence[str] | None = None, size: int = SIZE) -> DataFrame:
    """(feature, n, probability, value) over all stored batches, or the named ones, without reading their rows again."""
    held = read_or_empty(spark, target, _HISTORY)
    if batches is not None:
        held = held.where(F.col("run_id").isin(list(batches)))
    return quantiles(merge(held, size=size), probabilities)
