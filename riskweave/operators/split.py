"""Reproducible stratified split and delayed synthetic labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.functions import fixed
from riskweave.functions import scalars as sc
from riskweave.operators.ranking import exact_quantiles
from riskweave.sources.shared import fresh_path


def stratified_split(
    df: DataFrame, row_id: str, label: str, share: float = fixed.TEST_SHARE, seed: int = fixed.SEED
) -> DataFrame:
    """Add ``is_test``: per class, the given share of rows with the lowest id hash.

    Membership depends on id and seed only, so it survives repartitioning and retries. The cut
    is one number per class. Classes and hashes are stored once, as finding it takes several passes.
    """
    hashed = df.withColumn("_h", sc.stable_hash(F.col(row_id), F.lit(seed)))
    path = fresh_path(df.sparkSession, "hashes")
    hashed.select(label, "_h").write.parquet(path)
    cuts = exact_quantiles(df.sparkSession.read.parquet(path), [label], "_h", [share], method="discrete")
    cut = sc.recode(F.col(label), {c: int(v[0]) for (c,), v in cuts.items()}, None)
    return hashed.withColumn("is_test", F.col("_h") <= cut).drop("_h")


def label_probability(credit: Column, income: Column, age: Column) -> Column:
    """Chance of default assumed for a batch whose outcomes are not known yet."""
    raw = F.try_divide(credit, income + 1) * 0.1 - age * 0.005 + 0.3
    return sc.clip(raw, 0.0, 1.0)


def synthetic_labels(df: DataFrame, row_id: str, seed: int = fixed.SEED) -> DataFrame:
    """Replace the target by a reproducible Bernoulli draw of ``label_probability``."""
    p = label_probability(F.col("credit_amount"), F.col("income_proxy"), F.col("age"))
    draw = sc.uniform_draw(F.col(row_id), F.lit(seed))
    return df.withColumn("label_probability", p).withColumn(
        "target", F.when(draw < F.col("label_probability"), 1).otherwise(0)
    )
