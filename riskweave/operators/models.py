"""Training and scoring with ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions import fixed
from riskweave.sources.local import small_frame


def with_class_weight(df: DataFrame, label: str, scheme: str = "balanced") -> DataFrame:
    """Add ``class_weight``: n/(2*n_c), or negatives per positive on positives only."""
    counts = df.agg(F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")).first()
    neg, pos = counts["neg"], counts["pos"]
    positive = F.col(label) == 1
    if scheme == "balanced":
        own = {0: (neg + pos) / (2 * neg) if neg else 1.0, 1: (neg + pos) / (2 * pos) if pos else 1.0}
        return df.withColumn("class_weight", F.when(positive, own[1]).otherwise(own[0]))
    if scheme == "positive_ratio":
        lift = round(neg / pos, 2) if pos and neg else 1.0
        return df.withColumn("class_weight", F.when(positive, lift).otherwise(1.0))
    raise ValueError(f"unknown weighting scheme {scheme}")


_KINDS = {
    "logistic": (LogisticRegression, fixed.LOGISTIC_PARAMS, "balanced"),
    "forest": (RandomForestClassifier, fixed.FOREST_PARAMS, "balanced"),
    "boosting": (GBTClassifier, fixed.BOOSTING_PARAMS, "positive_ratio"),
}


def fit(
    kind: str, train: DataFrame, features: list[str], label: str, params: Mapping | None = None
) -> PipelineModel:
    """Fit one weighted classifier on complete rows; ``params`` override the defaults."""
    estimator_class, defaults, scheme = _KINDS[kind]
    estimator = estimator_class(
        featuresCol="features", labelCol=label, weightCol="class_weight", **{**defaults, **(params or {})}
    )
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    rows = with_class_weight(train.dropna(subset=[*features, label]), label, scheme)
    return Pipeline(stages=[assembler, estimator]).fit(rows.select(*features, label, "class_weight"))


def score(model: PipelineModel, df: DataFrame, name: str = "score") -> DataFrame:
    """Add the probability of class 1."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(name))


def importances(model: PipelineModel, features: list[str], spark) -> DataFrame:
    """Feature importances of a tree model, or absolute coefficients of a linear one."""
    last = model.stages[-1]
    values = last.featureImportances if hasattr(last, "featureImportances") else abs(last.coefficients.toArray())
    rows = [(f, float(v)) for f, v in zip(features, values)]
    return small_frame(spark, rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )
