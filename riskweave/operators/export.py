"""Fitted classifiers as expressions and tables: scoring without a model stage, and importances from the stored nodes."""

from __future__ import annotations

import json
from typing import TYPE_CHECKING

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators.attribution import TreeNodes, ensemble_nodes, logistic_score
from riskweave.sources.shared import fresh_path

if TYPE_CHECKING:
    from riskweave.operators.boosting import BoostedTrees

_NODE = "struct<feature:int,cut:double,below:int,above:int,missing_below:boolean,value:double>"


def _depth(tree: TreeNodes, node: int = 0) -> int:
    if tree.feature[node] < 0:
        return 0
    return 1 + max(_depth(tree, int(tree.left[node])), _depth(tree, int(tree.right[node])))


def _listed(tree: TreeNodes) -> list[dict]:
    side = tree.missing_left if tree.missing_left is not None else [False] * len(tree.feature)
    names = ("feature", "cut", "below", "above", "missing_below", "value")
    columns = zip(tree.feature, tree.threshold, tree.left, tree.right, side, tree.value, strict=True)
    return [dict(zip(names, (int(f), float(c), int(b), int(a), bool(m), float(v)), strict=True)) for f, c, b, a, m, v in columns]


def tree_sum(trees: list[TreeNodes], features: list[str]) -> Column:
    """Sum of the leaves' values that a row reaches, as one expression of the feature columns.

    The nodes are one constant, so the plan does not grow with the trees. NULL and NaN take the side that a tree learnt for
    missing values, else the upper one.
    """
    nodes = F.from_json(F.lit(json.dumps([_listed(t) for t in trees])), f"array<array<{_NODE}>>")
    values = F.array(*[F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")) for f in features])
    steps = F.sequence(F.lit(0), F.lit(max(map(_depth, trees), default=0)))

    def next_node(tree: Column, at: Column) -> Column:
        node = F.get(tree, at)
        value = F.get(values, node["feature"])
        below = F.when(value.isNull(), node["missing_below"]).otherwise(value <= node["cut"])
        return F.when(node["feature"] < 0, at).when(below, node["below"]).otherwise(node["above"])

    def leaf(tree: Column) -> Column:
        return F.aggregate(steps, F.lit(0), lambda at, _: next_node(tree, at))

    return F.aggregate(nodes, F.lit(0.0), lambda total, tree: total + F.get(tree, leaf(tree))["value"])


def score_expression(model: PipelineModel | BoostedTrees, features: list[str], spark: SparkSession) -> Column:
    """Probability of class 1 of a fitted linear, forest or boosting model; for linear models NULL where a feature is.

    Scoring with it needs neither the assembler nor the model: it is a projection inside the JVM, also in a stream or a view.
    """
    if hasattr(model, "trees"):
        return 1 / (1 + F.exp(-(tree_sum(list(model.trees), features) + model.base)))
    last = model.stages[-1]
    if hasattr(last, "coefficients"):
        return logistic_score(dict(zip(features, map(float, last.coefficients), strict=True)), float(last.intercept))
    total = tree_sum(ensemble_nodes(model, spark), features)
    return 1 / (1 + F.exp(-2 * total)) if type(last).__name__.startswith("GBT") else total  # boosting works on half log-odds


def split_importances(model: PipelineModel, features: list[str], spark: SparkSession) -> DataFrame:
    """(feature, importance) of a forest from its stored nodes: weighted gain of the splits on each feature, each tree
    counting alike, adding up to one. A forest without any split gives 0 everywhere."""
    path = fresh_path(spark, "trees")
    model.stages[-1].write().save(path)
    node = F.col("nodeData")
    weight = F.aggregate(node["impurityStats"], F.lit(0.0), lambda a, b: a + b)
    splits = spark.read.parquet(f"{path}/data").where(node["leftChild"] >= 0)
    gains = splits.groupBy("treeID", node["split"]["featureIndex"].alias("at")).agg(F.sum(node["gain"] * weight).alias("gain"))
    totals = gains.groupBy("treeID").agg(F.sum("gain").alias("total"))
    shares = gains.join(totals, "treeID").groupBy("at").agg(F.sum(F.try_divide("gain", "total")).alias("share"))
    whole = shares.agg(F.sum("share").alias("s")).scalar()
    own = F.explode(F.array(*[F.struct(F.lit(i).alias("at"), F.lit(f).alias("feature")) for i, f in enumerate(features)]))
    named = spark.range(1).select(own.alias("n")).select("n.*")
    return named.join(shares, "at", "left").select("feature", F.coalesce(F.try_divide("share", whole), F.lit(0.0)).alias("importance"))
