"""Classifier evaluation for any number of models in one pass."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.functions import fixed
from riskweave.operators.ranking import running_before


def predicted_class(probability: Column, threshold: float = fixed.DECISION_THRESHOLD) -> Column:
    """Strictly above the threshold."""
    return (probability > threshold).cast("int")


def long_scores(df: DataFrame, label: str, models: Mapping[str, str]) -> DataFrame:
    """Rows (model, label, score) from one score column per model."""
    wide = df.select(F.col(label).cast("int").alias("label"), *[F.col(c).alias(m) for m, c in models.items()])
    return wide.unpivot(["label"], list(models), "model", "score")


def judged(scores: DataFrame) -> DataFrame:
    """Rows that have a label and a score; the others can be neither right nor wrong."""
    return scores.where(F.col("label").isNotNull() & F.col("score").isNotNull() & ~F.isnan(F.col("score").cast("double")))


def confusion(scores: DataFrame, threshold: float = fixed.DECISION_THRESHOLD) -> DataFrame:
    """Rows per (model, label, predicted); rows without label or score are left out."""
    return judged(scores).groupBy("model", "label", predicted_class(F.col("score"), threshold).alias("predicted")).agg(
        F.count("*").alias("row_count")
    )


def classification_metrics(
    scores: DataFrame, threshold: float = fixed.DECISION_THRESHOLD, digits: int = 6
) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class; an empty denominator gives 0.

    Rows without label or score (NULL or NaN) are left out of every count.
    """
    hit = F.col("score") > threshold
    positive = F.col("label") == 1
    counts = judged(scores).groupBy("model").agg(
        F.count("*").cast("double").alias("n"),
        F.count_if(~positive & ~hit).cast("double").alias("tn"),
        F.count_if(positive & hit).cast("double").alias("tp"),
        F.count_if(~positive & hit).cast("double").alias("fp"),
        F.count_if(positive & ~hit).cast("double").alias("fn"),
    )
    tp, fp, fn, n = (F.col(c) for c in ("tp", "fp", "fn", "n"))
    tn = F.col("tn")

    def safe(a: Column, b: Column) -> Column:
        return F.round(F.coalesce(F.try_divide(a, b), F.lit(0.0)), digits)

    return counts.select(
        "model",
        safe(tp + tn, n).alias("accuracy"),
        safe(tp, tp + fp).alias("precision"),
        safe(tp, tp + fn).alias("recall"),
        safe(tp * 2, tp * 2 + fp + fn).alias("f1"),
    )


def roc_auc(scores: DataFrame, digits: int = 6, rows_per_part: int = 250_000) -> DataFrame:
    """Exact area under the curve per model; tied scores count half.

    Scores are first reduced to (positives, negatives) per distinct score. NULL when a model
    has seen only one class. Rows without label or score (NULL or NaN) are left out.
    ``rows_per_part`` sets how finely the score axis is cut, not the result.
    """
    counts = judged(scores).groupBy("model", "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )
    ranked = running_before(counts, ["model"], "score", ["neg"], rows_per_part)
    wins = F.col("pos") * (F.col("neg_before") + F.col("neg") / 2)
    sums = ranked.groupBy("model").agg(
        F.sum(wins).alias("w"), F.sum("pos").cast("double").alias("p"), F.sum("neg").cast("double").alias("n")
    )
    return sums.select("model", F.round(F.try_divide(F.col("w"), F.col("p") * F.col("n")), digits).alias("roc_auc"))


def evaluate(scores: DataFrame, threshold: float = fixed.DECISION_THRESHOLD) -> DataFrame:
    return classification_metrics(scores, threshold).join(roc_auc(scores), "model")


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Models by AUC, then F1, then name; the first is the champion.

    The window orders one row per model, not data rows.
    """
    place = F.row_number().over(Window.orderBy(F.desc("roc_auc"), F.desc("f1"), F.asc("model")))
    return metrics.withColumn("place", place).orderBy("place").withColumn("is_champion", F.col("place") == 1)


def promotion_gate(metrics: DataFrame, champion: str, challenger: str, at: Column) -> DataFrame:
    """Comparison record; the challenger is promoted only on a strictly higher AUC."""

    def of(model: str, metric: str, name: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col(metric))).alias(name)

    row = metrics.agg(
        of(champion, "roc_auc", "champion_auc"),
        of(champion, "f1", "champion_f1"),
        of(challenger, "roc_auc", "challenger_auc"),
        of(challenger, "f1", "challenger_f1"),
    )
    better = F.col("challenger_auc") > F.col("champion_auc")
    return row.select(
        at.alias("timestamp"),
        "champion_auc",
        "champion_f1",
        "challenger_auc",
        "challenger_f1",
        F.when(better, "Challenger").otherwise("Champion").alias("better_model"),
        F.when(better, fixed.PROMOTED).otherwise(fixed.REJECTED).alias("promotion_action"),
    )
