"""The whole model lifecycle as steps that read and write tables under one root.

Each step reads its inputs from tables and overwrites its own, or its run's part of a history, so
any step can be run again alone after a failure. ``run_id`` and ``run_at`` tell runs apart; readers
take the latest.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions import fixed
from riskweave.operators import (
    attribution,
    audit,
    drift,
    governance,
    grounding,
    impute,
    metrics,
    models,
    registry,
    silver,
    split,
)
from riskweave.operators.numbering import dense_numbers
from riskweave.sources import tables
from riskweave.sources.local import small_frame
from riskweave.sources.shared import fresh_path

MODEL = "credit_risk"
CHAMPION = "Champion"
FEATURES = fixed.PROXY_FEATURES

DRIFT_SCHEMA = "feature_name string, psi_score double, drift_status string, run_id string, run_at string"
COMPARISON_SCHEMA = (
    "timestamp string, champion_auc double, champion_f1 double, challenger_auc double, challenger_f1 double, "
    "better_model string, promotion_action string, run_id string, run_at string"
)
EXPLANATION_SCHEMA = "applicant_id long, explanation_summary string, total_risk_score double, run_id string, run_at string"
MEDIAN_SCHEMA = "feature string, median double, run_id string, run_at string"
COST_SCHEMA = "applicant_id long, impact_band string, review_flag string"


def numbered_rows(df: DataFrame) -> tuple[DataFrame, Column]:
    """``df`` with a dense number per row in the order of its values, and the column that holds it."""
    return dense_numbers(df, "_row_id", sorted(df.columns)), F.col("_row_id")


@dataclass(frozen=True)
class Lifecycle:
    spark: SparkSession
    root: str
    run_id: str
    run_at: str
    params: Mapping[str, Mapping] = field(default_factory=dict)
    score_mode: str = "probability"  # or "class": the champion's side of the comparison is its predicted class
    files: str | None = None  # folder of models, registry and index; needed where the root is a catalog schema

    def path(self, name: str) -> str:
        """Table ``name`` below the root: a folder, or a name in a schema (``schema`` or ``catalog.schema``)."""
        return f"{self.root.rstrip('/')}/{name}" if "/" in self.root else f"{self.root}.{name}"

    def folder(self, name: str) -> str:
        """Folder for what is no table of the catalog."""
        if self.files is None and "/" not in self.root:
            raise ValueError("with a catalog schema as root, name a folder for models and registry in files")
        return f"{(self.files or self.root).rstrip('/')}/{name}"

    def read(self, name: str, schema: str | None = None) -> DataFrame:
        if schema is None:
            return tables.read_table(self.spark, self.path(name))
        return tables.read_or_empty(self.spark, self.path(name), schema)

    def write(self, df: DataFrame, name: str) -> None:
        tables.save_table(df, self.path(name))

    def append(self, df: DataFrame, name: str) -> None:
        tables.append_history(df, self.path(name), self.run_id, self.run_at)

    def align(self, home: DataFrame, batch: DataFrame, batch_id: Column | None = None) -> None:
        """Both sources on the shared schema, imputed and filtered.

        ``batch_id`` must be unique per row; later steps join on it. Without one, rows are numbered
        in the order of their values, so that running the step again gives the same numbers.
        """
        if batch_id is None:
            batch, batch_id = numbered_rows(batch)
        self.write(silver.silver_home(home), "projected_home")
        projected = self.read("projected_home")
        filled = impute.impute(projected, self._medians(projected))
        self.write(silver.keep_labelled_known_gender(filled), "silver_home")
        aligned = impute.impute_constant(
            silver.silver_batch(batch, batch_id), {s: 0.5 for s in fixed.EXTERNAL_SCORES}
        )
        self.write(silver.drop_incomplete(aligned, [*FEATURES, "target"]), "silver_batch")

    def _medians(self, projected: DataFrame) -> dict[str, float]:
        """Sketched medians, fitted once per run: merging a sketch involves chance, and a repeated step must agree."""

        def held() -> dict[str, float]:
            rows = self.read("medians", MEDIAN_SCHEMA).where(F.col("run_id") == self.run_id)
            return {r["feature"]: r["median"] for r in rows.select("feature", "median").collect()}

        if not held():
            fitted = impute.fit_medians(projected, fixed.MEDIAN_FEATURES)
            self.append(small_frame(self.spark, list(fitted.items()), "feature string, median double"), "medians")
        return held()

    def train(self) -> None:
        """Three classifiers on one split; the best by AUC, then F1, becomes champion."""
        rows = silver.drop_non_finite(self.read("silver_home"), [*FEATURES])
        rows = rows.select("applicant_id", *FEATURES, "target")
        self.write(split.stratified_split(rows, "applicant_id", "target"), "training_split")
        parts = self.read("training_split")
        test, fitted = parts.where("is_test"), {}
        for kind in ("logistic", "forest", "boosting"):
            fitted[kind] = models.fit(
                kind, parts.where(~F.col("is_test")), FEATURES, "target", self.params.get(kind)
            )
            test = models.score(fitted[kind], test, kind)
        self.write(test.select("applicant_id", "target", *fitted), "test_scores")
        measured = metrics.evaluate(metrics.long_scores(self.read("test_scores"), "target", {k: k for k in fitted}))
        self.append(metrics.leaderboard(measured), "leaderboard")
        board = tables.latest_run(self.read("leaderboard")).collect()  # one row per model
        self._log(fitted, {r["model"]: r for r in board}, "run_log")
        best = next(r for r in board if r["is_champion"])
        self._register(fitted[best["model"]], {"roc_auc": best["roc_auc"], "f1": best["f1"]}, "train")

    def _log(self, fitted: Mapping, measured: Mapping, name: str) -> None:
        """Parameters, metrics and importances of every fit of the step."""
        logs = []
        for kind, model in fitted.items():
            numbers = {m: measured[kind][m] for m in ("accuracy", "precision", "recall", "f1", "roc_auc")}
            weights = {r["feature"]: r["importance"] for r in models.importances(model, FEATURES, self.spark).collect()}
            logs.append(registry.run_log(self.spark, self.run_id, registry.effective_params(model), numbers, weights, kind))
        self.append(reduce(DataFrame.unionByName, logs).drop("run_id"), name)

    def _register(self, model, measured: Mapping[str, float], step: str) -> None:
        """Register once per run and step; a repeated step finds the version it got."""
        registry.register(
            self.spark, self.folder("registry"), MODEL, model, self.folder("models"), CHAMPION, measured, self.run_at, self._step(step)
        )

    def _step(self, step: str) -> str:
        return f"{self.run_id}/{step}"

    def champion(self, before: str | None = None):
        """The model in charge, or the one that was before the named step of this run registered its own."""
        held = tables.read_table(self.spark, self.folder("registry"))
        if before:
            held = held.where(~F.col("run").eqNullSafe(self._step(before)))
        return registry.load_by_alias(held, MODEL, CHAMPION)

    def monitor(self) -> bool:
        """Drift of the batch against the baseline; true when retraining is called for."""
        self.append(drift.drift_psi(self.read("silver_home"), self.read("silver_batch"), FEATURES), "drift_metrics")
        report = tables.latest_run(self.read("drift_metrics"))
        return drift.drift_trigger(report).first()["retraining_trigger"]

    def retrain(self) -> None:
        """Challenger on the labelled batch against the champion on the same test rows."""
        labelled = split.synthetic_labels(self.read("silver_batch"), "applicant_id")
        labelled = labelled.select("applicant_id", *FEATURES, "target")
        share, seed = fixed.CHALLENGER_TEST_SHARE, fixed.CHALLENGER_SEED
        self.write(split.stratified_split(labelled, "applicant_id", "target", share, seed), "challenger_split")
        parts = self.read("challenger_split")
        challenger = models.fit(
            "boosting", parts.where(~F.col("is_test")), FEATURES, "target", self.params.get("boosting")
        )
        incumbent, _ = self.champion(before="retrain")
        scored = models.score(challenger, models.score(incumbent, parts.where("is_test"), "old"), "new")
        if self.score_mode == "class":
            scored = scored.withColumn("old", metrics.predicted_class(F.col("old"), 0.5).cast("double"))
        self.write(scored.select("applicant_id", "target", "old", "new"), "challenger_scores")
        measured = metrics.evaluate(metrics.long_scores(self.read("challenger_scores"), "target", {"old": "old", "new": "new"}))
        self._log({"challenger": challenger}, {"challenger": measured.where("model = 'new'").first()}, "challenger_log")
        self.append(metrics.promotion_gate(measured, "old", "new", F.lit(self.run_at)), "model_comparison")
        outcome = tables.latest_run(self.read("model_comparison")).first()
        if outcome["promotion_action"] == fixed.PROMOTED:
            self._register(challenger, {"roc_auc": outcome["challenger_auc"], "f1": outcome["challenger_f1"]}, "retrain")

    def explain(self) -> None:
        """Score, attribution and sentence of every applicant of the batch."""
        model, version = self.champion()
        rows = self.read("silver_batch").select("applicant_id", *FEATURES)
        scored = models.score(model, rows, "score")
        last = model.stages[-1]
        if hasattr(last, "coefficients"):
            weights = dict(zip(FEATURES, map(float, last.coefficients)))
            attributed = attribution.linear_shap(scored, weights, attribution.background_means(rows, FEATURES))
        else:
            attributed = attribution.tree_shap(scored, model, FEATURES)
        drivers = attribution.local_drivers(attributed, FEATURES)
        records = attribution.explanation_records(drivers, "score", f"{MODEL}/{version}", F.lit(self.run_at))
        self.append(records, "explanations")

    def ground(self, policy: DataFrame, passage_id: str = "paragraph_id", text: str = "text") -> None:
        """Support of each explanation in the policy corpus, and its cost record; equal sentences are looked up once."""
        passages = policy.select(F.col(passage_id).alias("passage_id"), F.col(text).alias("text"))
        index = grounding.write_index(passages, "passage_id", "text", self.folder(f"policy_index/{self.run_id}"))
        said = tables.latest_run(self.read("explanations")).select("applicant_id", "explanation_summary", "total_risk_score")
        said = said.where(F.col("applicant_id").isNotNull())
        texts, path = said.select(F.col("explanation_summary").alias("_text")).distinct(), fresh_path(self.spark, "text_scores")
        tables.save_table(grounding.grounding_scores(texts, "_text", "_text", index), path)
        scores = tables.read_table(self.spark, path)
        graded = said.join(scores, said["explanation_summary"].eqNullSafe(scores["_text"])).drop("_text")
        costs = governance.cost_records(graded, "grounding", "explanation_summary", "total_risk_score", F.lit(self.run_at))
        self.write(costs, "hallucination_cost")

    def assemble(self) -> DataFrame:
        """The audit table of every applicant of the batch."""
        model, version = self.champion()
        rows = self.read("silver_batch").select("applicant_id", *FEATURES)
        scores = models.score(model, rows, "model_prediction").select("applicant_id", "model_prediction")
        drifted = tables.latest_run(self.read("drift_metrics", DRIFT_SCHEMA))
        audited = audit.assemble_audit(
            scores,
            tables.latest_run(self.read("explanations", EXPLANATION_SCHEMA)),
            self.read("hallucination_cost", COST_SCHEMA),
            drifted,
            self.read("model_comparison", COMPARISON_SCHEMA),
            str(version),
            F.lit(self.run_at),
        )
        self.write(audited, "audit_table")
        return self.read("audit_table")

    def run(
        self,
        home: DataFrame,
        batch: DataFrame,
        policy: DataFrame,
        batch_id: Column | None = None,
        passage_id: str = "paragraph_id",
        text: str = "text",
    ) -> DataFrame:
        self.align(home, batch, batch_id)
        self.train()
        if self.monitor():
            self.retrain()
        self.explain()
        self.ground(policy, passage_id, text)
        return self.assemble()
