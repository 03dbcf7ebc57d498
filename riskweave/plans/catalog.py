"""Every registered query: a name and a function of (session, data folder)."""

from __future__ import annotations

import uuid

from collections.abc import Callable
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions import fixed
from riskweave.functions import scalars as sc
from riskweave.functions import text as tx
from riskweave.operators import (
    aggregates,
    attribution,
    audit,
    boosting,
    drift,
    export,
    governance,
    grounding,
    impute,
    metrics,
    models,
    numbering,
    profile,
    pruned,
    ranking,
    registry,
    retrieval,
    silver,
    sketches,
    split,
    vector_index,
)
from riskweave.plans import fixtures as fx
from riskweave.plans.fixtures import table
from riskweave.plans.lifecycle import Lifecycle
from riskweave.sources import committed, files, tables
from riskweave.sources.local import small_frame
from riskweave.sources.shared import fresh_path
from riskweave.streaming import drift as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn



def run_at():
    return F.lit(fx.RUN_AT.isoformat())

FEATURES = fixed.PROXY_FEATURES
LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount"]


# Sources and sinks


@query
def ingest_paragraphs(spark, sf_dir):
    return files.split_paragraphs(fx.documents(spark, sf_dir), ["doc_id"], delimiter="\n", marker=",")


@query
def paragraph_words(spark, sf_dir):
    paragraphs = files.split_paragraphs(fx.documents(spark, sf_dir), ["doc_id"], delimiter="\n", marker=",")
    return profile.aggregate_by_name(paragraphs, {"word_count": "sum", "char_count": "sum", "paragraph_id": "max"})


@query
def csv_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "customer_csv")
    source = table(spark, sf_dir, "customer").withColumnsRenamed(
        {"c_name": "customer name", "c_acctbal": "account balance"}
    )
    source.write.option("header", True).csv(path)
    return files.sanitize_names(files.scan_csv(spark, path, source.schema))


@query
def csv_inferred(spark, sf_dir):
    """Types that a CSV scan without a schema finds in orders, and the filled values of each column."""
    path = fresh_path(spark, "orders_csv")
    table(spark, sf_dir, "orders").write.option("header", True).csv(path)
    found = files.scan_csv(spark, path)
    kinds = {"int": "whole number", "bigint": "whole number"}  # which of both depends on the largest value
    filled = found.agg(*[F.count(c).alias(c) for c in found.columns]).unpivot([], found.columns, "column_name", "filled")
    types = sc.recode(F.col("column_name"), {f.name: kinds.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in found.schema}, None)
    return filled.select("column_name", types.alias("data_type"), "filled")


@query
def json_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "events_json")
    source = table(spark, sf_dir, "events")
    source.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    return files.scan_json_lines(spark, path, source.schema)


@query
def table_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "supplier")
    tables.save_table(table(spark, sf_dir, "supplier"), path)
    return tables.read_table(spark, path)


@query
def append_history(spark, sf_dir):
    """Two runs, the second written twice; readers take the latest one."""
    path = fresh_path(spark, "status_history")
    orders = table(spark, sf_dir, "orders")
    counted = orders.groupBy("o_orderstatus").agg(F.count("*").alias("order_count"))
    early = orders.where(F.col("o_orderdate") < F.lit(fx.SPLIT_AT).cast("timestamp_ntz"))
    first = early.groupBy("o_orderstatus").agg(F.count("*").alias("order_count"))
    tables.append_history(first, path, "run-1", "2026-01-01")
    tables.append_history(first, path, "run-2", "2026-02-01")
    tables.append_history(counted, path, "run-2", "2026-02-01")
    return tables.latest_run(tables.read_table(spark, path))


@query
def rerun_history(spark, sf_dir):
    """Rows per run of a history whose runs were each written twice."""
    path = fresh_path(spark, "rerun_history")
    counted = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("order_count"))
    for run, at in (("1", "2026-01-01"), ("1", "2026-01-01"), ("2", "2026-02-01"), ("1", "2026-01-01"), ("2", "2026-02-01")):
        tables.append_history(counted, path, run, at)
    history = tables.read_table(spark, path)
    return history.groupBy("run_id", "run_at").agg(F.count("*").alias("row_count"), F.sum("order_count").alias("order_count"))


@query
def optional_table(spark, sf_dir):
    """Left join onto a table that was never written."""
    absent = tables.read_or_empty(spark, fresh_path(spark, "absent"), "doc_id long, review string")
    joined = table(spark, sf_dir, "documents").select("doc_id", "lang").join(absent, "doc_id", "left")
    return joined.groupBy("lang").agg(F.count("*").alias("documents"), F.count("review").alias("reviewed"))


@query
def evolved_schema(spark, sf_dir):
    """A table whose second version added a column, read with the merged schema."""
    path = fresh_path(spark, "orders_evolved")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    done = F.col("o_orderstatus") == "F"
    tables.save_table(orders.where(done).drop("o_totalprice"), path, mode="append")
    tables.save_table(orders.where(~done), path, mode="append")
    return tables.read_table(spark, path, merge_schema=True)


@query
def evolved_union(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    older = orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_orderstatus")
    newer = orders.where(F.col("o_orderstatus") != "F").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return tables.evolve(older, newer)


# Profiling


@query
def table_profile(spark, sf_dir):
    return profile.table_size(fx.home_like(spark, sf_dir))


@query
def value_counts(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "events"), "event_type")


@query
def class_share(spark, sf_dir):
    return profile.class_share(table(spark, sf_dir, "labels"), "quality")


@query
def null_profile(spark, sf_dir):
    return profile.null_profile(fx.projected_home(spark, sf_dir))


@query
def null_profile_batch(spark, sf_dir):
    aligned = silver.silver_batch(fx.batch_like(spark, sf_dir), sc.stable_id(F.col("row_key")))
    return profile.null_profile(aligned, count_nan=False)


@query
def describe_stats(spark, sf_dir):
    return profile.describe_stats(
        fx.home_like(spark, sf_dir), ["AMT_CREDIT", "AMT_ANNUITY", "AMT_INCOME_TOTAL", "DAYS_BIRTH", "EXT_SOURCE_1"]
    )


@query
def schema_contract(spark, sf_dir):
    """Columns of both raw sources side by side with their filled values."""
    home, batch = fx.home_like(spark, sf_dir), fx.batch_like(spark, sf_dir)

    def filled(df: DataFrame, name: str) -> DataFrame:
        wide = df.agg(*[F.count(c).alias(c) for c in df.columns])
        return wide.unpivot([], df.columns, "column_name", name)

    diff = profile.schema_diff(home, batch).drop("required", "same_type")
    both = diff.join(filled(home, "left_values"), "column_name", "left").join(
        filled(batch, "right_values"), "column_name", "left"
    )
    return both.fillna(0, ["left_values", "right_values"])


@query
def silver_contract(spark, sf_dir):
    """Columns of both silver tables with the missing values left in each."""
    home, batch = fx.silver_home(spark, sf_dir), fx.silver_batch(spark, sf_dir)
    silver_required = [*FEATURES, "gender", "education_level"]
    profile.require_aligned(home, batch, silver_required)
    diff = profile.schema_diff(home, batch, silver_required)
    left = profile.null_profile(home).withColumnRenamed("missing_count", "left_missing")
    right = profile.null_profile(batch).withColumnRenamed("missing_count", "right_missing")
    return diff.join(left, "column_name", "left").join(right, "column_name", "left").drop("same_type")


@query
def dist_compare(spark, sf_dir):
    home, batch = fx.stored(fx.silver_home(spark, sf_dir), "silver_home"), fx.stored(fx.silver_batch(spark, sf_dir), "silver_batch")
    return aggregates.compare_distributions(home, batch, FEATURES, exact_median=True, digits=3)


# Silver


@query
def silver_home(spark, sf_dir):
    return fx.projected_home(spark, sf_dir)


@query
def silver_batch(spark, sf_dir):
    return fx.silver_batch(spark, sf_dir)


@query
def silver_union(spark, sf_dir):
    both = silver.union_sources(fx.silver_home(spark, sf_dir), fx.silver_batch(spark, sf_dir))
    return both.groupBy("source_dataset", "gender").agg(
        F.count("*").alias("row_count"), F.max("credit_amount").alias("max_credit"), F.min("age").alias("min_age")
    )


@query
def impute_median(spark, sf_dir):
    return fx.silver_home(spark, sf_dir).select("applicant_id", *fixed.MEDIAN_FEATURES)


@query
def impute_const(spark, sf_dir):
    projected = fx.projected_home(spark, sf_dir).select("applicant_id", *fixed.EXTERNAL_SCORES)
    return impute.impute_constant(projected, {s: 0.5 for s in fixed.EXTERNAL_SCORES})


@query
def drop_non_finite(spark, sf_dir):
    annuity = F.col("AMT_ANNUITY")
    months = F.when(annuity == 0, F.lit(float("inf"))).otherwise(F.col("AMT_CREDIT") / annuity)
    raw = fx.home_like(spark, sf_dir).select(
        F.col("SK_ID_CURR").alias("applicant_id"), F.col("AMT_CREDIT").alias("credit_amount"), months.alias("months")
    )
    return silver.drop_non_finite(raw, ["credit_amount", "months"]).withColumn("months", F.round("months", 4))


# Aggregates


@query
def gender_crosstab(spark, sf_dir):
    return aggregates.crosstab(fx.projected_home(spark, sf_dir), "gender", "target")


@query
def approval_rate(spark, sf_dir):
    return aggregates.approval_rate(fx.projected_home(spark, sf_dir), "gender")


@query
def fairness_gap(spark, sf_dir):
    return aggregates.fairness_gap(fx.projected_home(spark, sf_dir), "gender")


@query
def class_ratio(spark, sf_dir):
    return aggregates.class_ratio(table(spark, sf_dir, "labels"), "quality")


@query
def band_share(spark, sf_dir):
    return aggregates.category_share(_costs(spark, sf_dir), "impact_band", fixed.IMPACT_BANDS)


@query
def alert_level(spark, sf_dir):
    return aggregates.alert_summary(_costs(spark, sf_dir), "grounding_score", "hallucination_risk")


@query
def latest_event(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    return tables.latest_per_key(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


# Drift


def _line_sides(spark, sf_dir, shifted: bool = False):
    lines = table(spark, sf_dir, "lineitem")
    at = F.lit(fx.SPLIT_AT).cast("timestamp_ntz")
    incoming = lines.where(F.col("l_shipdate") >= at)
    if shifted:
        incoming = incoming.where(F.col("l_quantity") > 10)
    return lines.where(F.col("l_shipdate") < at), incoming


@query
def drift_edges(spark, sf_dir):
    edges = drift.fit_edges(_line_sides(spark, sf_dir)[0], LINE_FEATURES)
    rows = [(f, i, round(e, 6)) for f, cuts in edges.items() for i, e in enumerate(cuts)]
    return small_frame(spark, rows, "feature_name string, edge_no int, edge double")


@query
def drift_hist(spark, sf_dir):
    baseline, incoming = _line_sides(spark, sf_dir)
    hist = drift.drift_histogram(baseline, incoming, drift.fit_edges(baseline, LINE_FEATURES))
    return hist.withColumns({c: F.round(c, 6) for c in ("expected_share", "actual_share")})


@query
def drift_psi(spark, sf_dir):
    return drift.drift_psi(fx.silver_home(spark, sf_dir), fx.silver_batch(spark, sf_dir), FEATURES)


@query
def drift_psi_lines(spark, sf_dir):
    return drift.drift_psi(*_line_sides(spark, sf_dir), LINE_FEATURES)


@query
def drift_psi_injected(spark, sf_dir):
    """Drift put in on purpose: incoming lines of small quantity are left out."""
    return drift.drift_psi(*_line_sides(spark, sf_dir, shifted=True), LINE_FEATURES)


@query
def drift_psi_events(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    at = F.lit(fx.EVENTS_SPLIT_AT).cast("timestamp_ntz")
    return drift.drift_psi(events.where(F.col("ts") < at), events.where(F.col("ts") >= at), ["value"])


@query
def drift_stream(spark, sf_dir):
    """Drift per day of all events, which arrive as a file of four days after another, against the first days' bins."""
    events, source = table(spark, sf_dir, "events").select("ts", "user_id", "value"), fresh_path(spark, "event_files")
    first = F.col("ts") < F.lit(fx.EVENTS_SPLIT_AT).cast("timestamp_ntz")
    edges = drift.fit_edges(events.where(first), ["value"])
    expected = streaming.expected_shares(events.where(first), edges)
    for day in range(1, 32, 4):
        part = events.where(F.dayofmonth("ts").between(day, day + 3))
        part.coalesce(1).write.mode("append").parquet(source)
    target = fresh_path(spark, "event_counts")
    streaming.follow(spark, source, events.schema, target, fresh_path(spark, "event_checkpoint"), "ts", edges, files_per_batch=1)
    found = streaming.window_drift(tables.read_table(spark, target), expected)
    return found.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))


@query
def drift_trigger(spark, sf_dir):
    return drift.drift_trigger(drift_psi(spark, sf_dir))


@query
def drift_report(spark, sf_dir):
    """Report rows appended to a history and read back as the latest run."""
    path = fresh_path(spark, "drift_metrics")
    report = drift.drift_psi(*_line_sides(spark, sf_dir), LINE_FEATURES)
    tables.append_history(report.withColumn("audit_timestamp", run_at()), path, "drift-1", fx.RUN_AT.isoformat())
    return tables.latest_run(tables.read_table(spark, path))


# Evaluation and promotion


def _long_scores(spark, sf_dir):
    return metrics.long_scores(fx.scored_home(spark, sf_dir), "target", {m: m for m in fx.SCORECARDS})


@query
def stratified_split(spark, sf_dir):
    parts = split.stratified_split(fx.projected_home(spark, sf_dir), "applicant_id", "target")
    return parts.select("applicant_id", "target", "is_test")


@query
def score_applicants(spark, sf_dir):
    scored = fx.scored_home(spark, sf_dir)
    return scored.select(
        "applicant_id",
        *[F.round(m, 6).alias(m) for m in fx.SCORECARDS],
        audit.risk_class(F.col("scorecard_a")).alias("risk_classification"),
    )


@query
def confusion(spark, sf_dir):
    return metrics.confusion(_long_scores(spark, sf_dir), 0.4)


@query
def classification_metrics(spark, sf_dir):
    return metrics.classification_metrics(_long_scores(spark, sf_dir), 0.4)


@query
def roc_auc(spark, sf_dir):
    return metrics.roc_auc(_long_scores(spark, sf_dir))


def _missing_scores(spark, sf_dir):
    """Projected, unimputed loans: a score is NULL where a feature is, and some labels are NULL."""
    b, w = fx.SCORECARDS["scorecard_a"]
    rows = fx.projected_home(spark, sf_dir).withColumn("score", attribution.logistic_score(w, b))
    label = F.when(F.col("applicant_id") % 11 != 0, F.col("target"))
    return rows.select(F.lit("scorecard_a").alias("model"), label.alias("label"), "score")


@query
def roc_auc_missing(spark, sf_dir):
    """Rows without score or label have no part in the area."""
    return metrics.roc_auc(_missing_scores(spark, sf_dir))


@query
def metrics_missing(spark, sf_dir):
    return metrics.classification_metrics(_missing_scores(spark, sf_dir), 0.4)


@query
def roc_auc_ties(spark, sf_dir):
    """A score with few distinct values: ties count half."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.lit("discount").alias("model"), (F.col("l_returnflag") == "R").cast("int").alias("label"),
        F.col("l_discount").alias("score"),
    )
    return metrics.roc_auc(lines)


@query
def leaderboard(spark, sf_dir):
    return metrics.leaderboard(metrics.evaluate(_long_scores(spark, sf_dir), 0.4))


@query
def promotion_gate(spark, sf_dir):
    measured = metrics.evaluate(_long_scores(spark, sf_dir), 0.4)
    return metrics.promotion_gate(measured, "scorecard_a", "scorecard_b", run_at())


@query
def synthetic_labels(spark, sf_dir):
    labelled = split.synthetic_labels(fx.silver_batch(spark, sf_dir), "applicant_id")
    return labelled.select("applicant_id", F.round("label_probability", 6).alias("label_probability"), "target")


# Training

SMALL_FOREST = {"numTrees": 10, "maxDepth": 5}
SMALL_BOOSTING = {"maxIter": 5, "maxDepth": 4}


def _trained(spark, sf_dir, kind, params):
    """The split and a model of its training rows, each stored by the first query of the session that needs it."""

    def divided():
        rows = fx.silver_home(spark, sf_dir).select("applicant_id", *FEATURES, "target")
        return split.stratified_split(rows, "applicant_id", "target")

    parts = fx.once(spark, sf_dir, "training_split", divided)
    name = "_".join([kind, *(f"{k}{v}" for k, v in params.items())])
    path = fx.once_path(
        spark, sf_dir, name, lambda at: models.fit(kind, parts.where(~F.col("is_test")), FEATURES, "target", params).save(at)
    )
    return PipelineModel.load(path), parts


def _test_metrics(spark, sf_dir, kind, params):
    model, parts = _trained(spark, sf_dir, kind, params)
    scored = models.score(model, parts.where("is_test"))
    return metrics.evaluate(metrics.long_scores(scored, "target", {kind: "score"}))


@query
def train_logistic(spark, sf_dir):
    return _test_metrics(spark, sf_dir, "logistic", {"maxIter": 50})


@query
def train_forest(spark, sf_dir):
    return _test_metrics(spark, sf_dir, "forest", SMALL_FOREST)


@query
def train_boosting(spark, sf_dir):
    return _test_metrics(spark, sf_dir, "boosting", SMALL_BOOSTING)


@query
def feature_importance(spark, sf_dir):
    model, _ = _trained(spark, sf_dir, "forest", SMALL_FOREST)
    return models.importances(model, FEATURES, spark)


KINDS = {"logistic": {"maxIter": 50}, "forest": SMALL_FOREST, "boosting": SMALL_BOOSTING}


@query
def class_weights(spark, sf_dir):
    """Weight of a row of each class under both schemes."""
    rows = fx.once(spark, sf_dir, "silver_home", lambda: fx.silver_home(spark, sf_dir)).select("target")
    for scheme in ("balanced", "positive_ratio"):
        rows = models.with_class_weight(rows, "target", scheme).withColumnRenamed("class_weight", scheme)
    return rows.groupBy("target").agg(
        F.count("*").alias("row_count"), F.round(F.max("balanced"), 6).alias("balanced"), F.max("positive_ratio").alias("positive_ratio")
    )


def _gradient(rows):
    """Whether the weighted residuals of a linear fit are free of each standardised feature, and of the mean."""
    spread = rows.agg(*[F.struct(F.avg(f).alias("m"), F.stddev_pop(f).alias("s")).alias(f) for f in FEATURES]).first()
    residual = F.col("class_weight") * (F.col("score") - F.col("target"))
    unit = {"intercept": F.lit(1.0), **{f: (F.col(f) - spread[f]["m"]) / spread[f]["s"] for f in FEATURES}}
    return {f"gradient of {f}": F.abs(F.sum(residual * x) / F.sum("class_weight")) < 1e-4 for f, x in unit.items()}


def _less_loss(rows, loss):
    """Whether the weighted loss on the training rows is under that of the best constant."""
    share = rows.agg(F.sum(F.col("class_weight") * F.col("target")) / F.sum("class_weight")).first()[0]
    return {"loss under constant": F.sum(F.col("class_weight") * (loss(F.col("score")) - loss(F.lit(share)))) < 0}


def _log_loss(p):
    return -F.log(F.when(F.col("target") == 1, p).otherwise(1 - p))


def _squared_loss(p):
    return (p - F.col("target")) ** 2


@query
def training_facts(spark, sf_dir):
    """What must hold of each fit on its training rows, with the sizes of both parts."""
    found = []
    for kind, scheme in (("logistic", "balanced"), ("forest", "balanced"), ("boosting", "positive_ratio")):
        model, parts = _trained(spark, sf_dir, kind, KINDS[kind])
        rows = models.score(model, models.with_class_weight(parts.where("not is_test"), "target", scheme))
        facts = _gradient(rows) if kind == "logistic" else _less_loss(rows, _squared_loss if kind == "forest" else _log_loss)
        held = rows.agg(*[holds.alias(fact) for fact, holds in facts.items()])
        found.append(held.unpivot([], list(facts), "fact", "holds").withColumn("model", F.lit(kind)))
    sizes = parts.agg(
        F.count_if(~F.col("is_test")).alias("train_rows"), F.count_if(F.col("is_test")).alias("test_rows"),
        F.sum(F.col("is_test").cast("long") * F.col("target")).alias("test_positives"),
    )
    return reduce(DataFrame.unionByName, found).withColumns({c: sizes.select(c).scalar() for c in sizes.columns})


@query
def importance_agrees(spark, sf_dir):
    """Importances of the forest against those counted from its stored nodes."""
    model, _ = _trained(spark, sf_dir, "forest", SMALL_FOREST)
    counted = export.split_importances(model, FEATURES, spark).withColumnRenamed("importance", "counted")
    both = models.importances(model, FEATURES, spark).join(counted, "feature")
    return both.select("feature", (F.abs(F.col("importance") - F.col("counted")) < 1e-9).alias("agrees"))


@query
def score_exported(spark, sf_dir):
    """Every applicant scored by each model and by its expression, which knows nothing of the model."""
    rows = fx.silver_batch(spark, sf_dir).select("applicant_id", *FEATURES)
    for kind, params in KINDS.items():
        model, _ = _trained(spark, sf_dir, kind, params)
        agrees = F.abs(F.col("score") - export.score_expression(model, FEATURES, spark)) < 1e-9
        rows = models.score(model, rows).withColumn(kind, agrees).drop("score")
    return rows.select("applicant_id", *KINDS)


@query
def tree_shap(spark, sf_dir):
    model, _ = _trained(spark, sf_dir, "boosting", SMALL_BOOSTING)
    return attribution.tree_shap(fx.silver_batch(spark, sf_dir).select("applicant_id", *FEATURES), model, FEATURES)


@query
def tree_shap_additive(spark, sf_dir):
    """Whether attributions and base add up to the margin that the model itself gives, per applicant."""
    model, _ = _trained(spark, sf_dir, "boosting", SMALL_BOOSTING)
    rows = models.score(model, fx.silver_batch(spark, sf_dir).select("applicant_id", *FEATURES))
    explained = attribution.tree_shap(rows, model, FEATURES)
    total = sum((F.col(attribution.shap_name(f)) for f in FEATURES), F.col("shap_base"))
    margin = F.log(F.col("score") / (1 - F.col("score"))) / 2  # boosted trees are on half of the log-odds
    return explained.select("applicant_id", (F.abs(total - margin) < 1e-9).alias("additive"))


SECOND_ORDER = {"rounds": 6, "depth": 4, "bins": 16}
GAPPED_FEATURES = [*FEATURES, *fixed.EXTERNAL_SCORES]


def _second_order(spark, sf_dir):
    """A model of loans whose missing values were not imputed, and all loans with their part."""
    rows = fx.projected_home(spark, sf_dir).select("applicant_id", *GAPPED_FEATURES, "target")
    parts = fx.stored(split.stratified_split(rows, "applicant_id", "target"), "split")
    return boosting.fit(parts.where("not is_test"), GAPPED_FEATURES, "target", SECOND_ORDER), parts


@query
def train_second_order(spark, sf_dir):
    model, parts = _second_order(spark, sf_dir)
    scored = boosting.score(model, parts.where("is_test"))
    return metrics.evaluate(metrics.long_scores(scored, "target", {"second_order": "score"}))


@query
def second_order_splits(spark, sf_dir):
    """Gain of every split of the first root, with missing values on either side."""
    rows = fx.stored(fx.projected_home(spark, sf_dir).select(*GAPPED_FEATURES, "target"), "projected_home")
    gains = boosting.root_gains(rows, GAPPED_FEATURES, "target", SECOND_ORDER)
    return gains.withColumns({"edge": F.round("edge", 6), "gain": F.round("gain", 4)})


@query
def second_order_additive(spark, sf_dir):
    """Whether attributions and base add up to the margin, per applicant, missing values included."""
    model, parts = _second_order(spark, sf_dir)
    scored = boosting.score(model, parts.select("applicant_id", *GAPPED_FEATURES), "score", "margin")
    explained = attribution.tree_shap(scored, model, GAPPED_FEATURES)
    total = sum((F.col(attribution.shap_name(f)) for f in GAPPED_FEATURES), F.col("shap_base"))
    return explained.select("applicant_id", (F.abs(total - F.col("margin")) < 1e-9).alias("additive"))


@query
def interventional_additive(spark, sf_dir):
    """Whether attributions against all training loans add up to the margin, per incoming applicant."""
    model, parts = _second_order(spark, sf_dir)
    batch = fx.silver_batch(spark, sf_dir).select("applicant_id", *GAPPED_FEATURES)
    scored = boosting.score(model, batch, "score", "margin")
    explained = attribution.interventional_shap(scored, model, parts.where("not is_test"), GAPPED_FEATURES)
    total = sum((F.col(attribution.shap_name(f)) for f in GAPPED_FEATURES), F.col("shap_base"))
    return explained.select("applicant_id", (F.abs(total - F.col("margin")) < 1e-9).alias("additive"))


@query
def registry_alias(spark, sf_dir):
    """An alias set forward, back, and beside another one, read after each step."""
    model, _ = _trained(spark, sf_dir, "logistic", {"maxIter": 5})
    store, where, seen = fresh_path(spark, "registry"), fresh_path(spark, "models"), []
    for step, (alias, version) in enumerate([("Champion", None), ("Champion", None), ("Champion", 1), ("Shadow", 1), ("Champion", 2)]):
        if version is None:
            for _ in range(2):  # a repeated step finds its version
                registry.register(spark, store, "credit_risk", model, where, alias, {}, "2026-01-01", run=f"step-{step}")
        else:
            registry.set_alias(spark, store, "credit_risk", alias, version, "2026-01-01")
        held = tables.read_table(spark, store)
        seen += [(step, a, registry.resolve_alias(held, "credit_risk", a).first()["version"]) for a in ("Champion", "Shadow")]
    return small_frame(spark, seen, "step int, alias string, version int")


@query
def managed_table(spark, sf_dir):
    """A catalog table, written twice and read by name."""
    name = f"riskweave_{uuid.uuid4().hex}"
    source = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    for _ in range(2):
        tables.save_table(source, name)
    kept = fx.stored(tables.read_table(spark, name), "managed")
    spark.sql(f"DROP TABLE {name}")
    return kept


@query
def sketch_rank_error(spark, sf_dir):
    """Whether the sketched median of each feature is within one thousandth of the ranks from the middle."""
    rows = fx.stored(fx.projected_home(spark, sf_dir), "projected_home")
    medians = impute.fit_medians(rows, fixed.MEDIAN_FEATURES)
    shares = [
        (F.abs(F.avg(F.when(F.col(f).isNotNull(), (F.col(f) < m).cast("double") + (F.col(f) == m).cast("double") / 2)) - 0.5)
         <= 0.001 + F.avg(F.when(F.col(f).isNotNull(), (F.col(f) == m).cast("double"))) / 2 + 1 / F.count(f)).alias(f)
        for f, m in medians.items()
    ]
    return rows.agg(*shares).unpivot([], list(medians), "feature", "close")


QUANTILES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def _line_years(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").cast("string").alias("year"), *LINE_FEATURES)


def _off_rank(rows, found, keys):
    """``found`` (keys, feature, probability, value, n) with the distance of each value's ranks from the wanted one."""
    long = rows.unpivot(keys, LINE_FEATURES, "feature", "v").groupBy(*keys, "feature", "v").agg(F.count("*").alias("c"))
    both = long.join(F.broadcast(found), [*keys, "feature"])  # a row per sketch and probability; values are as many as rows
    below, upto = (F.sum(F.when(test, F.col("c")).otherwise(0)) / F.first("n") for test in (F.col("v") < F.col("value"), F.col("v") <= F.col("value")))
    p = F.col("probability")
    ranks = both.groupBy(*keys, "feature", "n", "probability").agg(below.alias("below"), upto.alias("upto"))
    return ranks.withColumn("off", F.greatest(F.col("below") - p, p - F.col("upto"), F.lit(0.0)))


@query
def sketch_quantiles(spark, sf_dir):
    """Quantiles over the stored sketches of all years, one year written twice: within three rank errors of the rows."""
    rows, path = _line_years(spark, sf_dir), fresh_path(spark, "sketch_history")
    years = sorted(r["year"] for r in rows.select("year").distinct().collect())
    for year in [*years, years[0]]:
        sketches.append_batch(rows.where(F.col("year") == year), LINE_FEATURES, path, year, fx.RUN_AT.isoformat())
    found = fx.stored(sketches.history_quantiles(spark, path, QUANTILES), "history_quantiles")
    return _off_rank(rows.drop("year"), found, []).select("feature", "probability", "n", (F.col("off") <= 3 * sketches.rank_error()).alias("close"))


@query
def sketch_by_year(spark, sf_dir):
    """The same per year, from one scan with a sketch for each year and feature."""
    rows = _line_years(spark, sf_dir)
    found = fx.stored(sketches.quantiles(sketches.build(rows, LINE_FEATURES, ["year"]), QUANTILES), "year_quantiles")
    return _off_rank(rows, found, ["year"]).select("year", "feature", "probability", "n", (F.col("off") <= 3 * sketches.rank_error()).alias("close"))


@query
def retrain_loop(spark, sf_dir):
    """Champion from the baseline, challenger from the labelled batch, gate, registry."""
    champion, _ = _trained(spark, sf_dir, "boosting", {})
    batch = split.synthetic_labels(fx.silver_batch(spark, sf_dir), "applicant_id")
    batch = batch.select("applicant_id", *FEATURES, "target")
    parts = fx.stored(
        split.stratified_split(
            batch, "applicant_id", "target", fixed.CHALLENGER_TEST_SHARE, fixed.CHALLENGER_SEED
        ),
        "challenger_split",
    )
    challenger = models.fit("boosting", parts.where(~F.col("is_test")), FEATURES, "target")
    scored = models.score(champion, parts.where("is_test"), "champion")
    scored = models.score(challenger, scored, "challenger")
    measured = metrics.evaluate(
        metrics.long_scores(scored, "target", {"champion": "champion", "challenger": "challenger"})
    )
    outcome = metrics.promotion_gate(measured, "champion", "challenger", run_at())
    path = fresh_path(spark, "model_comparison")
    tables.save_table(outcome, path, mode="append")
    kept = tables.read_table(spark, path)
    record = kept.first()
    store, where = fresh_path(spark, "registry"), fresh_path(spark, "models")
    at = fx.RUN_AT.isoformat()
    registry.register(spark, store, "credit_risk", champion, where, "Champion", {"auc": record["champion_auc"]}, at)
    if record["promotion_action"] == fixed.PROMOTED:
        registry.register(
            spark, store, "credit_risk", challenger, where, "Champion", {"auc": record["challenger_auc"]}, at
        )
    active = registry.resolve_alias(tables.read_table(spark, store), "credit_risk", "Champion")
    version = active.agg(F.max("version").alias("v")).scalar()
    return kept.withColumn("active_version", version)


def _lifecycle(spark, sf_dir):
    """All steps from raw loans to the audit table, through stored tables, once per session."""

    def steps(root):
        return Lifecycle(spark, root, "run-1", fx.RUN_AT.isoformat(), KINDS)

    def fill(root):
        steps(root).run(
            fx.home_like(spark, sf_dir), fx.batch_like(spark, sf_dir), table(spark, sf_dir, "benchmark"), passage_id="item_id"
        )

    return steps(fx.once_path(spark, sf_dir, "lifecycle", fill))


@query
def model_lifecycle(spark, sf_dir):
    return _lifecycle(spark, sf_dir).read("audit_table")


LIFECYCLE_TABLES = [
    "projected_home", "silver_home", "silver_batch", "training_split", "test_scores", "leaderboard", "drift_metrics",
    "challenger_split", "challenger_scores", "model_comparison", "explanations", "hallucination_cost", "audit_table",
]


@query
def lifecycle_tables(spark, sf_dir):
    """Rows of every table that the steps leave."""
    steps = _lifecycle(spark, sf_dir)
    counts = [steps.read(n).agg(F.lit(n).alias("table_name"), F.count("*").alias("row_count")) for n in LIFECYCLE_TABLES]
    return reduce(DataFrame.unionByName, counts)


def _recounted(scores, names):
    """Long rows (model, key, recounted): the metrics of stored scores."""
    measured = metrics.evaluate(metrics.long_scores(scores, "target", names))
    return measured.unpivot(["model"], ["accuracy", "precision", "recall", "f1", "roc_auc"], "key", "recounted")


@query
def run_log(spark, sf_dir):
    """Log of all fits: the parameters they were given, whether metrics agree with the stored scores, what is important."""
    steps = _lifecycle(spark, sf_dir)
    log = steps.read("run_log").join(_recounted(steps.read("test_scores"), {k: k for k in KINDS}), ["model", "key"], "left")
    number = F.col("value").try_cast("double")
    shown = (
        F.when(F.col("kind") == "param", F.col("value"))
        .when(F.col("kind") == "metric", (F.abs(number - F.col("recounted")) < 1e-9).cast("string"))
        .otherwise((number >= 0).cast("string"))
    )
    given = F.col("key").isin("maxIter", "numTrees", "maxDepth") | (F.col("kind") != "param")
    return log.where(given).select("run_id", "model", "kind", "key", shown.alias("value"))


@query
def challenger_facts(spark, sf_dir):
    """The challenger's test rows, and whether comparison, action and version in charge follow from their scores."""
    steps = _lifecycle(spark, sf_dir)
    scores = steps.read("challenger_scores")
    again = {r["model"]: r["recounted"] for r in _recounted(scores, {"old": "old", "new": "new"}).where("key = 'roc_auc'").collect()}
    promoted = again["new"] > again["old"]
    active = registry.resolve_alias(steps.read("registry"), "credit_risk", "Champion").agg(F.max("version").alias("v")).scalar()
    compared = steps.read("model_comparison")
    agrees = (F.abs(F.col("champion_auc") - again["old"]) < 1e-9) & (F.abs(F.col("challenger_auc") - again["new"]) < 1e-9)
    sizes = scores.agg(F.count("*").alias("test_rows"), F.sum("target").alias("test_positives"))
    return compared.select(
        sizes.select("test_rows").scalar().alias("test_rows"),
        sizes.select("test_positives").scalar().alias("test_positives"),
        agrees.alias("auc_agrees"),
        ((F.col("promotion_action") == fixed.PROMOTED) == F.lit(promoted)).alias("action_follows"),
        (active == (2 if promoted else 1)).alias("version_follows"),
    )



# Explanation


def _rounded(name):
    """To six digits, without a negative zero."""
    return (F.round(name, 6) + F.lit(0.0)).alias(name)


def _shap(spark, sf_dir):
    scored = fx.scored_batch(spark, sf_dir)
    means = attribution.background_means(scored, FEATURES)
    return attribution.linear_shap(scored, fx.SCORECARDS["scorecard_a"][1], means)


@query
def linear_shap(spark, sf_dir):
    return _shap(spark, sf_dir).select(
        "applicant_id", *[_rounded(attribution.shap_name(f)) for f in FEATURES]
    )


@query
def global_importance(spark, sf_dir):
    return attribution.global_importance(_shap(spark, sf_dir), FEATURES)


@query
def local_drivers(spark, sf_dir):
    drivers = attribution.local_drivers(_shap(spark, sf_dir), FEATURES)
    names = {n: F.array_join(F.transform(n, lambda d: d.getField("feature")), ",") for n in ("drivers_up", "drivers_down")}
    return drivers.select("applicant_id", *[c.alias(n) for n, c in names.items()])


def _explanations(spark, sf_dir):
    drivers = attribution.local_drivers(_shap(spark, sf_dir), FEATURES)
    return attribution.explanation_records(drivers, "scorecard_a", fx.MODEL_VERSION, run_at())


@query
def explanations(spark, sf_dir):
    return _explanations(spark, sf_dir).withColumns(
        {c: _rounded(c) for c in ("total_risk_score", "top_positive_shap", "top_negative_shap")}
    )


# Retrieval and grounding


def _neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return retrieval.cosine_topk(
        vectors.select(F.col("vec_id").alias("query_id"), "embedding"),
        vectors.select(F.col("vec_id").alias("passage_id"), "embedding"),
        k=2,
        skip_same_id=True,
    )


@query
def cosine_topk(spark, sf_dir):
    """For every vector, its two nearest other vectors."""
    return _neighbours(spark, sf_dir).withColumn("similarity", F.round("similarity", 4))


def _indexed(spark, sf_dir):
    """All embeddings as queries and as an index, and the probes that a sample of the queries asks for."""
    vectors = table(spark, sf_dir, "embeddings")
    index = vector_index.build_index(vectors.select(F.col("vec_id").alias("passage_id"), "embedding"), fresh_path(spark, "vector_index"))
    asked = vectors.select(F.col("vec_id").alias("query_id"), "embedding")
    return asked, index, vector_index.choose_probes(asked, index, 10, skip_same_id=True)


@query
def ann_topk(spark, sf_dir):
    """For every vector, ten other vectors that are nearest, by probing an index."""
    asked, index, probes = _indexed(spark, sf_dir)
    return vector_index.ann_topk(asked, index, 10, probes, True).withColumn("similarity", F.round("similarity", 4))


@query
def ann_recall(spark, sf_dir):
    """Whether probing finds at least 0.95 of the ten nearest vectors of the exact search, over all vectors as queries."""
    asked, index, probes = _indexed(spark, sf_dir)
    corpus = asked.withColumnRenamed("query_id", "passage_id")
    exact = fx.stored(retrieval.cosine_topk(asked, corpus, 10, True), "exact_topk")
    measured = vector_index.recall_of(vector_index.ann_topk(asked, index, 10, probes, True), exact)
    return measured.select("queries", "wanted", (F.col("recall") >= 0.95).alias("recalled"))


def _passages(spark, sf_dir):
    return retrieval.corpus_passages(table(spark, sf_dir, "documents"), "doc_id")


@query
def corpus_passages(spark, sf_dir):
    return _passages(spark, sf_dir).select("passage_id", F.length("text").alias("char_count"))


@query
def context_blocks(spark, sf_dir):
    return retrieval.context_blocks(_neighbours(spark, sf_dir), _passages(spark, sf_dir))


@query
def prompt_rows(spark, sf_dir):
    """Prompt per document: its text and its two best policy passages."""
    docs = fx.documents(spark, sf_dir)
    passages = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("passage_id"), "text")
    hits = grounding.top_passages(docs, "doc_id", "text", fx.policy_index(spark, sf_dir))
    context = retrieval.context_blocks(hits.withColumnRenamed("doc_id", "query_id"), passages)
    joined = docs.select("doc_id", "text").join(context, docs.doc_id == context.query_id, "left")
    return retrieval.prompt_rows(joined, "text", "context_text").select("doc_id", "prompt")


@query
def top_passages(spark, sf_dir):
    docs = fx.documents(spark, sf_dir)
    hits = grounding.top_passages(docs, "doc_id", "text", fx.policy_index(spark, sf_dir))
    return hits.withColumn("similarity", F.round("similarity", 4))


def _pruned_index(spark, sf_dir):
    return pruned.write_index(table(spark, sf_dir, "benchmark"), "item_id", "text", fresh_path(spark, "pruned_index"))


@query
def pruned_top_passages(spark, sf_dir):
    """The rows of ``top_passages``, from postings above the cutoffs only."""
    hits = pruned.top_passages(fx.documents(spark, sf_dir), "doc_id", "text", _pruned_index(spark, sf_dir))
    return hits.withColumn("similarity", F.round("similarity", 4))


@query
def pruned_grounding(spark, sf_dir):
    """The scores of ``grounding_score``, from postings above the cutoffs only."""
    docs = fx.documents(spark, sf_dir)
    scores = pruned.grounding_scores(docs, "doc_id", "text", _pruned_index(spark, sf_dir))
    return scores.select(
        F.col("doc_id").alias("applicant_id"), F.round("grounding", 4).alias("grounding_score"),
        grounding.hallucination_risk(F.col("grounding")).alias("hallucination_risk"),
    )


@query
def verdicts(spark, sf_dir):
    graded = fx.grounded_documents(spark, sf_dir)
    verdict = retrieval.rule_verdict(F.col("grounding"))
    return graded.select(
        "applicant_id", verdict.alias("verdict"), F.lit("rule").alias("source"), retrieval.clearance(verdict).alias("clearance")
    )


@query
def tfidf_weights(spark, sf_dir):
    weights = grounding.tfidf_weights(table(spark, sf_dir, "benchmark"), "item_id", "text")
    return weights.withColumns({"idf": F.round("idf", 4), "weight": F.round("weight", 4)})


@query
def grounding_score(spark, sf_dir):
    graded = fx.grounded_documents(spark, sf_dir)
    return graded.select(
        "applicant_id",
        F.round("grounding", 4).alias("grounding_score"),
        grounding.hallucination_risk(F.col("grounding")).alias("hallucination_risk"),
    )


@query
def compliance_hits(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    docs = fx.documents(spark, sf_dir).select(
        F.col("doc_id").alias("conv_id"), F.lit(-1).cast("long").alias("turn"), "text"
    )
    hits = governance.compliance_hits(F.col("text"), fx.DOCUMENT_KEYWORDS)
    return turns.unionByName(docs).select("conv_id", "turn", governance.joined_hits(hits).alias("claims"))


def _costs(spark, sf_dir):
    scored = fx.grounded_documents(spark, sf_dir).withColumn("ml_risk_score", sc.uniform_draw(F.col("applicant_id")))
    return governance.cost_records(scored, "grounding", "text", "ml_risk_score", run_at(), fx.DOCUMENT_KEYWORDS)


@query
def impact_review(spark, sf_dir):
    return _costs(spark, sf_dir).drop("explanation")


@query
def metric_eval(spark, sf_dir):
    graded = fx.grounded_documents(spark, sf_dir)
    g = F.col("grounding")
    rows = governance.score_metrics(
        graded, {"factual_grounding": g, "hallucination_risk": grounding.hallucination_risk(g)}
    )
    return governance.aggregate_metrics(
        rows,
        {
            "avg_grounding": F.round(F.avg("factual_grounding"), 4),
            "avg_hallucination_risk": F.round(F.avg("hallucination_risk"), 4),
        },
    )


@query
def chunk_overlap(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.posexplode(tx.chunks(F.col("text"))).alias("chunk_no", "chunk"))


@query
def chunk_topk(spark, sf_dir):
    """For every benchmark text, the three best chunks of all documents, by exact search over pruned postings."""
    chunks = retrieval.chunk_passages(table(spark, sf_dir, "documents"), "doc_id", "text")
    index = pruned.write_index(chunks, "passage_id", "text", fresh_path(spark, "chunk_index"))
    best = pruned.top_passages(table(spark, sf_dir, "benchmark"), "item_id", "text", index, 3)
    found = best.join(chunks.drop("text"), "passage_id")
    return found.select("item_id", "rank", "doc_id", "chunk_no", F.round("similarity", 4).alias("similarity"))


# Audit and serving


def _audit(spark, sf_dir):
    """The audit table, assembled and stored by the first query that reads it."""
    return fx.once(spark, sf_dir, "audit_table", lambda: _assembled_audit(spark, sf_dir))


def _assembled_audit(spark, sf_dir):
    """The whole batch. Documents stand for the explanations of the applicants of their number, so most have none."""
    shap = _shap(spark, sf_dir)
    drivers = attribution.local_drivers(shap, FEATURES)
    scores = shap.select("applicant_id", F.col("scorecard_a").alias("model_prediction"))
    numbered = ranking.with_ordinal(scores.select(F.col("applicant_id").alias("own_id")), "own_id", "ordinal")
    costs = _costs(spark, sf_dir).join(numbered, F.col("applicant_id") == F.col("ordinal"))
    costs = costs.withColumn("applicant_id", F.col("own_id")).drop("own_id", "ordinal")
    records = attribution.explanation_records(drivers, "scorecard_a", fx.MODEL_VERSION, run_at())
    return audit.assemble_audit(
        scores,
        fx.stored(records.select("applicant_id", "explanation_summary"), "explanations"),
        fx.stored(costs.select("applicant_id", "impact_band", "review_flag"), "costs"),
        fx.stored(drift_psi_lines(spark, sf_dir), "drift_metrics"),
        fx.stored(promotion_gate(spark, sf_dir), "model_comparison"),
        fx.MODEL_VERSION,
        run_at(),
    )


@query
def audit_table(spark, sf_dir):
    return _audit(spark, sf_dir)


@query
def audit_upsert(spark, sf_dir):
    """The audit table from three batches by applicant: the first holds stale labels and lacks a quarter of the rows."""
    rows, key = _audit(spark, sf_dir), F.col("applicant_id")
    store = committed.Committed(spark, fresh_path(spark, "audit_upsert"))
    part = F.pmod(key, F.lit(4))
    stale = F.when(part == 0, F.col("explanation_label")).otherwise("not yet audited")
    store.upsert(rows.where(part != 3).withColumn("explanation_label", stale), ["applicant_id"])
    store.upsert(rows.where(part.isin(1, 3)), ["applicant_id"])
    store.upsert(rows.where(part == 2), ["applicant_id"])
    return store.read()


@query
def keyed_upsert(spark, sf_dir):
    """Latest order per customer, kept up to date by the latest orders of three periods."""
    store = committed.Committed(spark, fresh_path(spark, "latest_orders"))
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    year = F.year("o_orderdate")
    for period in (year < 1996, year.between(1996, 1997), year > 1997):
        store.upsert(tables.latest_per_key(orders.where(period), ["o_custkey"], ["o_orderdate", "o_orderkey"]), ["o_custkey"], 16)
    return store.read()


@query
def latest_audit(spark, sf_dir):
    return audit.latest_audit(_audit(spark, sf_dir), 50)


@query
def dashboard_kpis(spark, sf_dir):
    return audit.dashboard_kpis(_audit(spark, sf_dir))


@query
def applicant_ordinal(spark, sf_dir):
    ids = fx.stored(fx.silver_batch(spark, sf_dir).select("applicant_id"), "applicant_ids")  # read once per level, and more
    return ranking.with_ordinal(ids, "applicant_id", "ordinal")


@query
def numbered_applicants(spark, sf_dir):
    """Incoming loans numbered from zero by the order of their values."""
    rows = fx.batch_like(spark, sf_dir)
    return numbering.dense_numbers(rows, "applicant_id").select("applicant_id", "row_key", "Age", "Credit_amount")


@query
def badges(spark, sf_dir):
    rows = _audit(spark, sf_dir)
    return rows.select(
        "applicant_id",
        audit.badge(F.col("explanation_label")).alias("badge"),
        audit.short_class(F.col("risk_classification")).alias("short_class"),
    )


@query
def context_sentence(spark, sf_dir):
    return _audit(spark, sf_dir).select("applicant_id", audit.context_sentence().alias("sentence"))


def _scenarios(spark, sf_dir):
    c = F.col
    return fx.home_like(spark, sf_dir).select(
        c("SK_ID_CURR").alias("applicant_id"),
        sc.years(c("DAYS_BIRTH")).alias("age"),
        (F.abs("AMT_INCOME_TOTAL") * 12).alias("income"),
        ((c("SK_ID_CURR") % 67) + 6).cast("int").alias("duration"),
    )


@query
def scenario_score(spark, sf_dir):
    scored = audit.score_scenarios(_scenarios(spark, sf_dir)).drop("age", "income", "duration")
    return scored.withColumn("predicted_risk", F.round("predicted_risk", 6))


@query
def scenario_grid(spark, sf_dir):
    """Applicants per occupied slider cell, with the score of each cell."""
    c = F.col
    cells = _scenarios(spark, sf_dir).groupBy(
        audit.snap(c("age"), fixed.SLIDER_AGE).alias("age"),
        audit.snap(c("income"), fixed.SLIDER_INCOME).alias("income"),
        audit.snap(c("duration"), fixed.SLIDER_DURATION).alias("duration"),
    ).agg(F.count("*").alias("applicants"))
    return audit.score_scenarios(cells).withColumn("predicted_risk", F.round("predicted_risk", 6))


@query
def slider_grid(spark, sf_dir):
    """The whole grid of the three sliders: score of every position, and how many applicants stand there."""
    c = F.col
    sliders = {"age": fixed.SLIDER_AGE, "income": fixed.SLIDER_INCOME, "duration": fixed.SLIDER_DURATION}
    cells = _scenarios(spark, sf_dir).groupBy(*[audit.snap(c(n), s).alias(n) for n, s in sliders.items()]).agg(F.count("*").alias("applicants"))
    grid = audit.whole_grid(cells, **sliders).withColumn("applicants", F.coalesce("applicants", F.lit(0).cast("long")))
    scored = audit.score_scenarios(grid).select(*sliders, "applicants", "predicted_risk", "classification")
    return scored.withColumn("predicted_risk", F.round("predicted_risk", 6))


@query
def scenario_sweep(spark, sf_dir):
    """Every applicant at every duration of the slider: class counts per duration."""
    swept = audit.what_if(_scenarios(spark, sf_dir).drop("duration"), duration=fixed.SLIDER_DURATION)
    return audit.score_scenarios(swept).groupBy("duration", "classification").agg(F.count("*").alias("applicants"))
