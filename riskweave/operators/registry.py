"""Model registry as a committed table, and run log as an append-only one."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.sources.committed import Committed, State

REGISTRY_SCHEMA = "name string, version int, path string, alias string, metrics map<string,double>, registered_at string, set_no int, run string"
RUN_LOG_SCHEMA = "run_id string, model string, kind string, key string, value string"


def latest_version(registry: DataFrame, name: str) -> int:
    """Highest registered version; 0 when there is none. One aggregate, one number."""
    return registry.where(F.col("name") == name).agg(F.coalesce(F.max("version"), F.lit(0))).first()[0]


def register(
    spark: SparkSession,
    registry_path: str,
    name: str,
    model: PipelineModel,
    model_path: str,
    alias: str,
    metrics: Mapping[str, float],
    at: str,
    run: str | None = None,
) -> int:
    """Save the model, add its registry row and return the new version.

    The row is committed as a whole under the next number of the registry's manifest; of two writers one is first, and
    the other takes the version after it. ``run`` names the step that registers: when it is repeated, the version it
    got is returned and nothing is added.
    """
    path = f"{model_path}/{name}/{uuid.uuid4().hex}"
    store, taken, saved = Committed(spark, registry_path), {}, []

    def row(state: State) -> DataFrame | None:
        held = _held(store, state)
        again = held.where((F.col("name") == name) & (F.col("run") == run)).agg(F.min("version")).first()[0] if run else None
        taken["version"] = again or latest_version(held, name) + 1
        if again:
            return None
        if not saved:
            model.write().save(path)
            saved.append(path)
        return _row(spark, held, (name, taken["version"], path, alias, dict(metrics), at), run)

    store.append(row)
    return taken["version"]


def _held(store: Committed, state: State) -> DataFrame:
    return store.frame(state) if state.live else store.spark.createDataFrame([], REGISTRY_SCHEMA)


def _row(spark: SparkSession, held: DataFrame, row: tuple, run: str | None) -> DataFrame:
    last = held.agg(F.coalesce(F.max("set_no"), F.lit(0))).first()[0]
    return spark.createDataFrame([(*row, last + 1, run)], REGISTRY_SCHEMA).coalesce(1)


def set_alias(spark: SparkSession, registry_path: str, name: str, alias: str, version: int, at: str) -> None:
    """Point an alias at a registered version, older ones included; a version may have several aliases."""
    store = Committed(spark, registry_path)

    def row(state: State) -> DataFrame:
        held = _held(store, state)
        known = held.where((F.col("name") == name) & (F.col("version") == version)).select("path", "metrics").first()
        if known is None:
            raise LookupError(f"{name} has no version {version}")
        return _row(spark, held, (name, version, known["path"], alias, known["metrics"], at), None)

    store.append(row)


def resolve_alias(registry: DataFrame, name: str, alias: str, fallback: int = 1) -> DataFrame:
    """One row (name, version, path): the version the alias was set to last, else the fallback version."""
    mine = registry.where(F.col("name") == name)
    aliased = F.when(F.col("alias") == alias, F.col("set_no"))
    chosen = mine.agg(F.coalesce(F.max_by("version", aliased), F.lit(fallback)).alias("v")).scalar()
    return mine.where(F.col("version") == chosen).select("name", "version", "path").distinct()


def load_by_alias(registry: DataFrame, name: str, alias: str) -> tuple[PipelineModel, int]:
    row = resolve_alias(registry, name, alias).first()
    if row is None:
        raise LookupError(f"no registered version of {name}")
    return PipelineModel.load(row["path"]), row["version"]


def run_log(
    spark: SparkSession,
    run_id: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    importances: Mapping[str, float] | None = None,
    model: str | None = None,
) -> DataFrame:
    """Long table of one fit's effective parameters, metrics and importances."""
    kinds = {"param": params, "metric": metrics, "importance": importances or {}}
    rows = [(run_id, model, kind, k, str(v)) for kind, values in kinds.items() for k, v in values.items()]
    return spark.createDataFrame(rows, RUN_LOG_SCHEMA)


def effective_params(model: PipelineModel) -> dict[str, object]:
    """All parameters the fitted estimator ran with, defaults included."""
    return {p.name: v for p, v in model.stages[-1].extractParamMap().items()}
