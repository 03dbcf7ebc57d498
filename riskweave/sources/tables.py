"""Table reads and writes by path or catalog name."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskweave.sources.committed import Committed, is_committed


def _is_path(target: str) -> bool:
    return "/" in target


def table_format(spark: SparkSession) -> str:
    """Delta where the session is set up for it, else the session's default (parquet)."""
    extensions = spark.conf.get("spark.sql.extensions", "") or ""
    return "delta" if "delta" in extensions.lower() else spark.conf.get("spark.sql.sources.default")


def save_table(
    df: DataFrame, target: str, mode: str = "overwrite", partition_by: list[str] | None = None
) -> None:
    """Write to a path or a catalog table, letting a Delta table take new columns."""
    fmt = table_format(df.sparkSession)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "delta":
        writer = writer.option("mergeSchema", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(target) if _is_path(target) else writer.saveAsTable(target)


def read_table(spark: SparkSession, target: str, merge_schema: bool = False) -> DataFrame:
    """Read a path in the session's table format, or a catalog table by name; of a committed table, the last version."""
    if not _is_path(target):
        return spark.read.table(target)
    if is_committed(spark, target):
        return Committed(spark, target).read()
    return spark.read.format(table_format(spark)).option("mergeSchema", merge_schema).load(target)


def read_or_empty(spark: SparkSession, target: str, schema: StructType | str) -> DataFrame:
    """The table, or an empty frame of the declared schema when it does not exist."""
    try:
        return read_table(spark, target)
    except AnalysisException as error:
        absent = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
        if not any(name in str(error) for name in absent):
            raise
        return spark.createDataFrame([], schema)


_RUN_PART = "run_part"


def append_history(df: DataFrame, target: str, run_id: str, run_at) -> None:
    """Add one run's rows under its id and time, so readers can tell runs apart.

    A run is a partition: writing it again, after a failure or on purpose, replaces its own rows
    and leaves other runs alone. The partition name is prefixed so that it is read back as text.
    """
    part = f"run {run_id}"
    rows = df.withColumns({"run_id": F.lit(run_id), "run_at": F.lit(run_at), _RUN_PART: F.lit(part)})
    fmt = table_format(df.sparkSession)
    writer = rows.write.mode("overwrite").format(fmt).partitionBy(_RUN_PART)
    if fmt == "delta":
        writer = writer.option("replaceWhere", f"{_RUN_PART} = '{part}'").option("mergeSchema", True)
    else:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if _is_path(target):
        writer.save(target)
    elif df.sparkSession.catalog.tableExists(target):
        rows.select(df.sparkSession.read.table(target).columns).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).insertInto(target)
    else:
        writer.saveAsTable(target)


def latest_run(history: DataFrame) -> DataFrame:
    """Rows of the latest run only: one scalar subquery, then a filter."""
    newest = history.agg(F.max_by("run_id", F.struct("run_at", "run_id")).alias("r")).scalar()
    return history.where(F.col("run_id") == newest).drop(_RUN_PART)


def evolve(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Union of two table versions; columns one side lacks are NULL there."""
    return older.unionByName(newer, allowMissingColumns=True)


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last row of each key. ``max_by`` pre-aggregates map-side, so a hot key stays small."""
    others = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*others), F.struct(*order)).alias("last")
    return df.groupBy(*keys).agg(last).select(*keys, "last.*")
