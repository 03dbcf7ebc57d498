"""Small frames from values the caller already holds."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def small_frame(spark: SparkSession, rows: Iterable[tuple], schema: StructType | str) -> DataFrame:
    """A handful of rows as a local relation: its size is known to the planner, no job runs."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = list(rows)
    if not rows:
        return spark.createDataFrame([], schema)
    columns = {f.name: pa.array([r[i] for r in rows]) for i, f in enumerate(schema)}
    return spark.createDataFrame(pa.table(columns), schema)
