"""Dense unique numbers by the order of the rows' own values, without a global sort in one task and without a hash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskweave.sources.shared import fresh_path


def dense_numbers(df: DataFrame, name: str, order: Sequence[str] | None = None) -> DataFrame:
    """``df`` with ``name`` counting 0 to n - 1 in the order of ``order`` (all columns unless given; nulls first).

    Two passes: rows are stored in ranges, and a row's number is the rows of the earlier ranges plus its place in its own.
    The stored layout makes it stable when tasks are repeated; a later run gives the same numbers to the same rows, as
    only rows that tie in ``order`` can change places. Many equal rows are spread over ranges too.
    """
    spark, by = df.sparkSession, list(order or df.columns)
    path = fresh_path(spark, "ranges")
    spread = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by, "_tie")
    spread.withColumn("_range", F.spark_partition_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_range", before.alias("_before"))  # one row per range: as many as tasks
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*by, "_tie")) - 1
    numbered = placed.withColumn("_place", place).join(offsets, "_range")
    return numbered.select(*df.columns, (F.col("_before") + F.col("_place")).cast("long").alias(name))
