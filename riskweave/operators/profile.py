"""Profiling and data quality: every column in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from riskweave.functions.scalars import is_missing
from riskweave.operators.aggregates import column_stats
from riskweave.sources.local import small_frame


def table_size(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("row_count"), F.lit(len(df.columns)).cast("long").alias("column_count")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("row_count"))


def class_share(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """Count and percent per class. The total is a scalar subquery over the few class counts."""
    counts = value_counts(df, column)
    total = counts.agg(F.sum("row_count").alias("n")).scalar()
    return counts.withColumn("percent", F.round(F.col("row_count") / total * 100, digits))


def null_profile(
    df: DataFrame, columns: list[str] | None = None, count_nan: bool = True
) -> DataFrame:
    """Missing values per column, largest first: one aggregate, then turned to rows."""
    columns = columns or df.columns
    missing = {c: is_missing(df, c) if count_nan else F.col(c).isNull() for c in columns}
    wide = df.agg(*[F.count_if(cond).alias(c) for c, cond in missing.items()])
    return wide.unpivot([], columns, "column_name", "missing_count").orderBy(
        F.desc("missing_count"), "column_name"
    )


def describe_stats(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    """Typed count, mean, sample deviation, min and max per numeric column."""
    for c in columns:
        if not isinstance(df.schema[c].dataType, NumericType):
            raise TypeError(f"{c} is not numeric")
    return column_stats(
        df.select([F.col(c).cast("double") for c in columns]),
        columns,
        "column_name",
        {
            "value_count": F.count,
            "mean": lambda c: F.round(F.mean(c), digits),
            "stddev": lambda c: F.round(F.stddev(c), digits),
            "min": F.min,
            "max": F.max,
        },
    )


def aggregate_by_name(df: DataFrame, spec: dict[str, str]) -> DataFrame:
    """``{"word_count": "sum"}`` becomes a column ``sum_word_count``."""
    return df.agg(*[F.expr(f"{fn}(`{c}`)").alias(f"{fn}_{c}") for c, fn in spec.items()])


def schema_diff(left: DataFrame, right: DataFrame, required: list[str] = ()) -> DataFrame:
    """One row per column name of either table: where it lives and whether the types agree."""
    spark = left.sparkSession
    rows = "column_name string, data_type string"

    def listing(df: DataFrame) -> DataFrame:
        return small_frame(spark, [(f.name, f.dataType.simpleString()) for f in df.schema], rows)

    a, b = listing(left).alias("a"), listing(right).alias("b")
    must = F.coalesce(F.col("a.column_name"), F.col("b.column_name")).isin(list(required))
    return a.join(b, F.col("a.column_name") == F.col("b.column_name"), "full_outer").select(
        F.coalesce("a.column_name", "b.column_name").alias("column_name"),
        F.col("a.column_name").isNotNull().alias("in_left"),
        F.col("b.column_name").isNotNull().alias("in_right"),
        F.coalesce(F.col("a.data_type") == F.col("b.data_type"), F.lit(False)).alias("same_type"),
        must.alias("required"),
    )


def require_aligned(left: DataFrame, right: DataFrame, required: list[str] = ()) -> None:
    """Raise when the column sets differ or a required column is absent."""
    a, b = set(left.columns), set(right.columns)
    problems = sorted(a ^ b) + sorted(set(required) - (a & b))
    if problems:
        raise ValueError(f"schemas are not aligned: {', '.join(problems)}")
