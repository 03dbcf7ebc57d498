"""File scans: CSV, JSON lines and policy text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskweave.functions import text as tx


def scan_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header. A declared schema avoids the extra pass type inference needs."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def sanitize_names(df: DataFrame) -> DataFrame:
    """Replace spaces in column names by underscores."""
    return df.withColumnsRenamed({c: c.replace(" ", "_") for c in df.columns if " " in c})


def scan_json_lines(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    return spark.read.json(path, schema=schema)


def scan_text(spark: SparkSession, path: str) -> DataFrame:
    """One row (source_path, text) per file."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("text")
    )


def split_paragraphs(
    df: DataFrame,
    keys: list[str],
    text: str = "text",
    delimiter: str = "\n\n",
    marker: str = ":",
    ingested_at=None,
) -> DataFrame:
    """Stripped, non-empty paragraphs numbered from 1 inside each row, with label and sizes."""
    pieces = F.split(F.col(text), rf"\Q{delimiter}\E")
    kept = F.filter(F.transform(pieces, tx.strip), lambda p: p != "")
    body = F.col("paragraph")
    out = df.select(*keys, F.posexplode(kept).alias("position", "paragraph")).select(
        *keys,
        (F.col("position") + 1).cast("int").alias("paragraph_id"),
        tx.section_label(body, marker).alias("section"),
        body.alias("text"),
        F.length(body).cast("int").alias("char_count"),
        tx.word_count(body).cast("int").alias("word_count"),
    )
    if ingested_at is not None:
        out = out.withColumn("ingestion_timestamp", F.lit(ingested_at))
    return out
