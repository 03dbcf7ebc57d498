"""Labelled rows to learn from, by fold, in a bounded number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; false for a null id."""
    return (F.crc32(doc_id.cast("string")) % folds).eqNullSafe(F.lit(fold).cast("long"))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int) -> DataFrame:
    """(doc_id, text as bytes, label): at most ``most`` labelled rows outside the held-out fold, picked by a hash of the id.

    Null labels and ids are left out; an id that is labelled twice takes its larger label. The picked ids, at most
    ``most`` pairs of numbers, are small by construction and are joined without moving texts.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).dropna()
    known = known.where(~in_fold(F.col("doc_id"), folds, held_out)).groupBy("doc_id").agg(F.max("label").alias("label"))
    picked = known.orderBy(F.xxhash64("doc_id", F.lit(label)), "doc_id").limit(most)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), *(["n_chars"] if "n_chars" in docs.columns else []))
    return texts.join(F.broadcast(picked), "doc_id")
