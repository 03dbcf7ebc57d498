"""Corpus preparation in five stages: quality, repeated lines, near-duplicates, benchmark leaks, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from riskweave.llm import bpe, decontaminate, line_dedup, quality, simhash
from riskweave.llm.common import stored_at, table
from riskweave.sources.shared import remove

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from labelled rows of these documents."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that a smaller id holds; ``n_chars`` is counted anew."""
    return line_dedup.dedup_lines(docs)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links at two or fewer differing SimHash bits, the one with the smallest id."""
    return simhash.representatives(docs)


def keep_unleaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids): token ids as little-endian unsigned 32-bit integers."""
    return bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN)


STAGES = [
    ("quality", keep_good),
    ("lines", cut_lines),
    ("near_duplicates", keep_distinct),
    ("decontamination", keep_unleaked),
    ("tokens", tokenise),
]

#: A trained classifier and a tokenizer have no counterpart in SQL; tests run every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored for the next stage, which reads it repeatedly, then removed.

    The table of the last stage but one stays, as the returned frame reads it.
    """
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        old = path
        docs, path = stored_at(stage(spark, docs, sf_dir), name)
        if old:
            remove(spark, old)
    return STAGES[-1][1](spark, docs, sf_dir)
