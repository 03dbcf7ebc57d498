"""Registered queries of this package, ``op<N>_<name>``, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm import bpe, decontaminate, lattice, line_dedup, merkle, quality, rules, simhash, spelling, substring_dedup, suffix_dedup, toxicity, warc
from riskweave.llm.common import table
from riskweave.sources.shared import fresh_path

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_captures(spark, table(spark, sf_dir, "pages"), fresh_path(spark, "warc"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.benchmark_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.byte_digest(table(spark, sf_dir, "documents"))


def op5_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.word_digest(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, *toxicity.train(docs, table(spark, sf_dir, "labels")))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digest(table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.verdicts(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_decontamination": op2_decontamination,
    "op3_quality": op3_quality,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_lattice": op5_lattice,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_bpe": op7_bpe,
    "op8_simhash": op8_simhash,
    "op9_toxicity": op9_toxicity,
    "op10_line_dedup": op10_line_dedup,
    "op11_spelling": op11_spelling,
    "op12_rules": op12_rules,
    "op13_merkle": op13_merkle,
}
