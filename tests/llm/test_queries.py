"""Registered queries of the subpackage: against SQL where it exists, and the pipeline against its stages' own checks."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from check import connect, difference
from riskweave.llm.bpe import read_ranks
from riskweave.llm.oracles import ORACLES
from riskweave.llm.queries import QUERIES
from tests.llm.test_operators import brute_bytes, brute_lines, brute_print, corpus, frame, plain_words, rows_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    got, want = QUERIES[name](spark, SF_DIR).toPandas(), connect(SF_DIR).execute(ORACLES[name]).df()
    note = difference(got, want)
    assert all(": type" in n for n in note.split("; ")) if note else True  # a column of nulls has no type in pandas


def test_suffix_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = QUERIES["op4_suffix_dedup"](spark, SF_DIR)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(rows, 200)


def test_every_query_returns_its_whole_table(spark):
    for name, table in {"op5_lattice": "embeddings", "op7_bpe": "documents", "op8_simhash": "documents"}.items():
        assert QUERIES[name](spark, SF_DIR).count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    items = [plain_words(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, steps[-1], SF_DIR).write.parquet(str(tmp_path / name))
        steps.append(spark.read.parquet(str(tmp_path / name)))
    assert all(s.columns == docs.columns for s in steps[:-1])
    before, good, cut, distinct, clean, tokens = ({r.doc_id: r for r in s.collect()} for s in steps)
    judged = [i for i in labels if i in before]
    assert sum((i in good) == bool(labels[i]) for i in judged) >= 0.95 * len(judged)
    assert {i: r.text for i, r in cut.items()} == {d: k.decode() for d, _, _, k in brute_lines([(i, r.text) for i, r in good.items()])}
    prints = {i: brute_print(r.text) for i, r in cut.items()}
    low = dict(zip(prints, prints, strict=True))
    for _ in range(5):
        low = {i: min(low[j] for j in prints if (prints[i] ^ prints[j]).bit_count() <= 2) for i in prints}
    assert set(distinct) == set(low.values())
    shingles = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    leaks = [shingles(w) for w in items]
    held = {i: shingles(plain_words(r.text)) for i, r in distinct.items()}
    assert set(clean) == {i for i, s in held.items() if not any(x and len(x & s) >= 0.8 * len(x) for x in leaks)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(corpus_pipeline.VOCABULARY), special_tokens={})
    assert {i: hashlib.md5(bytes(r.ids)).digest() for i, r in tokens.items()} == {i: hashlib.md5(np.array(encoding.encode_ordinary(r.text), "<u4").tobytes()).digest() for i, r in clean.items()}


def pipeline_tables(spark, folder, rows):
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    marks = [(d, 1, 0) for d, _ in rows if d is not None]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, rows[35][1]), (2, None), (3, "")] if rows else []
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def test_pipeline_of_an_empty_table(spark, tmp_path):
    pipeline_tables(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_keep_clashing_columns_nulls_and_repeats(spark, tmp_path):
    pipeline_tables(spark, tmp_path, corpus())
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        held = spark.read.parquet(str(tmp_path / name))
        assert held.columns == docs.columns and 0 < held.count() <= docs.count()
        assert held.where("key <> 'k' or keep <> 1 or spans <> 's' or m <> 2").count() == 0
        docs = held
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()
