import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskweave.operators import grounding, pruned
from riskweave.sources.shared import fresh_path


def frame(spark, texts, key):
    return spark.createDataFrame(list(texts.items()), f"{key} long, text string").repartition(3)


def corpus(passages, words=2000, common="policy", seed=3):
    """Every passage holds ``common``, and words of which some are frequent."""
    rng = random.Random(seed)
    pick = lambda: f"w{min(rng.randrange(words), rng.randrange(words))}"
    return {i: " ".join([common] * rng.randint(1, 3) + [pick() for _ in range(rng.randint(3, 12))]) for i in range(passages)}


def asked(texts, n=60, seed=4):
    rng = random.Random(seed)
    out = {i: " ".join(rng.sample(texts[rng.randrange(len(texts))].split(), 4) + ["policy", f"w{rng.randrange(50)}"]) for i in range(n)}
    return {**out, 900: "policy", 901: "unknown words", 902: "", 903: None, 904: "policy w1 w1 w1 w2 w3"}


def rows(df):
    return {(r["qid"], r["rank"]): (r["passage_id"], round(r["similarity"], 8)) for r in df.collect()}


@pytest.fixture(scope="module")
def both(spark):
    texts = corpus(4000)
    held, queries = frame(spark, texts, "pid"), frame(spark, asked(texts), "qid")
    return held, queries, pruned.write_index(held, "pid", "text", fresh_path(spark, "pruned"))


@pytest.mark.parametrize("k", [2, 10])
def test_same_rows_as_the_full_join(spark, both, k):
    held, queries, index = both
    full = grounding.write_index(held, "pid", "text", fresh_path(spark, "index"))
    assert rows(pruned.top_passages(queries, "qid", "text", index, k)) == rows(grounding.top_passages(queries, "qid", "text", full, k))
    scores = {r["qid"]: r["grounding"] for r in pruned.grounding_scores(queries, "qid", "text", index, k).collect()}
    want = {r["qid"]: r["grounding"] for r in grounding.grounding_scores(queries, "qid", "text", full, k).collect()}
    assert scores == pytest.approx(want, abs=1e-9)


def test_a_tenth_of_the_postings_is_read(spark, both):
    """One word is in every passage; queries that hold nothing else still read it."""
    _, queries, index = both
    queries = queries.where("qid < 900")
    terms = pruned.query_terms(queries, "qid", "text", index, 2)
    postings = pruned.read_postings(terms, "qid", index)
    every = terms.join(index.table("terms").select("term", "df"), "term").agg(F.sum("df")).first()[0]
    read, scored = postings.count(), pruned.candidates(terms, postings, "qid").count()
    assert (read + scored) * 10 <= every and postings.where("term = 'policy'").count() == 0


def test_cutoffs_stay_under_the_floor(spark, both):
    _, queries, index = both
    spent = pruned.query_terms(queries, "qid", "text", index, 3).groupBy("qid").agg(F.sum(F.col("x") * F.col("cut")).alias("s"), F.max("floor").alias("f"))
    assert spent.where("s > f + 1e-9").count() == 0 and spent.where("f > 0").count() > 50


def test_blocks_are_bounded_and_hold_every_posting(spark, both):
    held, _, index = both
    blocks, weights = index.table("blocks"), index.table("weights")
    sizes = blocks.select("term", F.size("postings").alias("n"), (F.col("most") >= F.array_max(F.transform("postings", lambda p: p["weight"]))).alias("capped"))
    assert sizes.agg(F.sum("n")).first()[0] == weights.count() and sizes.where("not capped").count() == 0
    assert sizes.agg(F.max("n")).first()[0] <= 1.3 * pruned._BLOCK
    assert blocks.where("term = 'policy'").select("block").distinct().count() == 4
    heads = index.table("heads").where("term = 'policy'")
    assert heads.count() == pruned._HEAD
    worst = heads.agg(F.min("weight")).first()[0]
    assert weights.where(F.col("term") == "policy").where(F.col("weight") > worst).count() < pruned._HEAD


def test_small_and_empty_corpora(spark):
    texts = {7: "income income loan", 3: None, 5: "the a of", 9: "income"}
    queries = frame(spark, {1: "income", 2: "nothing", 3: "loan income", 4: None}, "qid")
    for held in (frame(spark, texts, "pid"), frame(spark, {9: "income"}, "pid"), frame(spark, {}, "pid")):
        index = pruned.write_index(held, "pid", "text", fresh_path(spark, "pruned"))
        full = grounding.write_index(held, "pid", "text", fresh_path(spark, "index"))
        assert rows(pruned.top_passages(queries, "qid", "text", index)) == rows(grounding.top_passages(queries, "qid", "text", full))
        assert pruned.open_index(spark, index.path).passages == index.passages == held.where("text is not null").count()
    assert pruned.grounding_scores(queries, "qid", "text", index).where("grounding <> 0").count() == 0


def test_plan_reads_blocks_by_term_and_level(spark, both):
    _, queries, index = both
    plan = pruned.top_passages(queries, "qid", "text", index)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan


def test_query_terms_are_worked_out_once(spark, both, monkeypatch):
    _, queries, index = both
    seen, read = [], pruned.read_postings
    monkeypatch.setattr(pruned, "read_postings", lambda terms, *rest: seen.append(terms) or read(terms, *rest))
    assert pruned.top_passages(queries, "qid", "text", index, 2).count() > 0
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Window" not in plan


def test_the_index_is_small_beside_its_postings(spark, both):
    """A posting holds neither its term, nor the name of its passage, nor its weight."""
    _, _, index = both
    stored = sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(index.path) for f in files if f.endswith(".parquet"))
    assert stored < 16 * index.table("weights").count()


def test_few_passages_are_scored(spark, both):
    """Passages scored in full give a floor that few others reach."""
    _, queries, index = both
    terms = pruned.query_terms(queries.where("qid < 60"), "qid", "text", index, 2)
    assert pruned.candidates(terms, pruned.read_postings(terms, "qid", index), "qid").count() <= 60 * 20


def test_many_segments_and_repeated_ids(spark, monkeypatch):
    """Segments are cut after few words; rows with one id are passages of their own, of which the best counts."""
    texts = corpus(300, words=100)
    held, queries = frame(spark, texts, "pid"), frame(spark, asked(texts, 20), "qid")
    full = grounding.write_index(held, "pid", "text", fresh_path(spark, "index"))
    monkeypatch.setattr(pruned, "_WORDS", 400)
    index = pruned.write_index(held, "pid", "text", fresh_path(spark, "pruned"))
    assert index.table("passages").select(F.shiftright("number", pruned._PLACE_BITS)).distinct().count() > 6
    assert rows(pruned.top_passages(queries, "qid", "text", index)) == rows(grounding.top_passages(queries, "qid", "text", full))
    twice = pruned.write_index(frame(spark, {1: "income loan", 2: "rate"}, "pid").unionByName(frame(spark, {1: "income"}, "pid")), "pid", "text", fresh_path(spark, "twice"))
    best = rows(pruned.top_passages(frame(spark, {5: "income"}, "qid"), "qid", "text", twice, 1))
    assert best == {(5, 1): (1, 1.0)} and twice.passages == 3


def test_segments_are_bounded():
    lists = [["a"] * n for n in (3, 3, 9, 1, 0, 0, 2, 2)]
    batches = [pa.record_batch([pa.array(lists[i : i + 3], pa.list_(pa.string()))], ["words"]) for i in (0, 3, 6)]
    cut = [[len(x) for b in held for x in b.column("words").to_pylist()] for held in pruned._segments(iter(batches), 3, 6)]
    assert cut == [[3, 3], [9], [1, 0, 0], [2, 2]]
