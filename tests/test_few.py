"""An index of few passages goes to the queries: the same rows as by joins, without a shuffle of terms."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from riskweave.operators import grounding, pruned
from riskweave.sources.shared import fresh_path


def frame(spark, rows, key):
    return spark.createDataFrame(rows, f"{key} long, text string").repartition(3)


def words(rng, n, most):
    return " ".join(f"w{int(most * rng.random() ** 3)}" for _ in range(n))


@pytest.fixture(scope="module")
def both(spark):
    """Long texts of few different words as queries, over passages of which many share each common word."""
    rng = random.Random(5)
    passages = [(i, " ".join(["policy"] * rng.randint(1, 3)) + " " + words(rng, rng.randint(2, 25), 90)) for i in range(700)]
    passages += [(1000, passages[3][1]), (1001, "the of"), (1002, ""), (1003, None)]
    texts = [(i, words(rng, rng.randint(1, 120), 200)) for i in range(80)] + [(900, "policy"), (901, "nothing here"), (902, ""), (903, None)]
    held = frame(spark, passages, "pid")
    return held, frame(spark, texts, "qid"), pruned.write_index(held, "pid", "text", fresh_path(spark, "pruned"))


def rows(df):
    return sorted((r["qid"] is None, r["qid"], r["rank"], r["passage_id"], round(r["similarity"], 8)) for r in df.collect())


@pytest.mark.parametrize("k", [1, 2, 10])
def test_same_rows_as_both_joins(spark, both, k):
    held, queries, index = both
    assert pruned._few(index) is not None
    got = rows(pruned.top_passages(queries, "qid", "text", index, k))
    full = grounding.write_index(held, "pid", "text", fresh_path(spark, "index"))
    assert got == rows(grounding.top_passages(queries, "qid", "text", full, k))
    assert got == rows(pruned._top_of_join(queries, "qid", "text", index, k, pruned.fixed.TOKEN_PATTERN))


def test_tiles_do_not_change_rows(both, monkeypatch):
    _, queries, index = both
    few = pruned._few(index)
    split = pa.array([r["w"] for r in queries.select(pruned.tx.tokens(F.col("text")).alias("w")).collect()], pa.list_(pa.string()))
    places, similar = few.best(split, 3)
    monkeypatch.setattr(pruned, "_TILE", 1)
    again, same = few.best(split, 3)
    assert np.array_equal(places, again) and np.allclose(similar, same, atol=1e-12)


def test_common_terms_are_not_read_to_the_end(both, monkeypatch):
    _, queries, index = both
    few, read = pruned._few(index), []
    sums = pruned._Few.sums
    monkeypatch.setattr(pruned._Few, "sums", lambda self, n, row, term, x, first, last: read.append((first, len(term))) or sums(self, n, row, term, x, first, last))
    split = pa.array([["policy", "w80", "w85"]] * 5)
    places, similar = few.best(split, 1)
    policy = int(np.flatnonzero(np.array(few.terms.to_pylist()) == "policy")[0])
    assert np.diff(few.starts)[policy] == 701 and (similar > 0).all()
    assert sum(n for first, n in read if first) == 0


def test_repeated_and_null_ids_meet_as_in_the_join(spark, both):
    _, _, index = both
    queries = frame(spark, [(1, "w1 w2 policy"), (1, "w3 w4"), (2, "w5"), (2, "w5"), (3, "w6 w7"), (None, "w1"), (None, "w2"), (4, None), (4, "w2")], "qid")
    got = rows(pruned.top_passages(queries, "qid", "text", index, 3).where("qid is not null"))
    assert got == rows(pruned._top_of_join(queries, "qid", "text", index, 3, pruned.fixed.TOKEN_PATTERN).where("qid is not null"))
    assert pruned.top_passages(queries, "qid", "text", index, 3).where("qid is null").count() == 3
    assert pruned.grounding_scores(queries, "qid", "text", index).count() == queries.count()


def test_passages_that_share_an_id_and_many_passages_take_the_join(spark, monkeypatch):
    queries = frame(spark, [(1, "loan income"), (2, "rate")], "qid")
    index = pruned.write_index(frame(spark, [(1, "loan"), (1, "income loan"), (2, "rate rate loan")], "pid"), "pid", "text", fresh_path(spark, "pruned"))
    assert pruned._few(index) is None and pruned.top_passages(queries, "qid", "text", index).count() == 4
    index = pruned.write_index(frame(spark, [(1, "loan"), (2, "income loan"), (3, "rate rate loan")], "pid"), "pid", "text", fresh_path(spark, "pruned"))
    few = rows(pruned.top_passages(queries, "qid", "text", index))
    monkeypatch.setattr(pruned, "_FEW", 2)
    assert pruned._few(index) is None and rows(pruned.top_passages(queries, "qid", "text", index)) == few


def test_no_term_and_no_posting_is_shuffled(spark, both, monkeypatch):
    """Queries are read once and stored with their best passages; the join is not asked."""
    _, queries, index = both
    monkeypatch.setattr(pruned, "read_postings", None)
    plan = pruned.top_passages(queries, "qid", "text", index)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_grounding_averages_over_few_passages(spark, both):
    held, queries, index = both
    full = grounding.write_index(held, "pid", "text", fresh_path(spark, "index"))
    scores = {r["qid"]: r["grounding"] for r in pruned.grounding_scores(queries, "qid", "text", index, 3).collect()}
    want = {r["qid"]: r["grounding"] for r in grounding.grounding_scores(queries, "qid", "text", full, 3).collect()}
    assert scores == pytest.approx(want, abs=1e-9)


def test_grounding_shuffles_no_terms(spark, both, monkeypatch):
    _, queries, index = both
    monkeypatch.setattr(pruned, "read_postings", None)
    assert pruned.grounding_scores(queries, "qid", "text", index).count() == queries.count()
