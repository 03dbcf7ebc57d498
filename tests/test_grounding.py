import math
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.functions import fixed
from riskweave.operators import governance, grounding, retrieval
from riskweave.sources.shared import fresh_path

POLICY = {1: "Income must support the loan duration, income first", 2: "Loan officers verify income documents", 3: "Âge and naïve limits apply to credit"}
TEXTS = {10: "the loan duration and the INCOME of the applicant", 11: "nothing in common", 12: "", 13: "naïve credit naïve limits âge"}


def words(text):
    return [w for w in re.findall(r"\w\w+", text.lower())]


def plain_scores(policy, texts, k=2):
    docs = {i: Counter(w for w in words(t) if w not in fixed.STOP_WORDS) for i, t in policy.items()}
    df = Counter(w for c in docs.values() for w in c)
    idf = {w: math.log((1 + len(docs)) / (1 + n)) + 1 for w, n in df.items()}

    def unit(counts):
        v = {w: n * idf[w] for w, n in counts.items() if w in idf}
        length = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / length for w, x in v.items()} if length else {}

    vectors = [unit(c) for c in docs.values()]
    out = {}
    for i, t in texts.items():
        q = unit(Counter(words(t)))
        sims = sorted(sum(q[w] * v.get(w, 0) for w in q) for v in vectors)[-k:]
        out[i] = sum(sims) / len(sims)
    return out


def frame(spark, texts, key):
    return spark.createDataFrame(list(texts.items()), f"{key} long, text string")


@pytest.mark.parametrize("policy", [POLICY, {1: POLICY[1]}])
def test_grounding_equals_plain_tfidf(spark, policy):
    index = grounding.write_index(frame(spark, policy, "pid"), "pid", "text", fresh_path(spark, "index"))
    got = grounding.grounding_scores(frame(spark, TEXTS, "tid"), "tid", "text", index).collect()
    assert len(got) == len(TEXTS)
    for tid, score in plain_scores(policy, TEXTS).items():
        assert {r["tid"]: r["grounding"] for r in got}[tid] == pytest.approx(score)


def test_term_counts_inside_the_row(spark):
    rows = grounding.term_rows(frame(spark, {1: "bb aa bb x aa bb", 2: "", 3: "x y"}, "id"), "id", "text").collect()
    assert {(r["id"], r["term"], r["tf"]) for r in rows} == {(1, "aa", 2.0), (1, "bb", 3.0)}


def test_top_passages_are_ranked(spark):
    index = grounding.write_index(frame(spark, POLICY, "pid"), "pid", "text", fresh_path(spark, "index"))
    hits = grounding.top_passages(frame(spark, TEXTS, "tid"), "tid", "text", index).where("tid = 10").orderBy("rank").collect()
    assert [h["passage_id"] for h in hits] == [1, 2] and hits[0]["similarity"] > hits[1]["similarity"]


def vectors(spark, array, key):
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(array)]
    return spark.createDataFrame(rows, f"{key} long, embedding array<double>")


@pytest.mark.parametrize("tile", [64 << 20, 1])
@pytest.mark.parametrize("skip", [False, True])
def test_cosine_search_equals_brute_force(spark, tile, skip):
    rng = np.random.default_rng(4)
    q, c = rng.normal(size=(37, 6)), rng.normal(size=(53, 6))
    c[5] = c[9] = q[3]
    c[7] = 0
    got = retrieval.cosine_topk(
        vectors(spark, q, "query_id"), vectors(spark, c, "passage_id"), 3, skip, block_rows=11, tile_bytes=tile
    ).collect()
    length = np.linalg.norm(c, axis=1)
    sims = np.round((q @ c.T) / (np.linalg.norm(q, axis=1)[:, None] * np.where(length == 0, 1, length)), 9)
    expected = set()
    for i, row in enumerate(sims):
        order = [j for j in sorted(range(len(row)), key=lambda j: (-row[j], j)) if not (skip and i == j)]
        expected |= {(i, j, r + 1) for r, j in enumerate(order[:3])}
    assert {(r["query_id"], r["passage_id"], r["rank"]) for r in got} == expected


@pytest.mark.parametrize("block_rows", [20_000, 2])
def test_cosine_search_with_repeated_ids_and_missing_vectors(spark, block_rows):
    q = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, None), (3, [None, 1.0])], "query_id long, embedding array<double>")
    c = spark.createDataFrame([(7, [1.0, 0.1]), (8, [0.1, 1.0]), (9, None), (8, [1.0, 1.0])], "passage_id long, embedding array<double>")
    got = retrieval.cosine_topk(q, c, 2, block_rows=block_rows).collect()
    assert sorted((r["query_id"], r["passage_id"], r["rank"]) for r in got) == [(1, 7, 1), (1, 8, 1), (1, 8, 2), (1, 8, 2)]


def test_empty_corpus_gives_no_hits(spark):
    q = vectors(spark, [[1.0, 2.0]], "query_id")
    assert retrieval.cosine_topk(q, vectors(spark, [[1.0]], "passage_id").where("false")).count() == 0


def test_context_prompt_and_clearance(spark):
    hits = spark.createDataFrame([(1, 8, 2), (1, 9, 1)], "query_id int, passage_id int, rank int")
    passages = retrieval.corpus_passages(spark.createDataFrame([(8, "second passage"), (9, "first passage"), (7, " short    ")], "paragraph_id int, text string"))
    assert passages.count() == 2
    context = retrieval.context_blocks(hits, passages)
    assert context.first()["context_text"] == "POLICY MODULE 1:\nfirst passage\n\nPOLICY MODULE 2:\nsecond passage\n\n"
    prompt = retrieval.prompt_rows(context.withColumn("e", F.lit("why")), "e", "context_text").first()["prompt"]
    assert '"why"' in prompt and "first passage" in prompt
    texts = spark.createDataFrame([("x [grounded] y",), ("[Partially Grounded]",), ("[UNSUPPORTED]",), ("",)], "v string")
    assert [r[0] for r in texts.select(retrieval.clearance(F.col("v"))).collect()] == [
        fixed.CLEARANCE_GRANTED, fixed.CLEARANCE_MANUAL, fixed.CLEARANCE_BLOCKED, fixed.CLEARANCE_BLOCKED]
    verdicts = spark.createDataFrame([(0.29,), (0.3,), (0.5,)], "g double").select(retrieval.rule_verdict(F.col("g"))).collect()
    assert [r[0] for r in verdicts] == [fixed.VERDICT_UNSUPPORTED, fixed.VERDICT_PARTIAL, fixed.VERDICT_GROUNDED]


def test_keywords_inside_words_and_as_words(spark):
    df = spark.createDataFrame([("High IMPACT factor",), ("an Act of the Reserve Bank",), ("nothing",)], "t string")
    loose = [r[0] for r in df.select(governance.compliance_hits(F.col("t"))).collect()]
    strict = [r[0] for r in df.select(governance.compliance_hits(F.col("t"), whole_word=True)).collect()]
    assert loose == [["act"], ["reserve bank", "act"], []] and strict == [[], ["reserve bank", "act"], []]


def test_cost_records(spark):
    df = spark.createDataFrame(
        [(1, 0.1, 0.9, "legal claim"), (2, 0.1, 0.5, "no claim"), (3, 0.3, 0.2, "legal"), (4, 0.5, 0.1, "legal")],
        "applicant_id int, g double, risk double, text string",
    )
    rows = governance.cost_records(df, "g", "text", "risk", F.lit("now")).orderBy("applicant_id").collect()
    assert [r["impact_band"] for r in rows] == ["VERY HIGH", "HIGH", "MEDIUM", "LOW"]
    assert [r["review_flag"] for r in rows] == [fixed.REVIEW_FLAGS[r["impact_band"]] for r in rows]
    assert rows[0]["compliance_claims_detected"] == "legal" and rows[1]["compliance_claims_detected"] == "None"
    assert rows[0]["hallucination_risk"] == 0.9
    unknown = spark.createDataFrame(pd.DataFrame({"b": ["?"]})).select(governance.exposure(F.col("b"))).first()[0]
    assert unknown == "Unknown"


def test_a_passage_of_stop_words_counts_and_every_query_gets_k(spark):
    from riskweave.functions import fixed

    policy = {1: "income limits apply", 2: " ".join(fixed.STOP_WORDS[:3] if isinstance(fixed.STOP_WORDS, (list, tuple)) else sorted(fixed.STOP_WORDS)[:3]), 3: None}
    path = fresh_path(spark, "index")
    for _ in range(2):  # writing again replaces
        index = grounding.write_index(frame(spark, policy, "pid"), "pid", "text", path)
    queries = frame(spark, {10: "income limits apply", 11: "nothing known", 12: None}, "tid")
    scores = {r["tid"]: r["grounding"] for r in grounding.grounding_scores(queries, "tid", "text", index).collect()}
    assert scores == {10: pytest.approx(0.5), 11: 0.0, 12: 0.0}
    hits = grounding.top_passages(queries, "tid", "text", index).collect()
    assert sorted((h["tid"], h["rank"], h["passage_id"], round(h["similarity"], 6)) for h in hits) == [
        (t, r, p, 1.0 if (t, p) == (10, 1) else 0.0) for t in (10, 11, 12) for r, p in ((1, 1), (2, 2))
    ]
