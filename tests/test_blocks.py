"""Blocks of dense search: bounds instead of a sort of all pairs, and one copy of a query for each block, not for each cell."""

import numpy as np
import pandas as pd
import pytest

from riskweave.operators import retrieval, vector_index
from riskweave.sources.shared import fresh_path


def sides(n, m, size=6, seed=1, grid=True):
    """Vectors of few different numbers, so that many similarities are equal, or of any."""
    rng = np.random.default_rng(seed)
    draw = lambda k: rng.integers(-1, 2, (k, size)).astype(float) if grid else rng.normal(size=(k, size))
    q = pd.DataFrame({"query_id": np.arange(n), "query_no": np.arange(n) * 7, "embedding": list(draw(n))})
    return q, pd.DataFrame({"passage_id": rng.permutation(m), "embedding": list(draw(m))})


def brute(q, c, k, skip_same, met=None, cell=None):
    sims = np.round(retrieval.unit_rows(q["embedding"]) @ retrieval.unit_rows(c["embedding"]).T, 9)
    found = []
    for i in range(len(q)):
        can = [(-sims[i, j], c["passage_id"][j]) for j in range(len(c)) if not (skip_same and c["passage_id"][j] == q["query_id"][i]) and (met is None or met[i, cell[j]])]
        found += [(q["query_id"][i], q["query_no"][i], p, round(-s, 9)) for s, p in sorted(can)[:k]]
    return found


def rows(found):
    return [(r.query_id, r.query_no, r.passage_id, round(r.similarity, 9)) for r in found.itertuples()]


@pytest.mark.parametrize("grid", [True, False])
@pytest.mark.parametrize("skip", [True, False])
@pytest.mark.parametrize("tile", [1, 64 << 20])
def test_best_of_two_blocks(monkeypatch, grid, skip, tile):
    q, c = sides(40, 700, grid=grid)
    monkeypatch.setattr(retrieval, "_STRIP", 150)
    assert rows(retrieval.blocks_best(q, c, 4, skip, tile)) == brute(q, c, 4, skip)
    few = c.head(3).reset_index(drop=True)
    assert rows(retrieval.blocks_best(q, few, 4, skip, tile)) == brute(q, few, 4, skip)


def test_strips_that_a_query_does_not_meet():
    q, c = sides(30, 400)
    starts = np.array([0, 3, 90, 91, 250])
    cell = np.searchsorted(starts, np.arange(400), "right") - 1
    met = np.random.default_rng(2).random((30, 5)) < 0.4
    assert rows(retrieval.blocks_best(q, c, 5, True, starts=starts, met=met)) == brute(q, c, 5, True, met, cell)


def test_few_pairs_are_worked_out_in_double(monkeypatch):
    q, c = sides(200, 8000, 32, grid=False)
    pairs, exact = [], retrieval._exact_best
    monkeypatch.setattr(retrieval, "_exact_best", lambda a, p, o, row, *rest: pairs.append(len(row)) or exact(a, p, o, row, *rest))
    assert len(retrieval.blocks_best(q, c, 10, False)) == 2000
    assert sum(pairs) < 200 * 8000 // 100


def test_vectors_that_are_not_finite_take_no_place():
    q, c = sides(5, 50, grid=False)
    c.at[7, "embedding"], q.at[2, "embedding"] = np.full(6, np.nan), np.full(6, np.inf)
    found = rows(retrieval.blocks_best(q, c, 4, False))
    kept = c.drop(7).reset_index(drop=True)
    assert found == brute(q.drop(2).reset_index(drop=True), kept, 4, False)


def test_cells_share_blocks_and_crowded_ones_have_several():
    first, many = vector_index._blocks_of_cells({0: 5, 1: 6, 3: 45, 4: 4, 5: 3}, 7, 6)  # at most 11 rows
    assert first.tolist() == [0, 0, -1, 1, 6, 6, -1] and many.tolist() == [1, 1, 0, 5, 1, 1, 0]


@pytest.fixture(scope="module")
def both(spark):
    rng = np.random.default_rng(3)
    vectors = [[float(x) for x in v] for v in rng.normal(size=(600, 8))]
    vectors += [[float(x) for x in v] for v in vectors[0] + rng.normal(size=(150, 8)) / 50]  # a crowded cell
    corpus = spark.createDataFrame(list(enumerate(vectors)), "passage_id long, embedding array<float>")
    return corpus.withColumnRenamed("passage_id", "query_id"), vector_index.build_index(corpus, fresh_path(spark, "index"), cells=20)


def test_a_query_is_copied_once_for_each_block(spark, both):
    """It probes 15 of 20 cells, which are in three blocks."""
    asked, index = both
    sizes = {r["cell"]: r["count"] for r in vector_index._held(spark, index).groupBy("cell").count().collect()}
    first, many = vector_index._blocks_of_cells(sizes, 20, 3)
    copies = vector_index._to_blocks(asked, index.centroids, 15, first, many)
    assert copies.count() <= int((first + many).max()) * asked.count() < 15 * asked.count()
    probed = {(r["query_id"], r["cell"]) for r in vector_index._with_cells(asked, index.centroids, 15).collect()}
    met = set()
    for r in copies.collect():
        held = [c for c in sizes if first[c] <= r["cb"] < first[c] + many[c]]
        bits = np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8))
        met |= {(r["query_id"], c) for c in held if bits[c - min(held) // 8 * 8]}
    assert met == probed


@pytest.mark.parametrize("probes", [1, 3, 20])
def test_blocks_do_not_change_what_is_found(spark, both, probes):
    asked, index = both
    hits = lambda df: sorted((r["query_id"], r["rank"], r["passage_id"], round(r["similarity"], 8)) for r in df.collect())
    found = hits(vector_index.ann_topk(asked, index, 5, probes, True))
    assert hits(vector_index.ann_topk(asked, index, 5, probes, True, block_rows=40)) == found
    if probes == 20:
        assert found == hits(retrieval.cosine_topk(asked, asked.withColumnRenamed("query_id", "passage_id"), 5, True))
