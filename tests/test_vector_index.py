import tracemalloc

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.operators import retrieval, vector_index
from riskweave.sources.shared import fresh_path


def frame(spark, ids, vectors, key):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, f"{key} long, embedding array<float>").repartition(3)


def clustered(seed=1, groups=20, each=40, size=16):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(groups, size)) * 3
    return (centers[:, None] + rng.normal(size=(groups, each, size)) * 0.4).reshape(-1, size)


def hits(df):
    return sorted((r["query_id"], r["rank"], r["passage_id"], round(r["similarity"], 8)) for r in df.collect())


@pytest.fixture(scope="module")
def both(spark):
    vectors = clustered()
    return frame(spark, range(len(vectors)), vectors, "query_id"), frame(spark, range(len(vectors)), vectors, "passage_id")


@pytest.fixture(scope="module")
def index(spark, both):
    return vector_index.build_index(both[1], fresh_path(spark, "index"), cells=20)


def test_all_cells_probed_equal_the_exact_search(spark, both, index):
    found = vector_index.ann_topk(both[0], index, 5, probes=1000, skip_same_id=True)
    assert hits(found) == hits(retrieval.cosine_topk(*both, 5, True))


def test_few_probes_find_clustered_neighbours_and_read_few_rows(spark, both, index):
    exact = retrieval.cosine_topk(*both, 10, True)
    probes = vector_index.choose_probes(both[0], index, 10, 0.97, True)
    assert probes <= 4
    got = vector_index.recall_of(vector_index.ann_topk(both[0], index, 10, probes, True), exact).first()
    assert (got["queries"], got["wanted"]) == (800, 8000) and got["recall"] >= 0.95
    probed = vector_index._with_cells(both[0].where("query_id % 20 = 0"), index.centroids, probes)
    read = probed.join(vector_index._held(spark, index).groupBy("cell").count(), "cell").agg(F.sum("count")).first()[0]
    assert read <= 40 * 800 / 4


def test_recall_by_probes_counts_reached_hits(spark, both, index):
    curve = {r["probes"]: r["recall"] for r in vector_index.recall_by_probes(both[0], index, 10, True, sample=10_000).collect()}
    exact = retrieval.cosine_topk(*both, 10, True)
    for probes in (1, 2):
        measured = vector_index.recall_of(vector_index.ann_topk(both[0], index, 10, probes, True), exact).first()["recall"]
        assert curve[probes] == pytest.approx(measured, abs=1e-3)
    assert curve[len(index.centroids)] == 1.0 and sorted(curve) == list(range(1, len(index.centroids) + 1))


def test_blocks_of_a_crowded_cell_do_not_change_the_result(spark):
    vectors = clustered(2, 6, 30)
    vectors[60:] = vectors[60]  # two thirds are one vector: its cell is cut on both sides
    asked, held = (frame(spark, range(len(vectors)), vectors, key) for key in ("query_id", "passage_id"))
    index = vector_index.build_index(held, fresh_path(spark, "index"), cells=5)
    whole = vector_index.ann_topk(asked, index, 4, 2)
    assert hits(vector_index.ann_topk(asked, index, 4, 2, block_rows=17)) == hits(whole)
    # equal vectors are ranked by id, so the first ids of the group are the hits of all its members
    assert {r["passage_id"] for r in whole.where("query_id >= 60").collect()} == {60, 61, 62, 63}


def test_added_vectors_are_found_and_the_index_opens_again(spark, both, index):
    path = fresh_path(spark, "index")
    old = vector_index.build_index(both[1].where("passage_id < 700"), path, cells=20)
    vector_index.add_vectors(vector_index.open_index(spark, path), both[1].where("passage_id >= 700"))
    again = vector_index.open_index(spark, path)
    assert np.array_equal(again.centroids, old.centroids)
    assert vector_index._held(spark, again).count() == 800
    found = vector_index.ann_topk(both[0].where("query_id >= 700"), again, 1, 1)
    assert {(r["query_id"], r["passage_id"]) for r in found.collect()} == {(i, i) for i in range(700, 800)}


def test_nulls_other_sizes_zeros_repeats_and_nothing(spark):
    vectors = [[1, 0, 0], [0.9, 0.1, 0], None, [1, None, 0], [1, 0], [float("nan"), 0, 0], [0, 0, 0], [0, 0, 1], [float("inf"), 0, 0]]
    ids = [1, 2, 3, 4, 5, 6, 7, None, 9]
    asked = frame(spark, [*ids, 1], [*vectors, vectors[0]], "query_id")
    index = vector_index.build_index(frame(spark, ids, vectors, "passage_id").where("passage_id is null or passage_id <> 5"), fresh_path(spark, "index"), cells=2)
    got = hits(vector_index.ann_topk(asked.where("query_id = 1"), index, 2, 9))
    assert [(q, r, p) for q, r, p, _ in got] == [(1, 1, 1), (1, 2, 2)]
    answered = {r["query_id"] for r in vector_index.ann_topk(asked, index, 2, 9).collect()}
    assert answered == {1, 2, 7, None}
    empty = vector_index.build_index(frame(spark, [], [], "passage_id"), fresh_path(spark, "index"))
    assert vector_index.ann_topk(asked, empty).count() == 0 and vector_index.choose_probes(asked, empty) == 1
    assert vector_index.ann_topk(frame(spark, [], [], "query_id"), index).count() == 0


def test_centroids_are_fitted_on_a_bounded_sample(spark):
    vectors = clustered(3, 4, 500, 8)
    few = vector_index.fit_centroids(frame(spark, range(len(vectors)), vectors, "passage_id"), cells=4, sample_rows=200)
    assert few.shape == (4, 8) and np.allclose(np.linalg.norm(few, axis=1), 1)


def test_search_has_no_cross_join_and_prunes_cells(spark, both, index):
    plan = vector_index.ann_topk(both[0], index, 5, 2)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "FlatMapCoGroupsInPandas" in plan or "FlatMapCoGroupsInArrow" in plan


def test_rows_are_not_copied_in_python(spark, both, index, monkeypatch):
    """Python names the cells of a row, and slices do not change them; what is copied for each cell is copied by Spark."""
    rows = both[0].select("query_id", "embedding")
    placed = vector_index._with_cells(rows, index.centroids, 3)
    whole = sorted((r["query_id"], r["probe"], r["cell"]) for r in placed.select("query_id", "probe", "cell").collect())
    assert "Generate" in placed._jdf.queryExecution().optimizedPlan().toString()
    assert len(whole) == 3 * rows.count() and {p for _, p, _ in whole} == {0, 1, 2}
    monkeypatch.setattr(vector_index, "_SLICE_BYTES", 1)
    few = vector_index._with_cells(rows, index.centroids, 3).select("query_id", "probe", "cell")
    assert sorted((r["query_id"], r["probe"], r["cell"]) for r in few.collect()) == whole


def test_a_tile_and_its_copies_stay_within_their_bytes():
    rng = np.random.default_rng(0)
    block = lambda key, n: pd.DataFrame({key: np.arange(n), "query_no": np.arange(n), "embedding": list(rng.normal(size=(n, 8)))})
    asked, held = block("query_id", 1500), block("passage_id", 20_000)
    tracemalloc.start()
    found = retrieval.blocks_best(asked, held, 3, False, 32 << 20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 3 * 1500 and peak < 1.3 * (32 << 20)
