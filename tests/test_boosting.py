import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave.operators import attribution, boosting
from riskweave.sources.shared import fresh_path

FEATURES = ["a", "b", "c"]
PARAMS = {"rounds": 4, "depth": 3, "step": 0.3, "l2": 1.5, "bins": 16, "least_hessian": 0.5}


def table(n=300, seed=5):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        a = None if rng.random() < 0.3 else rng.choice([rng.gauss(0, 1), float(rng.randint(-2, 2))])
        b = float("nan") if rng.random() < 0.1 else rng.randint(0, 5) * 1.0
        c = rng.gauss(0, 3)
        odds = (1.2 if a is None else a) + (0.5 if b == b and b > 3 else -0.5) + 0.2 * c
        rows.append((k, a, b, c, None if rng.random() < 0.03 else int(rng.random() < 1 / (1 + math.exp(-odds)))))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y int").repartition(3)


def matrix(rows):
    return np.array([[np.nan if v is None else v for v in r[1:4]] for r in rows], dtype=float)


def brute_fit(rows, params, lift):
    """Margins by trying every edge and side at every node, on the rows themselves."""
    rows = [r for r in rows if r[4] is not None]
    x, y = matrix(rows), np.array([r[4] for r in rows], dtype=float)
    edges = []
    for f in range(x.shape[1]):
        v = np.sort(x[~np.isnan(x[:, f]), f])
        edges.append(sorted({v[max(math.ceil(k / params["bins"] * len(v)) - 1, 0)] for k in range(1, params["bins"] + 1)})[:-1] if len(v) else [])
    w, margin, l2 = np.where(y == 1, lift, 1.0), np.zeros(len(y)), params["l2"]
    for _ in range(params["rounds"]):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        worth = lambda i: g[i].sum() ** 2 / (h[i].sum() + l2)  # noqa: E731, B023
        nodes = [np.ones(len(y), bool)]
        for _ in range(params["depth"]):
            grown = []
            for node in nodes:
                best = (1e-9, None)
                for f in range(x.shape[1]):
                    for cut, missing in itertools.product([*edges[f], np.inf], (True, False)):
                        left = node & np.where(np.isnan(x[:, f]), missing, x[:, f] <= cut)
                        right = node & ~left
                        if min(h[left].sum(), h[right].sum()) < params["least_hessian"] or not right.any():
                            continue
                        gain = (worth(left) + worth(right) - worth(node)) / 2
                        if gain > best[0] + 1e-9 * (1 + abs(best[0])):
                            best = (gain, (left, right))
                grown.extend(best[1] or [node])
            nodes = grown
        for node in nodes:
            margin[node] += -params["step"] * g[node].sum() / (h[node].sum() + l2)
    return {r[0]: m for r, m in zip(rows, margin, strict=True)}


@pytest.fixture(scope="module")
def fitted(spark):
    rows = table()
    return rows, boosting.fit(frame(spark, rows), FEATURES, "y", PARAMS)


def test_margins_equal_a_search_over_rows(spark, fitted):
    rows, model = fitted
    lift = boosting.positive_weight(frame(spark, rows), "y")
    want = brute_fit(rows, PARAMS, lift)
    got = {r["id"]: r["m"] for r in boosting.score(model, frame(spark, rows), "p", "m").collect()}
    assert {i: got[i] for i in want} == pytest.approx(want, abs=1e-9)
    assert len(got) == len(rows) and len(set(want.values())) > 10


def test_missing_values_take_the_learnt_side(fitted):
    _, model = fitted
    sides = {bool(s) for t in model.trees for f, s in zip(t.feature, t.missing_left, strict=True) if f == 0}
    assert sides  # the feature with missing values is used
    with_gap = model.margins(np.array([[np.nan, 1.0, 0.0]]))[0]
    assert all(np.isfinite(with_gap) for _ in [0]) and with_gap > model.margins(np.array([[-1.0, 1.0, 0.0]]))[0]


def test_base_and_attributions_add_up(spark, fitted):
    rows, model = fitted
    scored = boosting.score(model, frame(spark, rows), "p", "m")
    total = sum((F.col(attribution.shap_name(f)) for f in FEATURES), F.col("shap_base"))
    explained = attribution.tree_shap(scored, model, FEATURES)
    assert explained.where(F.abs(total - F.col("m")) > 1e-9).count() == 0


def expected(tree, row, known, node=0):
    f = tree.feature[node]
    if f < 0:
        return tree.value[node]
    left, right = tree.left[node], tree.right[node]
    if f in known:
        goes = tree.missing_left[node] if np.isnan(row[f]) else row[f] <= tree.threshold[node]
        return expected(tree, row, known, left if goes else right)
    total = tree.cover[left] + tree.cover[right]
    return (tree.cover[left] * expected(tree, row, known, left) + tree.cover[right] * expected(tree, row, known, right)) / total


def test_attributions_equal_all_coalitions(spark, fitted):
    rows, model = fitted
    rows = rows[:40]
    got = {r["id"]: [r[attribution.shap_name(f)] for f in FEATURES] for r in attribution.tree_shap(frame(spark, rows), model, FEATURES).collect()}
    for r, x in zip(rows, matrix(rows), strict=True):
        value = lambda s: sum(expected(t, x, set(s)) for t in model.trees)  # noqa: E731, B023
        for f in range(3):
            others = [o for o in range(3) if o != f]
            shap = sum(
                math.factorial(len(s)) * math.factorial(2 - len(s)) / 6 * (value((*s, f)) - value(s))
                for n in range(3) for s in itertools.combinations(others, n)
            )
            assert got[r[0]][f] == pytest.approx(shap, abs=1e-9)


def test_attributions_against_a_background_equal_all_coalitions(spark, fitted):
    rows, model = fitted
    background, asked = rows[50:75], rows[:25]
    got = attribution.interventional_shap(frame(spark, asked), model, frame(spark, background), FEATURES).collect()
    back = matrix(background)
    outputs = model.margins(back)
    for r, x in zip(sorted(got, key=lambda r: r["id"]), matrix(asked), strict=True):
        def value(known):
            mixed = back.copy()
            mixed[:, list(known)] = x[list(known)]  # noqa: B023
            return model.margins(mixed).mean()

        assert r["shap_base"] == pytest.approx(outputs.mean(), abs=1e-9)
        for f in range(3):
            others = [o for o in range(3) if o != f]
            shap = sum(
                math.factorial(len(s)) * math.factorial(2 - len(s)) / 6 * (value((*s, f)) - value(s))
                for n in range(3) for s in itertools.combinations(others, n)
            )
            assert r[attribution.shap_name(FEATURES[f])] == pytest.approx(shap, abs=1e-9)


def test_saved_model_scores_alike(spark, fitted):
    rows, model = fitted
    path = fresh_path(spark, "boosted")
    model.save(spark, path)
    again = boosting.load(spark, path)
    assert np.array_equal(again.margins(matrix(rows)), model.margins(matrix(rows)))
    shares = {r["feature"]: r["importance"] for r in again.importances(spark).collect()}
    assert set(shares) == set(FEATURES) and sum(shares.values()) == pytest.approx(1)


def test_margins_are_stored_between_rounds(spark):
    rows = table(120, 8)
    params = {**PARAMS, "rounds": 2 * boosting._HELD_ROUNDS + 1, "depth": 2}
    want = brute_fit(rows, params, 1.0)
    model = boosting.fit(frame(spark, rows), FEATURES, "y", params, positives=1.0)
    kept = [r for r in rows if r[4] is not None]
    assert dict(zip([r[0] for r in kept], model.margins(matrix(kept)), strict=True)) == pytest.approx(want, abs=1e-9)


def test_constant_absent_and_one_class(spark):
    rows = [(k, 1.0, None, float(k), 1) for k in range(20)]
    model = boosting.fit(frame(spark, rows), FEATURES, "y", {**PARAMS, "l2": 0.0})
    assert all((t.feature < 0).all() for t in model.trees) and model.margins(matrix(rows)).min() > 0
    missing = [(k, None if k % 2 else 1.0, None, 0.0, k % 2) for k in range(20)]
    split = boosting.fit(frame(spark, missing), FEATURES, "y", {**PARAMS, "rounds": 1})
    assert split.trees[0].feature[0] == 0 and np.isinf(split.trees[0].threshold[0]) and not split.trees[0].missing_left[0]
    empty = boosting.fit(frame(spark, []), FEATURES, "y", PARAMS)
    assert empty.trees == () and empty.margins(matrix(rows)).tolist() == [0.0] * 20
    assert boosting.score(empty, frame(spark, rows)).where("score <> 0.5").count() == 0


def test_cells_pay_what_paths_pay(monkeypatch):
    """Rows on, between and beyond the cuts, missing and infinite ones, by cells of several sizes and by the paths themselves."""
    from riskweave.operators import attribution as at

    rng = np.random.default_rng(5)

    def grown(depth):
        nodes = []

        def grow(level):
            at_node = len(nodes)
            nodes.append(None)
            cover = float(rng.integers(1, 50))
            if level == depth:
                nodes[at_node] = (-1, 0.0, -1, -1, cover, rng.normal(), False)
                return at_node
            f, cut, side = int(rng.integers(0, 5)), float(rng.integers(-2, 3)), bool(rng.integers(0, 2))
            left, right = grow(level + 1), grow(level + 1)
            nodes[at_node] = (f, cut, left, right, nodes[left][4] + nodes[right][4], 0.0, side)
            return at_node

        grow(0)
        return at.TreeNodes(*[np.array(c) for c in zip(*nodes, strict=True)])

    groups = [g for tree in (grown(4), grown(3), grown(5)) for g in at.leaf_paths(tree)[0]]
    x = rng.choice([-np.inf, -2.0, -1.5, -1.0, 0.0, 0.5, 1.0, 2.0, 7.0, np.inf, np.nan], size=(700, 5))
    want = np.zeros_like(x)
    for g in groups:
        at._add_paths(x, g, want)
    for most in (8, 100, 4096):
        packs, wide = at.packed_leaves(groups, most)
        assert sorted([leaf for _, leaves in packs for leaf in leaves] + wide) == sorted((g, i) for g, p in enumerate(groups) for i in range(len(p.value)))
        got = np.zeros_like(x)
        for cuts, leaves in packs:
            cells = at._one_per_cell(cuts, 5)
            assert len(cells) <= most
            table = at.CellTable(cuts, np.zeros_like(cells))
            for g, leaf in leaves:
                at._add_paths(cells, at._leaf(groups, g, leaf), table.paid)
            at._add_cells(x, [table], got)
        for g, leaf in wide:
            at._add_paths(x, at._leaf(groups, g, leaf), got)
        np.testing.assert_allclose(got, want, atol=1e-12)
    assert len(at.packed_leaves(groups)[0]) < 12 and not at.packed_leaves(groups)[1]
