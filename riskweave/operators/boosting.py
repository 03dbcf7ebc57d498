"""Second-order gradient boosting of trees on histograms, with L2 shrinkage and a learnt direction for missing values.

A level of a tree is one aggregate: sums of gradient and hessian per node, feature and bin, added up per task before the
shuffle. What comes back has the size of the model's grid, whatever the number of rows, and the splits are chosen from it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators.attribution import TreeNodes
from riskweave.operators.ranking import exact_quantiles
from riskweave.sources.local import small_frame
from riskweave.sources.shared import fresh_path, remove

PARAMS = {"rounds": 200, "depth": 8, "step": 0.1, "l2": 1.0, "least_gain": 0.0, "least_hessian": 1.0, "bins": 64, "base_rate": 0.5}
#: Rounds between two stored versions of the margins; their trees are nested expressions in between.
_HELD_ROUNDS = 4
#: Gains this close, relative to their size, tie: sums of doubles depend on the order of rows.
_TIE = 1e-9
_MODEL = "tree int, node int, feature int, threshold double, missing_left boolean, child_left int, child_right int, value double, cover double, gain double"


class Split(NamedTuple):
    feature: int
    bin: int  # the last one on the left
    missing_left: bool
    gain: float
    left: tuple[float, float]  # sums of gradient and hessian
    right: tuple[float, float]


@dataclass(frozen=True)
class BoostedTrees:
    """A fitted ensemble on the log-odds scale; a leaf's value holds the step already."""

    features: tuple[str, ...]
    base: float
    trees: tuple[TreeNodes, ...]
    gains: tuple[np.ndarray, ...]

    def margins(self, rows: np.ndarray) -> np.ndarray:
        """Log-odds of rows (rows x features, NaN where a value is missing)."""
        total = np.full(len(rows), self.base)
        for t in self.trees:
            node = np.zeros(len(rows), np.int64)
            while (inner := np.flatnonzero(t.feature[node] >= 0)).size:
                at = node[inner]
                value = rows[inner, t.feature[at]]
                left = np.where(np.isnan(value), t.missing_left[at], value <= t.threshold[at])
                node[inner] = np.where(left, t.left[at], t.right[at])
            total += t.value[node]
        return total

    def importances(self, spark: SparkSession) -> DataFrame:
        """(feature, importance, splits): share of the mean gain of a feature's splits, and how many there are."""
        used = np.concatenate([t.feature for t in self.trees]) if self.trees else np.zeros(0, int)
        gain = np.concatenate(self.gains) if self.trees else np.zeros(0)
        counts = [int((used == f).sum()) for f in range(len(self.features))]
        means = np.array([gain[used == f].mean() if n else 0.0 for f, n in enumerate(counts)])
        shares = means / means.sum() if means.sum() else means
        return small_frame(spark, list(zip(self.features, shares.tolist(), counts, strict=True)), "feature string, importance double, splits int")

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [
            (k, n, int(t.feature[n]), float(t.threshold[n]), bool(t.missing_left[n]), int(t.left[n]), int(t.right[n]), float(t.value[n]), float(t.cover[n]), float(g[n]))
            for k, (t, g) in enumerate(zip(self.trees, self.gains, strict=True))
            for n in range(len(t.feature))
        ]
        small_frame(spark, rows, _MODEL).coalesce(1).write.parquet(f"{path}/nodes")
        small_frame(spark, [(self.base, list(self.features))], "base double, features array<string>").write.parquet(f"{path}/model")


def load(spark: SparkSession, path: str) -> BoostedTrees:
    head = spark.read.parquet(f"{path}/model").first()
    nodes = spark.read.parquet(f"{path}/nodes").toPandas().sort_values(["tree", "node"])
    parts = [p for _, p in nodes.groupby("tree")]
    names = ["feature", "threshold", "child_left", "child_right", "cover", "value", "missing_left"]
    trees = tuple(TreeNodes(*(p[c].to_numpy() for c in names)) for p in parts)
    return BoostedTrees(tuple(head["features"]), head["base"], trees, tuple(p["gain"].to_numpy() for p in parts))


def _value(feature: str) -> Column:
    number = F.col(feature).cast("double")
    return F.when(~F.isnan(number), number)


def fit_edges(rows: DataFrame, features: list[str], bins: int) -> dict[str, list[float]]:
    """Ascending upper edges of the bins per feature: distinct elements at even ranks, without the largest value."""
    long = rows.select(*[_value(f).alias(f) for f in features]).unpivot([], features, "feature", "value")
    found = exact_quantiles(long, ["feature"], "value", [k / bins for k in range(1, bins + 1)], method="discrete")
    return {f: sorted(set(found.get((f,), [])))[:-1] for f in features}


def _number(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def _bin(name: str, edges: list[float]) -> Column:
    """Number of edges below a value, found by halving; null stays null."""

    def between(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high) // 2
        return f"CASE WHEN `{name}` <= {_number(edges[middle])} THEN {between(low, middle)} ELSE {between(middle + 1, high)} END"

    return F.expr(f"CASE WHEN `{name}` IS NOT NULL THEN {between(0, len(edges))} END")


def binned(rows: DataFrame, features: list[str], label: str, edges: Mapping[str, list[float]], weight: Column) -> DataFrame:
    """(b0, b1, ..., y, w): a bin per feature (null: missing), label and weight of the rows that have a label."""
    values = rows.where(F.col(label).isNotNull()).select(*[_value(f).alias(f) for f in features], F.col(label).cast("double").alias("y"), weight.alias("w"))
    return values.select(*[_bin(f, edges[f]).alias(f"b{k}") for k, f in enumerate(features)], "y", "w")


def histogram(state: DataFrame, node: Column, sizes: list[int]) -> dict[int, list[np.ndarray]]:
    """Per open node and feature, sums of gradient and hessian by bin, those of missing values in the last row.

    ``state`` is (b0, ..., y, w, m); rows outside the open nodes have a null node. One aggregate; at most nodes x bins x
    features rows come back.
    """
    p = 1 / (1 + F.exp(-F.col("m")))
    bins = F.array(*[F.coalesce(F.col(f"b{k}"), F.lit(n)) for k, n in enumerate(sizes)])
    rows = state.select(node.alias("node"), (F.col("w") * (p - F.col("y"))).alias("g"), (F.col("w") * p * (1 - p)).alias("h"), bins.alias("bins"))
    long = rows.where("node is not null").select("node", "g", "h", F.posexplode("bins").alias("feature", "bin"))
    found: dict[int, list[np.ndarray]] = {}
    for r in long.groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect():
        tables = found.setdefault(r["node"], [np.zeros((n + 1, 2)) for n in sizes])
        tables[r["feature"]][r["bin"]] = (r["g"], r["h"])
    return found


def split_gains(table: np.ndarray, l2: float, least_hessian: float) -> tuple[np.ndarray, np.ndarray]:
    """Gain of a split after each bin with missing values on the left or the right, and the sums on the left.

    Both are (bins, 2, ...); a split that leaves a side without rows or with too little hessian has no gain (minus
    infinity). After the last bin, only missing values are on the right.
    """
    total = table.sum(axis=0)
    below = np.cumsum(table[:-1], axis=0)
    left = np.stack((below + table[-1], below), axis=1)
    right = total - left
    worth = lambda s: s[..., 0] ** 2 / np.maximum(s[..., 1] + l2, np.finfo(float).tiny)
    gain = (worth(left) + worth(right) - worth(total)) / 2
    tiny = 1e-12 * max(total[1], 1.0)  # sums that are nothing but rounding
    allowed = (left[..., 1] >= max(least_hessian, tiny)) & (right[..., 1] >= max(least_hessian, tiny)) & (right[..., 1] > tiny)
    return np.where(allowed, gain, -np.inf), left


def best_split(tables: list[np.ndarray], params: Mapping) -> Split | None:
    """The largest gain; of equal ones the first feature, the lowest bin, missing values on the left."""
    best = None
    for f, table in enumerate(tables):
        gain, left = split_gains(table, params["l2"], params["least_hessian"])
        top = gain.max(initial=-np.inf)
        if not np.isfinite(top) or top <= params["least_gain"] + _TIE or (best and top <= best.gain + _TIE * (1 + abs(best.gain))):
            continue
        at, side = np.argwhere(gain >= top - _TIE * (1 + abs(top)))[0]
        mine = left[at, side]
        best = Split(f, int(at), side == 0, float(gain[at, side]), tuple(mine), tuple(table.sum(axis=0) - mine))
    return best


class _Grown(NamedTuple):
    """Growing tree: a split or none per node, its children, and its sums."""

    splits: list
    children: list
    sums: list


def _route(tree: _Grown, leaf_of: Callable[[int], str], node: int = 0) -> str:
    """SQL over the bins that gives ``leaf_of`` of the node where a row ends."""
    split = tree.splits[node]
    if split is None:
        return leaf_of(node)
    left, right = (_route(tree, leaf_of, child) for child in tree.children[node])
    return f"CASE WHEN coalesce(b{split.feature} <= {split.bin}, {str(bool(split.missing_left)).lower()}) THEN {left} ELSE {right} END"


def _grow(state: DataFrame, sizes: list[int], params: Mapping) -> _Grown:
    tree, open_nodes = _Grown([None], [None], [None]), [0]
    for level in range(params["depth"]):
        node = _route(tree, lambda n: str(n) if n in open_nodes else "CAST(NULL AS INT)")  # noqa: B023
        tables = histogram(state, F.expr(node), sizes)
        if level == 0:
            tree.sums[0] = tuple(tables[0][0].sum(axis=0)) if tables else (0.0, 0.0)
        fresh = []
        for n in open_nodes:
            split = best_split(tables[n], params) if n in tables else None
            if split:
                tree.splits[n], tree.children[n] = split, (len(tree.splits), len(tree.splits) + 1)
                tree.splits.extend([None, None])
                tree.children.extend([None, None])
                tree.sums.extend([split.left, split.right])
                fresh.extend(tree.children[n])
        open_nodes = fresh
        if not open_nodes:
            break
    return tree


def _nodes(tree: _Grown, edges: list[list[float]], params: Mapping) -> tuple[TreeNodes, np.ndarray]:
    inner = lambda pick, leaf: np.array([leaf if s is None else pick(n, s) for n, s in enumerate(tree.splits)])
    upper = lambda s: edges[s.feature][s.bin] if s.bin < len(edges[s.feature]) else np.inf
    nodes = TreeNodes(
        feature=inner(lambda n, s: s.feature, -1),
        threshold=inner(lambda n, s: upper(s), 0.0).astype(float),
        left=inner(lambda n, s: tree.children[n][0], -1),
        right=inner(lambda n, s: tree.children[n][1], -1),
        cover=np.array([s[1] for s in tree.sums]),
        value=np.array([_leaf_value(tree, n, params) if s is None else 0.0 for n, s in enumerate(tree.splits)]),
        missing_left=inner(lambda n, s: s.missing_left, False),
    )
    return nodes, inner(lambda n, s: s.gain, 0.0).astype(float)


def _leaf_value(tree: _Grown, node: int, params: Mapping) -> float:
    g, h = tree.sums[node]
    return -params["step"] * g / (h + params["l2"]) if h + params["l2"] else 0.0


def positive_weight(rows: DataFrame, label: str) -> float:
    """Negatives per positive, to two digits; one if a class is absent."""
    n = rows.agg(F.count_if(F.col(label) == 0).alias("neg"), F.count_if(F.col(label) == 1).alias("pos")).first()
    return round(n["neg"] / n["pos"], 2) if n["neg"] and n["pos"] else 1.0


def fit(train: DataFrame, features: list[str], label: str, params: Mapping | None = None, positives: float | None = None) -> BoostedTrees:
    """Boost trees on 0/1 labels; ``params`` override ``PARAMS``, ``positives`` is the weight of a positive row.

    NULL and NaN are missing values, for which each split learns a side; rows without a label are left out. Bins and
    margins are stored, so a lost executor costs a task. Without rows, the model is its base rate.
    """
    spark, params = train.sparkSession, {**PARAMS, **(params or {})}
    lift = positive_weight(train, label) if positives is None else positives
    edges = fit_edges(train.where(F.col(label).isNotNull()), features, params["bins"])
    sizes = [len(edges[f]) + 1 for f in features]
    base = float(np.log(params["base_rate"] / (1 - params["base_rate"])))
    rows = binned(train, features, label, edges, F.when(F.col(label) == 1, lift).otherwise(1.0)).withColumn("m", F.lit(base))
    path = fresh_path(spark, "boosting")
    rows.write.parquet(path)
    state, trees, gains = spark.read.parquet(path), [], []
    columns = state.columns
    for done in range(1, params["rounds"] + 1):
        tree = _grow(state, sizes, params)
        if tree.sums[0] is None or not tree.sums[0][1]:
            break
        nodes, gain = _nodes(tree, [edges[f] for f in features], params)
        trees.append(nodes)
        gains.append(gain)
        state = state.withColumn("m", F.col("m") + F.expr(_route(tree, lambda n: _number(float(nodes.value[n]))))).select(columns)  # noqa: B023
        if done % _HELD_ROUNDS == 0 and done < params["rounds"]:
            old, path = path, fresh_path(spark, "boosting")
            state.write.parquet(path)
            state = spark.read.parquet(path)
            remove(spark, old)
    remove(spark, path)
    return BoostedTrees(tuple(features), base, tuple(trees), tuple(gains))


def root_gains(train: DataFrame, features: list[str], label: str, params: Mapping | None = None) -> DataFrame:
    """(feature, edge, missing_left, gain) of every split of the first tree's root that leaves rows on both sides."""
    params = {**PARAMS, **(params or {})}
    lift = positive_weight(train, label)
    edges = fit_edges(train.where(F.col(label).isNotNull()), features, params["bins"])
    rows = binned(train, features, label, edges, F.when(F.col(label) == 1, lift).otherwise(1.0)).withColumn("m", F.lit(0.0))
    tables = histogram(rows, F.lit(0), [len(edges[f]) + 1 for f in features])
    found = []
    for f, table in zip(features, tables.get(0, []), strict=False):
        gain, _ = split_gains(table, params["l2"], params["least_hessian"])
        limits = [*edges[f], None]
        found += [(f, limits[b], side == 0, float(gain[b, side])) for b, side in np.argwhere(np.isfinite(gain))]
    return small_frame(train.sparkSession, found, "feature string, edge double, missing_left boolean, gain double")


def score(model: BoostedTrees, df: DataFrame, name: str = "score", margin: str | None = None) -> DataFrame:
    """Add the probability of class 1, and the log-odds under ``margin``; rows with missing values are scored too."""
    features = list(model.features)

    @F.pandas_udf("double")
    def log_odds(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(model.margins(np.column_stack([p.to_numpy(dtype=float, na_value=np.nan) for p in part])))

    hidden = margin or "_margin"
    out = df.withColumn(hidden, log_odds(*[F.col(f).cast("double") for f in features])).withColumn(name, 1 / (1 + F.exp(-F.col(hidden))))
    return out if margin else out.drop(hidden)
