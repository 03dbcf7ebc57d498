"""Per-feature attribution of each score, and the sentences built from it."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce
from math import factorial, prod
from typing import TYPE_CHECKING, NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from riskweave.functions import scalars as sc
from riskweave.sources.shared import fresh_path

if TYPE_CHECKING:
    from riskweave.operators.boosting import BoostedTrees


def logistic_margin(coefficients: Mapping[str, float], intercept: float) -> Column:
    terms = [F.lit(w) * F.col(f) for f, w in coefficients.items()]
    return reduce(lambda a, b: a + b, terms, F.lit(intercept))


def logistic_score(coefficients: Mapping[str, float], intercept: float) -> Column:
    return 1 / (1 + F.exp(-logistic_margin(coefficients, intercept)))


def shap_name(feature: str) -> str:
    return f"shap_{feature}"


def background_means(df: DataFrame, features: list[str]) -> dict[str, float]:
    return df.agg(*[F.avg(f).alias(f) for f in features]).first().asDict()


def linear_shap(df: DataFrame, coefficients: Mapping[str, float], means: Mapping[str, float]) -> DataFrame:
    """Add coefficient x (value - background mean) per feature, on the log-odds scale."""
    return df.withColumns(
        {shap_name(f): F.lit(w) * (F.col(f) - F.lit(means[f])) for f, w in coefficients.items()}
    )


def global_importance(df: DataFrame, features: list[str], digits: int = 6) -> DataFrame:
    """Mean absolute attribution per feature, largest first."""
    wide = df.agg(*[F.round(F.avg(F.abs(shap_name(f))), digits).alias(f) for f in features])
    return wide.unpivot([], features, "feature", "importance").orderBy(F.desc("importance"), "feature")


def _ranked(features: list[str]) -> Column:
    return F.array_sort(
        F.array(
            *[
                F.struct(F.col(shap_name(f)).alias("shap"), F.lit(i).alias("pos"), F.lit(f).alias("feature"))
                for i, f in enumerate(features)
            ]
        )
    )


def local_drivers(df: DataFrame, features: list[str], top: int = 3) -> DataFrame:
    """Add the features that push each row's score most up and most down, strongest first."""
    ranked = df.withColumn("_ranked", _ranked(features))
    top = min(top, len(features))
    return ranked.withColumns(
        {
            "drivers_up": F.reverse(F.slice("_ranked", -top, top)),
            "drivers_down": F.slice("_ranked", 1, top),
        }
    ).drop("_ranked")


def explanation_records(df: DataFrame, score: str, model_version: str, at: Column) -> DataFrame:
    """One explanation row per applicant from ``local_drivers`` output."""
    up, down = F.get("drivers_up", F.lit(0)), F.get("drivers_down", F.lit(0))
    sentence = F.concat(
        F.lit("Risk "),
        sc.percent_text(F.col(score)),
        F.lit(" primarily driven UP by "),
        up.getField("feature"),
        F.lit(" and driven DOWN by "),
        down.getField("feature"),
        F.lit("."),
    )
    return df.select(
        "applicant_id",
        F.lit(model_version).alias("model_version"),
        F.col(score).alias("total_risk_score"),
        up.getField("feature").alias("top_positive_feature"),
        up.getField("shap").alias("top_positive_shap"),
        down.getField("feature").alias("top_negative_feature"),
        down.getField("shap").alias("top_negative_shap"),
        sentence.alias("explanation_summary"),
        at.alias("audit_timestamp"),
    )


class TreeNodes(NamedTuple):
    """One tree of a fitted ensemble as flat arrays; ``feature`` is -1 at a leaf.

    A value at or below the threshold goes left. Missing values go right, or where ``missing_left`` sends them.
    """

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    cover: np.ndarray
    value: np.ndarray
    missing_left: np.ndarray | None = None


def ensemble_nodes(model: PipelineModel, spark: SparkSession) -> list[TreeNodes]:
    """Trees of a fitted forest (probability scale) or boosting model (margin scale).

    Read from the model's own node table, one small job instead of a call per node. Its size is
    that of the model, whatever the data.
    """
    last = model.stages[-1]
    path = fresh_path(spark, "trees")
    last.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").toPandas()
    weights = list(last.treeWeights)
    boosted = type(last).__name__.startswith("GBT")
    trees = []
    for tree_id, part in nodes.groupby("treeID"):
        part = part.sort_values("id")
        stats = np.stack(part["impurityStats"].to_list())
        share = weights[tree_id] / (1.0 if boosted else sum(weights))
        output = part["prediction"].to_numpy() if boosted else stats[:, 1] / stats.sum(axis=1)
        splits = part["split"].to_list()
        trees.append(
            TreeNodes(
                feature=np.array([s["featureIndex"] for s in splits]),
                threshold=np.array([next(iter(s["leftCategoriesOrThreshold"]), 0.0) for s in splits]),
                left=part["leftChild"].to_numpy(),
                right=part["rightChild"].to_numpy(),
                cover=stats[:, 0] if boosted else stats.sum(axis=1),
                value=share * output,
            )
        )
    return trees


class LeafPaths(NamedTuple):
    """Leaves of one tree with the same number of features on their paths, as arrays (leaf, feature on the path)."""

    feature: np.ndarray
    above: np.ndarray  # the row's value must not be at or below this
    upto: np.ndarray  # and must be at or below this, infinite if no split asks for it
    share: np.ndarray  # of the training cover that takes the path where the feature is unknown
    missing: np.ndarray  # one if a row without a value takes the path, else zero
    value: np.ndarray


def leaf_paths(tree: TreeNodes) -> tuple[list[LeafPaths], float]:
    """Paths grouped by length, and the expected output of the tree. Splits of one feature are merged."""
    groups: dict[int, list] = {}
    base = 0.0
    stack: list[tuple[int, dict]] = [(0, {})]
    while stack:
        node, path = stack.pop()
        f = int(tree.feature[node])
        if f < 0:
            groups.setdefault(len(path), []).append((path, tree.value[node]))
            base += tree.value[node] * np.prod([p[2] for p in path.values()])
            continue
        above, upto, share, absent = path.get(f, (-np.inf, np.inf, 1.0, 1.0))
        to_left = float(tree.missing_left is not None and tree.missing_left[node])
        cut, total = tree.threshold[node], tree.cover[tree.left[node]] + tree.cover[tree.right[node]]
        sides = ((tree.left[node], above, min(upto, cut), to_left), (tree.right[node], max(above, cut), upto, 1 - to_left))
        for child, low, high, takes in sides:
            stack.append((int(child), {**path, f: (low, high, share * tree.cover[child] / total, absent * takes)}))
    out = []
    for size, leaves in groups.items():
        if size:
            numbers = np.array([[p[f] for f in p] for p, _ in leaves], dtype=float)
            features = np.array([list(p) for p, _ in leaves])
            out.append(LeafPaths(features, *np.moveaxis(numbers, 2, 0), np.array([v for _, v in leaves])))
    return out, base


def _agrees(values: np.ndarray, paths: LeafPaths) -> np.ndarray:
    """One where a value (rows x leaves x features of the path) takes the path, else zero."""
    inside = (values <= paths.upto) & ((values > paths.above) | np.isneginf(paths.above))
    return np.where(np.isnan(values), paths.missing, inside)


def _add_paths(x: np.ndarray, paths: LeafPaths, out: np.ndarray) -> None:
    """Add the Shapley values of the leaves' outputs to ``out`` (rows x features).

    A leaf pays its value if every feature on its path agrees; an unknown feature agrees with its
    share. With the known ones drawn at rate t, the value of a feature is its own difference times
    the integral over t of the product of all other terms, a polynomial that Gauss-Legendre nodes
    integrate exactly. Work per leaf is the square of its path length.
    """
    size = paths.feature.shape[1]
    values = x[:, paths.feature]
    agrees = _agrees(values, paths)
    nodes, weights = np.polynomial.legendre.leggauss(size // 2 + 1)
    integral = np.zeros_like(agrees)
    ones = np.ones((*agrees.shape[:2], 1))
    for node, weight in zip((nodes + 1) / 2, weights / 2, strict=True):
        terms = agrees * node + paths.share * (1 - node)
        before = np.concatenate((ones, np.cumprod(terms[..., :-1], axis=2)), axis=2)
        after = np.concatenate((np.cumprod(terms[..., :0:-1], axis=2)[..., ::-1], ones), axis=2)
        integral += weight * before * after
    gain = paths.value[:, None] * (agrees - paths.share) * integral
    for f in np.unique(paths.feature):
        out[:, f] += (gain * (paths.feature == f)).sum(axis=(1, 2))


#: Most cells of a table: a leaf whose path holds up to six features fits into one.
_MOST_CELLS = 4096


class CellTable(NamedTuple):
    """What some leaves pay to a row, by the cell between the leaves' cuts in which the row lies."""

    cuts: list[tuple[int, np.ndarray]]  # feature and its cuts; a cell beyond the last cut, and one of missing values follow
    paid: np.ndarray  # cells x features


def _cells(cuts: list[tuple[int, np.ndarray]], x: np.ndarray) -> np.ndarray:
    """Number of the cell of each row."""
    cell = np.zeros(len(x), dtype=np.int64)
    for f, points in cuts:
        place = np.searchsorted(points, x[:, f])
        place[np.isnan(x[:, f])] = len(points) + 1
        cell = cell * (len(points) + 2) + place
    return cell


def _one_per_cell(cuts: list[tuple[int, np.ndarray]], width: int) -> np.ndarray:
    """A row for each cell, in the order of their numbers: every value of a cell takes the same paths."""
    values = [np.concatenate((points, (np.inf, np.nan))) for _, points in cuts]
    x = np.zeros((int(np.prod([len(v) for v in values])), width))
    for (f, _), column in zip(cuts, np.meshgrid(*values, indexing="ij"), strict=True):
        x[:, f] = column.ravel()
    return x


def packed_leaves(groups: list[LeafPaths], most: int | None = None) -> tuple[list[tuple[list, list[tuple[int, int]]]], list[tuple[int, int]]]:
    """Leaves, as (group, leaf), put together with their cuts while these make no more than ``most`` cells; those that make
    more alone come second."""
    most, packs, wide = most or _MOST_CELLS, [], []
    cuts: dict[int, set] = {}
    held: list[tuple[int, int]] = []

    def close() -> None:
        if held:
            packs.append(([(f, np.array(sorted(points))) for f, points in sorted(cuts.items())], list(held)))

    for g, paths in enumerate(groups):
        for leaf in range(len(paths.value)):
            own = {int(f): {v for v in (a, u) if np.isfinite(v)} for f, a, u in zip(paths.feature[leaf], paths.above[leaf], paths.upto[leaf], strict=True)}
            size = lambda sets: prod(len(points) + 2 for points in sets.values())
            if size(own) > most:
                wide.append((g, leaf))
                continue
            both = {f: cuts.get(f, set()) | own.get(f, set()) for f in {*cuts, *own}}
            if size(both) > most:
                close()
                held.clear()
                both = own
            cuts = both
            held.append((g, leaf))
    close()
    return packs, wide


def _leaf(groups: list[LeafPaths], g: int, leaf: int) -> LeafPaths:
    return LeafPaths(*[a[leaf : leaf + 1] for a in groups[g]])


def _add_cells(x: np.ndarray, tables: list[CellTable], out: np.ndarray) -> None:
    for table in tables:
        out += table.paid[_cells(table.cuts, x)]


def tree_shap(df: DataFrame, model: PipelineModel | BoostedTrees, features: list[str], block_values: int = 1 << 20) -> DataFrame:
    """Add exact path-dependent attributions of a tree ensemble, and their base value.

    A map-only Arrow stage: no row is replicated and nothing is shuffled. Leaves are put together while few cells lie between
    their cuts; what they pay is worked out once for each cell, and a row looks up its own. Work per row for leaves of longer
    paths is the square of the path length, for any number of features; ``block_values`` bounds the numbers held at once.
    A model with trees of its own brings them and its base along.
    """
    trees = model.trees if hasattr(model, "trees") else ensemble_nodes(model, df.sparkSession)
    fitted = [leaf_paths(tree) for tree in trees]
    groups = [g for paths, _ in fitted for g in paths]
    base = float(sum(b for _, b in fitted)) + getattr(model, "base", 0.0)
    packs, wide = packed_leaves(groups)
    tables = []
    for cuts, leaves in packs:
        cells = _one_per_cell(cuts, len(features))
        tables.append(CellTable(cuts, np.zeros_like(cells)))
        for g, leaf in leaves:
            _add_paths(cells, _leaf(groups, g, leaf), tables[-1].paid)
    rest = [LeafPaths(*[a[[leaf for h, leaf in wide if h == g]] for a in groups[g]]) for g in sorted({g for g, _ in wide})]
    widest = max([g.feature.size for g in rest], default=1)
    names = [shap_name(f) for f in features] + ["shap_base"]

    def attribute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        step = max(1, block_values // widest)
        for batch in batches:
            x = batch[features].to_numpy(dtype=float)
            found = np.zeros((len(x), len(features)))
            _add_cells(x, tables, found)
            for start in range(0, len(x) if rest else 0, step):
                for group in rest:
                    _add_paths(x[start : start + step], group, found[start : start + step])
            yield batch.assign(**dict(zip(names, [*found.T, np.full(len(x), base)], strict=True)))

    added = [StructField(name, DoubleType()) for name in names]
    return df.mapInPandas(attribute, StructType(df.schema.fields + added))


def _masks(x: np.ndarray, paths: LeafPaths) -> np.ndarray:
    """Per row and leaf, a bit for each feature on the path that the row agrees with."""
    values = x[:, paths.feature]
    return (_agrees(values, paths).astype(np.int64) << np.arange(paths.feature.shape[1])).sum(axis=2)


def background_masks(background: DataFrame, groups: list[LeafPaths], features: list[str]) -> pd.DataFrame:
    """(grp, leaf, mask, n): how many background rows agree with which features of each leaf's path.

    Rows are counted inside their task and added up; what comes back depends on the model's paths, not on the rows.
    """

    packs, wide = packed_leaves(groups)

    def tally(column: str, at: int, leaf: int, values: np.ndarray) -> pd.DataFrame:
        held, n = np.unique(values, return_counts=True)
        return pd.DataFrame({"kind": column, "at": at, "leaf": leaf, "value": held, "n": n})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch.to_numpy(dtype=float)
            for at, (cuts, _) in enumerate(packs):
                yield tally("cell", at, 0, _cells(cuts, x))
            for g, leaf in wide:
                yield tally("mask", g, leaf, _masks(x, _leaf(groups, g, leaf))[:, 0])

    schema = "kind string, at int, leaf int, value long, n long"
    rows = background.select(*[F.col(f).cast("double") for f in features]).mapInPandas(count, schema)
    met = rows.groupBy("kind", "at", "leaf", "value").agg(F.sum("n").alias("n")).toPandas()
    out = [met[met["kind"] == "mask"].rename(columns={"at": "grp", "value": "mask"})[["grp", "leaf", "mask", "n"]]]
    for at, part in met[met["kind"] == "cell"].groupby("at"):
        cuts, leaves = packs[at]
        reached = _one_per_cell(cuts, len(features))[part["value"].to_numpy()]
        for g, leaf in leaves:
            masks = _masks(reached, _leaf(groups, g, leaf))[:, 0]
            sums = pd.Series(part["n"].to_numpy()).groupby(masks).sum()
            out.append(pd.DataFrame({"grp": g, "leaf": leaf, "mask": sums.index.to_numpy(np.int64), "n": sums.to_numpy()}))
    return pd.concat(out, ignore_index=True)


def _played(own: np.ndarray, other: np.ndarray, share: np.ndarray, size: int) -> np.ndarray:
    """Shapley values (own x features) of a leaf of value one for each mask of a row against weighted background masks.

    Features that only the row agrees with must be its own, those that only the background row agrees with must not; if
    both disagree anywhere, no mixture of the two reaches the leaf. With p and q such features, one of the first kind
    gets (p-1)! q! / (p+q)! and one of the second kind loses p! (q-1)! / (p+q)!.
    """
    full = (1 << size) - 1
    reach = (own[:, None] | other[None, :]) == full
    first, second = own[:, None] & ~other[None, :], other[None, :] & ~own[:, None]
    fact = np.array([float(factorial(k)) for k in range(size + 1)])
    p, q = np.bitwise_count(first).astype(int), np.bitwise_count(second).astype(int)
    weight = np.where(reach, share[None, :], 0.0)
    total = np.array([float(factorial(k)) for k in range(2 * size + 1)])[p + q]
    gains, losses = weight * fact[np.maximum(p - 1, 0)] * fact[q] / total, weight * fact[p] * fact[np.maximum(q - 1, 0)] / total
    bits = np.arange(size)
    has = lambda masks: (masks[..., None] >> bits) & 1
    return (gains[..., None] * has(first) - losses[..., None] * has(second)).sum(axis=1)


def interventional_shap(df: DataFrame, model: PipelineModel | BoostedTrees, background: DataFrame, features: list[str]) -> DataFrame:
    """Add exact attributions against a background table, and its mean output as the base.

    An unknown feature takes its values from the background rows, independently of the known ones. Rows and background
    may be of any size: the background is reduced to counts of the features that its rows agree with on each path, and
    attributing is a map over the rows. NULL and NaN go where the trees send missing values. An empty background gives
    NaN.
    """
    trees = model.trees if hasattr(model, "trees") else ensemble_nodes(model, df.sparkSession)
    fitted = [leaf_paths(tree) for tree in trees]
    groups = [g for paths, _ in fitted for g in paths]
    alone = sum(float(t.value[0]) for t in trees if t.feature[0] < 0)  # trees without a split
    size = float(background.count())
    met: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    for (g, leaf), part in background_masks(background, groups, features).groupby(["grp", "leaf"]):
        met[int(g), int(leaf)] = (part["mask"].to_numpy(np.int64), part["n"].to_numpy(float) / size)
    base = getattr(model, "base", 0.0) + alone if size else np.nan
    for (g, leaf), (masks, share) in met.items():
        base += groups[g].value[leaf] * share[masks == (1 << groups[g].feature.shape[1]) - 1].sum()
    names = [shap_name(f) for f in features] + ["shap_base"]

    def add(x: np.ndarray, g: int, leaf: int, out: np.ndarray) -> None:
        paths = _leaf(groups, g, leaf)
        own, place = np.unique(_masks(x, paths)[:, 0], return_inverse=True)
        out[:, paths.feature[0]] += (_played(own, *met[g, leaf], paths.feature.shape[1]) * paths.value[0])[place]

    packs, wide = packed_leaves(groups if size else [])
    tables = []
    for cuts, leaves in packs:
        cells = _one_per_cell(cuts, len(features))
        tables.append(CellTable(cuts, np.zeros_like(cells)))
        for g, leaf in leaves:
            add(cells, g, leaf, tables[-1].paid)

    def attribute(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[features].to_numpy(dtype=float)
            found = np.full((len(x), len(features)), 0.0 if size else np.nan)
            _add_cells(x, tables, found)
            for g, leaf in wide:
                add(x, g, leaf, found)
            yield batch.assign(**dict(zip(names, [*found.T, np.full(len(x), base)], strict=True)))

    added = [StructField(name, DoubleType()) for name in names]
    return df.mapInPandas(attribute, StructType(df.schema.fields + added))
