"""Embedding near-duplicates: random projections decoded to E8 lattice points, neighbouring cells probed, cosine verified."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import LAST_KEY, stored
from riskweave.llm.components import components
from riskweave.llm.words import mix

COSINE = 0.95
#: Tables, lattice blocks of eight projections in each, length of a unit vector's projections, cells probed per table.
TABLES, BLOCKS, SCALE, PROBES = 6, 2, 0.6, 24
_NEAR = 12  # lattice points looked at per block
#: Signs of 128 more projections; a pair at the threshold differs in 13 of them, with a deviation of 3.4.
_SIGNS, _MOST_SIGNS = 128, 32


@lru_cache(1)
def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of 1 or -1, or all of a half with an even number of minus signs."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) / 2 for s in product((1, -1), repeat=8) if np.prod(s) > 0]
    return np.array(out, float)


def _nearest_d8(y: np.ndarray) -> np.ndarray:
    x = np.rint(y)
    odd = np.flatnonzero(x.sum(1) % 2 != 0)
    off = y[odd] - x[odd]
    worst = np.abs(off).argmax(1)
    x[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
    return x


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """Closest point of E8 = D8 and D8 + (1/2, ..., 1/2) for each row of eight numbers."""
    whole, half = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    closer = ((y - whole) ** 2).sum(1) <= ((y - half) ** 2).sum(1)
    return np.where(closer[:, None], whole, half)


def _point_hash(points: np.ndarray, salt: int) -> np.ndarray:
    """Hash of lattice points on the last axis; twice a point has whole entries."""
    odd = np.random.default_rng(97).integers(0, 2**62, 8, np.uint64) * np.uint64(2) + np.uint64(1)
    twice = np.rint(2 * points).astype(np.int64).view(np.uint64)
    return mix((twice * odd).sum(-1, dtype=np.uint64) + np.uint64(salt))


@lru_cache(8)
def _projections(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng([5, size])
    return rng.normal(0, 1, (size, TABLES * BLOCKS * 8)) * SCALE, rng.uniform(0, 2, TABLES * BLOCKS * 8), rng.normal(0, 1, (size, _SIGNS))


def cells(units: np.ndarray) -> np.ndarray:
    """(rows, TABLES, PROBES) cell numbers of unit vectors, the own cell first, then the closest cells around."""
    matrix, shift, _ = _projections(units.shape[1])
    y = (units @ matrix + shift).reshape(-1, 8)
    own = nearest_e8(y)
    gap = y - own
    far = np.concatenate((np.zeros((len(y), 1)), 2 - 2 * gap @ roots().T), 1)  # beyond the distance of the own point
    near = np.argpartition(far[:, 1:], _NEAR - 2, axis=1)[:, : _NEAR - 1] + 1
    near = np.concatenate((np.zeros((len(y), 1), np.int64), near), 1)
    far = np.take_along_axis(far, near, 1).reshape(-1, TABLES, BLOCKS, _NEAR)
    steps = np.concatenate((np.zeros((1, 8)), roots()))
    named = _point_hash(own[:, None] + steps[near], units.shape[1]).reshape(-1, TABLES, BLOCKS, _NEAR)
    total, name = far[:, :, 0], named[:, :, 0]
    for b in range(1, BLOCKS):
        total = (total[..., None] + far[:, :, b, None, :]).reshape(len(units), TABLES, -1)
        name = mix(name[..., None] * np.uint64(3) + named[:, :, b, None, :]).reshape(len(units), TABLES, -1)
    best = np.argpartition(total[..., 1:], PROBES - 2, axis=2)[..., : PROBES - 1] + 1
    best = np.concatenate((np.zeros((len(units), TABLES, 1), np.int64), best), 2)
    return mix(np.take_along_axis(name, best, 2) + np.arange(TABLES, dtype=np.uint64)[None, :, None])


def _by_size(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of a list column that have one length, with their unit vectors."""
    sizes = column.value_lengths().to_numpy()
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        values = column.take(pa.array(rows)).flatten().to_numpy().reshape(-1, size)
        values = values / np.abs(values).max(1, keepdims=True)
        yield rows, values / np.sqrt((values * values).sum(1, keepdims=True))


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for begin in range(0, whole.num_rows, 512):
            batch = whole.slice(begin, 512)
            node = batch.column("node").to_numpy()
            for rows, units in _by_size(batch.column("vec")):
                found = cells(units).view(np.int64)
                signs = np.packbits(units @ _projections(units.shape[1])[2] >= 0, axis=1).view("<i8")
                many = TABLES * PROBES
                home = np.tile(np.arange(PROBES) == 0, TABLES)
                columns = [found.reshape(-1), np.repeat(node[rows], many), np.tile(home, len(rows)), np.repeat(signs[:, 0], many), np.repeat(signs[:, 1], many)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["cell", "node", "home", "s0", "s1"])


def _verified(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(c) for c in ("va", "vb"))
            keep = np.zeros(batch.num_rows, bool)
            sizes = left.value_lengths().to_numpy()
            for rows, units in _by_size(left):
                same = rows[right.value_lengths().to_numpy()[rows] == sizes[rows]]
                if len(same):
                    other = next(_by_size(right.take(pa.array(same))))[1]
                    keep[same] = (units[np.isin(rows, same)] * other).sum(1) >= least
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([batch.column(c).take(at) for c in ("a", "b")], ["a", "b"])

    return run


def distinct_vectors(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows as (vec_id, key, h0, h1), and a stored table of distinct usable vectors (node, h0, h1, root, n, vec)."""
    wide = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    good = "vec is not null and size(vec) > 0 and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(vec, x -> x <> 0)"
    rows = wide.withColumn("good", F.coalesce(F.expr(good), F.lit(False)))
    hashes = [F.when(F.col("good"), F.xxhash64(F.lit(salt), "vec")).alias(f"h{salt}") for salt in (0, 1)]
    rows = rows.select("vec_id", F.coalesce("vec_id", F.lit(LAST_KEY)).alias("key"), "vec", "good", *hashes)
    classes = rows.where("good").groupBy("h0", "h1").agg(F.min("key").alias("root"), F.count(F.lit(1)).alias("n"), F.first("vec").alias("vec"))
    return rows.drop("vec", "good"), stored(classes.withColumn("node", F.monotonically_increasing_id()), "vectors")


def near_links(nodes: DataFrame, least: float = COSINE) -> DataFrame:
    """(a, b) with a < b: pairs of ``nodes`` at cosine ``least`` or more that share a cell in some table.

    A vector lies in its own cell of each table and visits the cells around; a pair meets where one visits the other's
    own cell. Hot cells are split by the join, and pairs whose projection signs differ too much go no further. What is
    left is compared in double precision.
    """
    codes = stored(nodes.select("node", "vec").mapInArrow(_codes, "cell long, node long, home boolean, s0 long, s1 long"), "cells")
    homes = codes.where("home").select("cell", F.col("node").alias("x"), F.col("s0").alias("p0"), F.col("s1").alias("p1"))
    met = homes.join(codes, "cell").where(f"x <> node and bit_count(s0 ^ p0) + bit_count(s1 ^ p1) <= {_MOST_SIGNS}")
    pairs = met.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b")).distinct()
    vec = nodes.select("node", "vec")
    both = pairs.join(vec.toDF("a", "va"), "a").join(vec.toDF("b", "vb"), "b")
    return both.select("a", "b", "va", "vb").mapInArrow(_verified(least), "a long, b long")


def near_duplicates(vectors: DataFrame, least: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of (vec_id, embedding).

    Equal vectors are one node and always linked. Null, empty and zero vectors, and those with null or non-finite entries,
    link with nothing, and only vectors of one length are compared. ``n_links`` counts the other rows that link directly,
    ``component_id`` is the smallest id reachable. A null id stays null and ranks as the largest.
    """
    rows, nodes = distinct_vectors(vectors)
    links = stored(near_links(nodes, least), "links")
    counts = nodes.select("node", "n")
    both = links.union(links.select("b", "a")).toDF("a", "b").join(counts.withColumnRenamed("node", "b"), "b")
    degrees = both.groupBy("a").agg(F.sum("n").alias("others")).withColumnRenamed("a", "node")
    named = nodes.select("node", "h0", "h1", "root", "n").join(degrees, "node", "left").join(components(links), "node", "left")
    named = named.withColumn("label", F.coalesce("label", "node"))
    lows = named.groupBy("label").agg(F.min("root").alias("low"))
    named = named.join(lows, "label").select("h0", "h1", "low", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    low = F.coalesce(F.col("low"), F.col("key"))
    out = rows.join(named, ["h0", "h1"], "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.when(low != LAST_KEY, low).alias("component_id")).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
