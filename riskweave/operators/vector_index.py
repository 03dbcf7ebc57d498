"""Approximate nearest passages of dense vectors: an inverted file of cells around centroids, ranked exactly inside cells.

The centroids are fitted on a bounded sample; every row is assigned and stored by cell, so a search reads only the cells it
probes. Batches can be added without fitting again.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from riskweave.operators.retrieval import block_counts, blocks_best, cosine_topk
from riskweave.sources.local import small_frame

#: Most cells of an index and rows its centroids are fitted on; both bound what is sent to tasks, whatever the corpus.
MOST_CELLS, SAMPLE_ROWS = 4096, 100_000
#: Bytes of what a task computes at a time when it looks for the cells of its rows.
_SLICE_BYTES = 32 << 20


class VectorIndex(NamedTuple):
    path: str
    centroids: np.ndarray  # unit rows, one per cell


def _usable(size: int | None = None) -> Column:
    """Vectors of finite numbers; of ``size`` entries, where a size is known."""
    finite = F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return finite if size is None else finite & (F.size("embedding") == size)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    length = np.sqrt((flat * flat).sum(axis=1, keepdims=True))
    return np.divide(flat, length, out=np.zeros_like(flat), where=length > 0)


def fit_centroids(vectors: DataFrame, cells: int | None = None, sample_rows: int = SAMPLE_ROWS, seed: int = 42, rounds: int = 12) -> np.ndarray:
    """Unit centroids by spherical k-means on about ``sample_rows`` rows, drawn by a hash of the vector.

    ``cells`` is the square root of the number of rows unless it is given, at most ``MOST_CELLS``; fewer come back where
    the sample has fewer distinct directions. Zero vectors and vectors that are not finite have no part.
    """
    held = vectors.where(_usable() & F.exists("embedding", lambda x: x != 0)).select("embedding")
    count = held.count()
    if not count:
        return np.zeros((0, 0))
    cells = max(1, min(cells or round(count**0.5), MOST_CELLS, count))
    share = min(1.0, max(sample_rows, cells) / count)
    drawn = held.where(F.pmod(F.xxhash64("embedding", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = drawn.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    model = KMeans(k=cells, distanceMeasure="cosine", seed=seed, maxIter=rounds).fit(rows)
    centers = np.array(model.clusterCenters())
    return centers / np.linalg.norm(centers, axis=1, keepdims=True)


def _with_cells(rows: DataFrame, centroids: np.ndarray, probes: int) -> DataFrame:
    """``rows`` once for each of their ``probes`` nearest cells, with ``probe`` counting from zero; equally near cells by number.

    Python names the cells only, in slices of bounded bytes; rows are copied as they stream on, however many probes there are.
    """
    cells, size = centroids.shape
    probes = min(probes, cells)
    added = StructField("_near", ArrayType(IntegerType()))
    step = max(1, min(4096, _SLICE_BYTES // (8 * (3 * cells + 2 * size))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                sims = -(_matrix(part.column("embedding"), size) @ centroids.T)
                near = np.argsort(sims, axis=1, kind="stable")[:, :probes].astype(np.int32)
                lists = pa.ListArray.from_arrays((np.arange(len(near) + 1) * probes).astype(np.int32), near.ravel())
                yield pa.RecordBatch.from_arrays([*part.columns, lists], [*part.schema.names, "_near"])

    listed = rows.mapInArrow(place, StructType([*rows.schema.fields, added]))
    return listed.select(*rows.columns, F.posexplode("_near").alias("probe", "cell")).select(*rows.columns, "cell", "probe")


def add_vectors(index: VectorIndex, vectors: DataFrame) -> None:
    """Assign further (passage_id, embedding) rows to the cells of an index and store them.

    Rows go to files by cell; a crowded cell is split over several tasks. Vectors of another size, with nulls or not finite
    are left out, as they are from an exact search.
    """
    cells, size = index.centroids.shape
    rows = vectors.where(_usable(size)).select("passage_id", "embedding")
    placed = _with_cells(rows, index.centroids, 1) if cells else rows.where("false").withColumn("cell", F.lit(0))
    placed.select("passage_id", "embedding", "cell").hint("rebalance", "cell").write.mode("append").partitionBy("cell").parquet(f"{index.path}/rows")


def build_index(vectors: DataFrame, path: str, cells: int | None = None, sample_rows: int = SAMPLE_ROWS, seed: int = 42) -> VectorIndex:
    """Fit centroids and store every (passage_id, embedding) row of ``vectors`` by its cell below ``path``."""
    spark = vectors.sparkSession
    index = VectorIndex(path, fit_centroids(vectors, cells, sample_rows, seed))
    rows = [(k, c.tolist()) for k, c in enumerate(index.centroids)]
    spark.createDataFrame(rows, "cell int, centroid array<double>").coalesce(1).write.parquet(f"{path}/centroids")
    add_vectors(index, vectors)
    return index


def open_index(spark: SparkSession, path: str) -> VectorIndex:
    """The index below ``path``; its centroids, at most ``MOST_CELLS``, come to the caller."""
    rows = sorted(spark.read.parquet(f"{path}/centroids").collect())
    return VectorIndex(path, np.array([r["centroid"] for r in rows]) if rows else np.zeros((0, 0)))


def _held(spark: SparkSession, index: VectorIndex) -> DataFrame:
    return spark.read.parquet(f"{index.path}/rows").withColumn("cell", F.col("cell").cast("int"))


def recall_by_probes(queries: DataFrame, index: VectorIndex, k: int = 10, skip_same_id: bool = False, sample: int = 256, seed: int = 7) -> DataFrame:
    """(probes, recall): the share of exact top-k hits that a search with so many probes would reach.

    About ``sample`` of the queries, drawn by a hash, are searched exactly over all rows of the index. A hit is reached
    once its cell is probed, so one search tells the recall at every number of probes.
    """
    spark, (cells, size) = queries.sparkSession, index.centroids.shape
    asked = queries.where(_usable(size))
    share = min(1.0, sample / max(1, asked.count()))
    drawn = asked.where(F.pmod(F.xxhash64("query_id", F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30)))
    held = _held(spark, index)
    hits = F.broadcast(cosine_topk(drawn, held.select("passage_id", "embedding"), k, skip_same_id).select("query_id", "passage_id"))
    where = held.select("passage_id", "cell").join(hits, "passage_id")
    order = _with_cells(drawn.select("query_id", "embedding"), index.centroids, cells).select("query_id", "cell", "probe")
    reached = where.join(order, ["query_id", "cell"]).groupBy("query_id", "passage_id").agg(F.min("probe").alias("probe"))
    counts = reached.groupBy("probe").agg(F.count(F.lit(1)).alias("n"))
    grid = spark.range(1, cells + 1).select(F.col("id").cast("int").alias("probes"))
    share = F.sum("n").over(Window.orderBy("probes").rowsBetween(Window.unboundedPreceding, 0)) / F.sum("n").over(Window.partitionBy())
    return grid.join(counts.withColumn("probes", F.col("probe") + 1), "probes", "left").fillna(0, ["n"]).select("probes", share.alias("recall"))


def choose_probes(queries: DataFrame, index: VectorIndex, k: int = 10, target: float = 0.97, skip_same_id: bool = False, sample: int = 256) -> int:
    """The least number of probes whose recall on sampled queries reaches ``target``; all cells if there is no hit."""
    cells = max(1, len(index.centroids))
    if not len(index.centroids):
        return cells
    enough = recall_by_probes(queries, index, k, skip_same_id, sample).where(F.col("recall") >= target)
    return enough.agg(F.min("probes")).first()[0] or cells


def _blocks_of_cells(sizes: dict[int, int], cells: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first block of each cell, and its blocks: cells in their order share one, and a crowded cell has several to itself.

    Cells without a row have none. Blocks hold a ``count``-th of the rows and a cell that is not crowded besides, at most.
    """
    most, first, many = max(1, -(-sum(sizes.values()) // count)), np.full(cells, -1), np.zeros(cells, np.int64)
    block, rows = 0, 0
    for cell in sorted(sizes):
        own = -(-sizes[cell] // most)
        if rows and (own > 1 or rows + sizes[cell] > most):
            block, rows = block + 1, 0
        first[cell], many[cell] = block, own
        if own > 1:
            block, rows = block + own, 0
        else:
            rows += sizes[cell]
    return first, many


def _to_blocks(rows: DataFrame, centroids: np.ndarray, probes: int, first: np.ndarray, many: np.ndarray) -> DataFrame:
    """``rows`` once for each block (``cb``) that holds one of their ``probes`` nearest cells, with the bits of its cells from ``bits_from`` on."""
    cells, size = centroids.shape
    probes, blocks = min(probes, cells), int((first + many).max())
    added = StructType([*rows.schema.fields, StructField("_blocks", ArrayType(IntegerType())), StructField("_bits", BinaryType())])
    step = max(1, min(4096, _SLICE_BYTES // (8 * (3 * cells + 2 * size + blocks))))
    crowded = np.flatnonzero(many > 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                sims = -(_matrix(part.column("embedding"), size) @ centroids.T)
                near = np.argsort(sims, axis=1, kind="stable")[:, :probes]
                hit = np.zeros(sims.shape, bool)
                np.put_along_axis(hit, near, True, axis=1)
                hit &= many > 0
                row, cell = np.nonzero(hit)
                goes = np.zeros((len(hit), blocks), bool)
                goes[row, first[cell]] = True
                for c in crowded:
                    goes[hit[:, c], first[c] : first[c] + many[c]] = True
                ends = np.concatenate([[0], np.cumsum(goes.sum(axis=1))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(ends, np.nonzero(goes)[1].astype(np.int32))
                packed = np.packbits(hit, axis=1)
                ends = (np.arange(len(hit) + 1) * packed.shape[1]).astype(np.int32)
                bits = pa.Array.from_buffers(pa.binary(), len(hit), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(packed.tobytes())])
                yield pa.RecordBatch.from_arrays([*part.columns, lists, bits], [*part.schema.names, "_blocks", "_bits"])

    listed = rows.mapInArrow(place, added).select(*rows.columns, "_bits", F.explode("_blocks").alias("cb"))
    held = [np.flatnonzero((first <= b) & (b < first + many)) for b in range(blocks)]
    begin, end = (F.array(*[F.lit(int(c[i]) // 8) for c in held]) for i in (0, -1))
    own = F.get(begin, F.col("cb"))
    return listed.select(*rows.columns, "cb", F.substring("_bits", own + 1, F.get(end, F.col("cb")) - own + 1).alias("bits"))


def ann_topk(queries: DataFrame, index: VectorIndex, k: int = 10, probes: int = 8, skip_same_id: bool = False, block_rows: int | None = None) -> DataFrame:
    """Best k of the passages in the ``probes`` nearest cells of each query: (query_id, passage_id, similarity, rank).

    Queries are (query_id, embedding). Similarities and the order are those of the exact search; what can be missed are
    passages in cells that are not probed. Cells share blocks of about ``block_rows`` rows, or of bounded bytes, and a crowded
    cell is cut into several. A query is copied once for each block with a cell that it probes, however many these are, and
    meets its own cells there; a passage is copied once per block of queries. Each task holds one block of either side and
    yields k rows per query. Null ids and repeats are treated as by the exact search.
    """
    spark, (cells, size) = queries.sparkSession, index.centroids.shape
    held = _held(spark, index) if cells else None
    passage = held.schema["passage_id"] if cells else StructField("passage_id", LongType())
    found = [queries.schema["query_id"], StructField("query_no", LongType()), passage]
    out = StructType([*found, StructField("similarity", DoubleType())])
    sizes = {r["cell"]: r["n"] for r in held.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()} if cells else {}  # a row per cell at most
    if not sizes:
        return spark.createDataFrame([], out).withColumn("rank", F.lit(0)).drop("query_no")
    usable = queries.where(_usable(size))
    asked = usable.select("query_id", F.xxhash64("query_id", "embedding").alias("query_no"), "embedding").distinct()
    query_blocks, count = block_counts(spark, usable.count(), sum(sizes.values()), size, block_rows)
    first, many = _blocks_of_cells(sizes, cells, count)
    layout = F.broadcast(small_frame(spark, [(c, int(first[c]), int(many[c])) for c in sizes], "cell int, cb int, cbs int"))
    left = _to_blocks(asked, index.centroids, probes, first, many).withColumn("qb", F.pmod(F.xxhash64("query_no"), F.lit(query_blocks)))
    own = F.col("cb") + F.pmod(F.xxhash64("passage_id", "embedding"), F.col("cbs")).cast("int")
    right = held.join(layout, "cell").withColumn("cb", own).withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))))

    def rank(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({f.name: [] for f in out})
        c = c.sort_values("cell", kind="stable")
        cell = c["cell"].to_numpy()
        starts = np.flatnonzero(np.diff(cell, prepend=-1))
        bits = np.frombuffer(b"".join(q["bits"]), np.uint8).reshape(len(q), -1)
        met = np.unpackbits(bits, axis=1)[:, cell[starts] - cell[0] // 8 * 8].astype(bool)
        return blocks_best(q, c, k, skip_same_id, starts=starts, met=met)

    key = ["qb", "cb"]
    partial = left.groupBy(*key).cogroup(right.select(*key, "passage_id", "embedding", "cell").groupBy(*key)).applyInPandas(rank, out)
    order = Window.partitionBy("query_id", "query_no").orderBy(F.desc("similarity"), F.asc("passage_id"))
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("query_no")


def recall_of(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(queries, wanted, recall): the share of the exact hits that were found, a hit as similar as the last one counting too."""
    last = exact.groupBy("query_id").agg(F.count(F.lit(1)).alias("wanted"), F.min("similarity").alias("least"))
    hits = found.join(last, "query_id").where(F.col("similarity") >= F.col("least")).groupBy("query_id").agg(F.count(F.lit(1)).alias("hits"))
    each = last.join(hits, "query_id", "left").select("wanted", F.least(F.coalesce("hits", F.lit(0)), "wanted").alias("hits"))
    return each.agg(F.count(F.lit(1)).alias("queries"), F.sum("wanted").alias("wanted"), (F.sum("hits") / F.sum("wanted")).alias("recall"))
