"""Exact nearest passages of dense vectors, and the records built from the hits."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType
from pyspark.sql.window import Window

from riskweave.functions import fixed
from riskweave.functions import scalars as sc
from riskweave.functions import text as tx

#: Bytes of a tile, and the arrays as large as its similarities that live at once: themselves, their partition and masks.
_TILE_BYTES, _COPIES = 64 << 20, 3
#: Bytes of the numbers of a block of either side, passages that a tile meets at a time, and the most that share one largest similarity.
_BLOCK_BYTES, _STRIP, _CHUNK = 32 << 20, 4096, 64
#: Rows from which a side is cut for the sake of more tasks.
_LEAST_ROWS = 4096
_DIGITS = 9  # similarities equal to this many digits are ties, ordered by passage id


def corpus_passages(df: DataFrame, passage_id: str = "paragraph_id", text: str = "text") -> DataFrame:
    """Passages worth indexing: stripped length of at least ten characters."""
    return df.where(tx.long_enough(F.col(text))).select(F.col(passage_id).alias("passage_id"), F.col(text).alias("text"))


def unit_rows(vectors: pd.Series) -> np.ndarray:
    m = np.array(vectors.to_list(), dtype=np.float64)
    length = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, length, out=np.zeros_like(m), where=length > 0)


def _own_cells(own: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, passage) with equal ids, by passage; a number that is missing equals none."""
    codes, _ = pd.factorize(np.concatenate([own, ids]))
    if own.dtype != object and ids.dtype != object:
        codes = np.where(codes < 0, -1 - np.arange(len(codes)), codes)
    mine, theirs = codes[: len(own)], codes[len(own) :]
    order = np.argsort(theirs, kind="stable")
    start, stop = (np.searchsorted(theirs[order], mine, side) for side in ("left", "right"))
    n = stop - start
    row, column = np.repeat(np.arange(len(own)), n), order[np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    by_column = np.argsort(column, kind="stable")
    return row[by_column], column[by_column]


def _exact_best(asked: np.ndarray, passages: np.ndarray, places: np.ndarray, row: np.ndarray, column: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best k pairs of each row with their similarities; ties in the order of ``places``."""
    sims, step = np.empty(len(row)), max(1, _BLOCK_BYTES // (64 * asked.shape[1]))
    for at in range(0, len(row), step):
        part = slice(at, at + step)
        sims[part] = np.einsum("ij,ij->i", asked[row[part]], passages[column[part]])
    np.round(sims, _DIGITS, out=sims)
    order = np.lexsort((places[column], -sims, row))
    row, column, sims = row[order], column[order], sims[order]
    first = np.flatnonzero(np.diff(row, prepend=-1))
    kept = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row)))) < k
    return row[kept], column[kept], sims[kept]


def blocks_best(
    q: pd.DataFrame, c: pd.DataFrame, k: int, skip_same: bool, tile_bytes: int = _TILE_BYTES, starts: np.ndarray | None = None, met: np.ndarray | None = None
) -> pd.DataFrame:
    """Top k of a block of queries against a block of passages; ties by passage id.

    Strips of passages begin at ``starts``, and ``met`` tells which queries meet which strip; all do without it. A tile of
    queries and a strip are multiplied in single precision. The largest similarities of a few passages each give a bound for
    the k-th best, which rises from strip to strip; only pairs within the rounding error of it are worked out in double.
    Arrays of a tile take ``tile_bytes`` together, and pairs are cut to k for each query before they are many.
    """
    ids, passages, asked, own = c["passage_id"].to_numpy(), unit_rows(c["embedding"]), unit_rows(q["embedding"]), q["query_id"].to_numpy()
    starts = np.arange(0, len(ids), _STRIP) if starts is None else starts
    can_ask, can_be = np.isfinite(asked).all(axis=1), np.isfinite(passages).all(axis=1)
    small, others = np.where(can_ask[:, None], asked, 0).astype(np.float32), np.where(can_be[:, None], passages, 0).astype(np.float32)
    codes, _ = pd.factorize(ids, sort=True)
    places = np.where(codes < 0, len(ids), codes)
    slack = (asked.shape[1] + 8) * 2.0**-22 + 10.0**-_DIGITS
    best = np.full((len(own), k), -np.inf, np.float32)
    same_row, same_column = _own_cells(own, ids) if skip_same else (np.empty(0, np.int64),) * 2
    held, count = [], 0

    def cut() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, column, sims = (np.concatenate([h[i] for h in held]) for i in range(3)) if held else (np.empty(0, np.int64),) * 3
        near = sims >= best.min(axis=1)[row] - slack
        return _exact_best(asked, passages, places, row[near].astype(np.int64), column[near], k)

    for strip, (start, stop) in enumerate(zip(starts, np.append(starts[1:], len(ids)), strict=True)):
        wide, chosen = stop - start, np.flatnonzero(can_ask if met is None else can_ask & met[:, strip])
        width = int(min(_CHUNK, max(4, wide // (4 * k))))
        firsts, step = np.arange(0, wide, width), max(1, tile_bytes // (_COPIES * 8 * wide))
        skipped = slice(*np.searchsorted(same_column, [start, stop]))
        lost = np.flatnonzero(~can_be[start:stop])
        for at in range(0, len(chosen), step):
            rows = chosen[at : at + step]
            sims = small[rows] @ others[start:stop].T
            if len(lost):
                sims[:, lost] = -np.inf
            where = np.minimum(np.searchsorted(rows, same_row[skipped]), len(rows) - 1)
            here = rows[where] == same_row[skipped]
            sims[where[here], same_column[skipped][here] - start] = -np.inf
            most = np.maximum.reduceat(sims, firsts, axis=1)
            both = np.concatenate([best[rows], most], axis=1)
            best[rows] = np.partition(both, both.shape[1] - k, axis=1)[:, both.shape[1] - k :]
            bar = best[rows].min(axis=1) - np.float32(slack)
            row, chunk = np.nonzero((most >= bar[:, None]) & (most > -np.inf))
            column = firsts[chunk][:, None] + np.arange(width)
            value = sims[row[:, None], np.minimum(column, wide - 1)]
            i, j = np.nonzero((column < wide) & (value >= bar[row][:, None]) & (value > -np.inf))
            held.append((rows[row[i]].astype(np.int32), column[i, j] + start, value[i, j]))
            count += len(i)
            if count > max(4 * k * len(own), tile_bytes // 64):
                held = [cut()]
                count = len(held[0][0])
    row, column, sims = cut()
    return pd.DataFrame({"query_id": own[row], "query_no": q["query_no"].to_numpy()[row], "passage_id": ids[column], "similarity": sims})


def block_counts(spark: SparkSession, queries: int, passages: int, size: int, block_rows: int | None) -> tuple[int, int]:
    """Blocks of either side: of ``block_rows``, or of bounded bytes, and enough of them that all cores have work."""
    most = block_rows or max(1, _BLOCK_BYTES // (8 * max(size, 1)))
    spread = math.isqrt(2 * spark.sparkContext.defaultParallelism - 1) + 1
    return tuple(max(1, -(-n // most), min(spread, n // _LEAST_ROWS)) for n in (queries, passages))


def cosine_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 2,
    skip_same_id: bool = False,
    block_rows: int | None = None,
    tile_bytes: int = _TILE_BYTES,
) -> DataFrame:
    """Best k passages per query: (query_id, passage_id, similarity, rank).

    Both inputs are (id, vector) under the names ``query_id``/``passage_id`` and ``embedding``.
    The search is exact. Both sides are cut into hash blocks of about ``block_rows`` rows, or of bounded bytes; each
    pair of blocks is multiplied in its own task, in tiles of at most ``tile_bytes``, and yields k
    rows per query, which a window merges. Block and tile size do not change the result. NULL
    vectors and vectors with NULL entries are neither queries nor passages. A query that repeats
    an id and a vector is answered once; an id with several vectors gets k ranks for each.
    """
    usable = F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull())
    found = [queries.schema["query_id"], StructField("query_no", LongType()), corpus.schema["passage_id"]]
    out = StructType([*found, StructField("similarity", DoubleType())])
    number = F.xxhash64("query_id", "embedding")
    asked = queries.where(usable).select("query_id", number.alias("query_no"), "embedding").distinct()
    held = corpus.where(usable).select("passage_id", "embedding")
    there = held.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("size")).first()
    query_blocks, corpus_blocks = block_counts(queries.sparkSession, asked.count(), there["n"], there["size"] or 1, block_rows)

    def block(hashed: Column, count: int) -> Column:
        return F.pmod(hashed, F.lit(count))

    def spread(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    left = asked.withColumn("qb", block(F.xxhash64("query_no"), query_blocks)).withColumn("cb", spread(corpus_blocks))
    right = held.withColumn("cb", block(F.xxhash64("passage_id", "embedding"), corpus_blocks)).withColumn("qb", spread(query_blocks))

    def multiply(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({f.name: [] for f in out})
        return blocks_best(q, c, k, skip_same_id, tile_bytes)

    partial = left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb")).applyInPandas(multiply, out)
    order = Window.partitionBy("query_id", "query_no").orderBy(F.desc("similarity"), F.asc("passage_id"))
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("query_no")


def context_blocks(hits: DataFrame, passages: DataFrame) -> DataFrame:
    """One numbered context text per query from its few ranked hits."""
    texts = hits.join(passages.select("passage_id", "text"), "passage_id")
    numbered = F.array_sort(F.collect_list(F.struct("rank", "text")))  # k elements at most
    blocks = F.transform(
        numbered,
        lambda h: F.concat(
            F.lit("POLICY MODULE "), h.getField("rank").cast("string"), F.lit(":\n"), h.getField("text"), F.lit("\n\n")
        ),
    )
    return texts.groupBy("query_id").agg(F.array_join(blocks, "").alias("context_text"))


PROMPT_TEMPLATE = (
    "Audit task: decide whether the policy context supports the explanation of a risk score.\n\n"
    "EXPLANATION:\n\"{explanation}\"\n\n"
    "CONTEXT:\n{context}\n"
    "Answer " + fixed.VERDICT_GROUNDED + " with one sentence of reason when the context clearly supports it, "
    + fixed.VERDICT_PARTIAL + " when the variables occur but their limits are unclear, "
    + fixed.VERDICT_UNSUPPORTED + " when the context does not mention them.\n"
)


def chunk_passages(df: DataFrame, row_id: str, text: str, **sizes: int) -> DataFrame:
    """Rows (passage_id, id, chunk_no, text): overlapping chunks as passages of their own, named ``id:chunk_no``.

    Texts that are NULL give none, empty ones an empty chunk.
    """
    pieces = df.select(row_id, F.posexplode(tx.chunks(F.col(text), **sizes)).alias("chunk_no", "text"))
    name = F.concat_ws(":", F.col(row_id).cast("string"), F.col("chunk_no").cast("string"))
    return pieces.select(name.alias("passage_id"), row_id, "chunk_no", "text")


def prompt_rows(df: DataFrame, explanation: str, context: str, template: str = PROMPT_TEMPLATE) -> DataFrame:
    """Add ``prompt``: the template with both placeholders filled, ready for any scorer."""
    head, rest = template.split("{explanation}")
    middle, tail = rest.split("{context}")
    parts = [F.lit(head), F.col(explanation), F.lit(middle), F.coalesce(F.col(context), F.lit("")), F.lit(tail)]
    return df.withColumn("prompt", F.concat(*parts))


def rule_verdict(grounding: Column) -> Column:
    """Verdict text from the grounding score, for use when no judge can be reached."""
    cuts = [(fixed.GROUNDING_WEAK, fixed.VERDICT_UNSUPPORTED), (fixed.GROUNDING_FAIR, fixed.VERDICT_PARTIAL)]
    return sc.below(grounding, cuts, fixed.VERDICT_GROUNDED)


def clearance(verdict: Column) -> Column:
    """Outcome of a verdict text; anything that is not a known marker blocks the explanation."""
    upper = F.upper(verdict)
    return (
        F.when(F.contains(upper, F.lit(fixed.VERDICT_GROUNDED)), fixed.CLEARANCE_GRANTED)
        .when(F.contains(upper, F.lit(fixed.VERDICT_PARTIAL)), fixed.CLEARANCE_MANUAL)
        .otherwise(fixed.CLEARANCE_BLOCKED)
    )
