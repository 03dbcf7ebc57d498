"""Benchmark decontamination: size-partitioned MinHash containment search with exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import LAST_KEY, keyed, slices, stored, with_verdict
from riskweave.llm.words import bit_set, in_set, lowered, plain_words

WORDS, THRESHOLD = 5, 0.8
_MOST_BITS = 26


def _item_shingles(k_most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = plain_words(lowered(batch.column("text")))
            found = []
            for k in range(1, k_most + 1):
                at, hashes = words.shingles(k)
                rows = words.rows[at] if len(at) else at
                fits = np.minimum(words.counts, k_most)[rows] == k if len(at) else np.zeros(0, bool)
                found += [(int(r), k, int(h), words.span(i, k)) for r, h, i in zip(rows[fits], hashes[fits].view(np.int64), at[fits], strict=True)]
            take = pa.array([f[0] for f in found], pa.int64())
            columns = [batch.column(c).take(take) for c in ("key", "digest")]
            columns += [pa.array([f[j] for f in found], t) for j, t in ((1, pa.int32()), (2, pa.int64()), (3, pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, ["item", "item_digest", "k", "hash", "shingle"])

    return run


def benchmark_index(items: DataFrame, words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """(item, item_digest, k, hash, shingle, n_shingles, in_sketch): distinct shingles of each item.

    Items are partitioned by size: class c holds those of 2^c to 2^(c+1)-1 shingles. An item's sketch are its smallest
    hashes, as many as the largest item of its class may miss at the threshold, and one more. A text that holds enough of
    the item therefore holds at least one hash of its sketch, however long the text is. Items of fewer than ``words``
    words are one shingle of their own length; items without words match nothing.
    """
    texts = items.withColumnRenamed("item_id", "doc_id") if "doc_id" not in items.columns else items.drop("doc_id").withColumnRenamed("item_id", "doc_id")
    rows = keyed(texts).select("key", "digest", "text").distinct().mapInArrow(_item_shingles(words), "item long, item_digest long, k int, hash long, shingle binary")
    rows = rows.distinct()
    item = Window.partitionBy("item", "item_digest")
    rows = rows.withColumn("n_shingles", F.count(F.lit(1)).over(item)).withColumn("place", F.row_number().over(item.orderBy("hash", "shingle")))
    largest = F.expr("shiftleft(1L, cast(floor(log2(n_shingles)) AS int) + 1) - 1")
    # rounding up by a little can only lengthen a sketch
    return rows.withColumn("in_sketch", F.col("place") <= F.floor(largest * (1 - threshold) + 1e-9) + 1).drop("place")


def _hits(lengths: list[int], sketch: np.ndarray, every: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = plain_words(lowered(batch.column("text")))
            rows, hashes, spans = [], [], []
            for k in lengths:
                at, h = words.shingles(k)
                if not len(at):
                    continue
                hit = np.flatnonzero(in_set(every, h))
                at, h = at[hit], h[hit]
                row = words.rows[at]
                begun = np.zeros(batch.num_rows, bool)
                begun[row[in_set(sketch, h)]] = True
                keep = begun[row]
                for r, x, i in zip(row[keep].tolist(), h[keep].view(np.int64).tolist(), at[keep].tolist(), strict=True):
                    rows.append(r)
                    hashes.append(x)
                    spans.append(words.span(i, k))
            take = pa.array(rows, pa.int64())
            columns = [*(batch.column(c).take(take) for c in ("key", "digest")), pa.array(hashes, pa.int64()), pa.array(spans, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "digest", "hash", "shingle"])

    return run


def contaminated(docs: DataFrame, items: DataFrame, words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """(key, digest, item, n_shingles, n_shared): documents and the items of which they hold ``threshold`` or more.

    Documents are hashed once, in place. Two bit tables of bounded size go to the tasks: one of all sketches, one of all
    items' shingles; only shingles of documents that touch a sketch leave the scan. They are joined with sketches into
    candidates, and with the items' shingles, as text, into exact counts. Nothing is broadcast by hand.
    """
    index = stored(benchmark_index(items, words, threshold), "benchmark_index")
    lengths = [r[0] for r in index.select("k").distinct().collect()]  # at most ``words`` values
    bits = min(_MOST_BITS, max(12, math.ceil(math.log2(1 + index.count())) + 8))
    every, sketch = bit_set(index, "hash", bits), bit_set(index.where("in_sketch"), "hash", bits)
    found = keyed(docs).select("key", "digest", "text").mapInArrow(_hits(lengths, sketch, every), "key long, digest long, hash long, shingle binary")
    hits = stored(found, "benchmark_hits").distinct()
    pair = ["key", "digest", "item", "item_digest"]
    candidates = hits.join(index.where("in_sketch").select("hash", "shingle", "item", "item_digest"), ["hash", "shingle"]).select(pair).distinct()
    shared = hits.join(index.select("hash", "shingle", "item", "item_digest", "n_shingles"), ["hash", "shingle"])
    counts = shared.groupBy(*pair, "n_shingles").agg(F.count(F.lit(1)).alias("n_shared"))
    exact = counts.where(F.col("n_shared") >= F.ceil(F.col("n_shingles") * threshold - 1e-9))
    return exact.join(candidates, pair, "left_semi")


def benchmark_pairs(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared, containment), one row per document and item it holds.

    Null ids stay null. Null and empty texts hold nothing and are held by nothing. Repeated rows count once.
    """
    known = lambda c: F.when(F.col(c) != LAST_KEY, F.col(c))
    found = contaminated(docs, items)
    return found.select(known("key").alias("doc_id"), known("item").alias("item_id"), "n_shingles", "n_shared", (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item; all columns stay."""
    return with_verdict(docs, contaminated(docs, items).select("key", "digest").distinct(), "left_anti")
