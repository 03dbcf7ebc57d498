"""SimHash near-duplicates through meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import LAST_KEY, keyed, slices, stored, with_verdict
from riskweave.llm.components import components

_BLOCK = 1 << 15


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Signed 64-bit fingerprint of one text; zero without words."""
    joined = b" ".join(text.lower().split())  # on bytes, both know only A-Z and \\x20 \\x09-\\x0D
    if not joined:
        return 0
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(joined)]))
    if len(starts) >= shingle:
        starts, ends = starts[: len(starts) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    of = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _BLOCK):
        span = zip(starts[at : at + _BLOCK].tolist(), ends[at : at + _BLOCK].tolist(), strict=True)
        hashes = np.array([of(joined[s:e], seed) for s, e in span], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        prints = pa.array([fingerprint(t) for t in batch.column("text").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("digest"), prints], ["key", "digest", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(key, digest, fp) per row, from whole texts: bit b is set if it is set in over half of the shingles' hashes."""
    return keyed(docs).select("key", "digest", "text").mapInArrow(_fingerprints, "key long, digest long, fp long")


def ball_links(prints: DataFrame) -> DataFrame:
    """(a, b) links that join all of ``prints`` (distinct ``fp``) at two or fewer differing bits.

    Every fingerprint emits itself and its 64 one-bit neighbours. Two fingerprints differ in at most two bits exactly if
    they emit a common variant, so nothing is missed and no bit block can become a hot key: one variant is emitted by at
    most 65 distinct fingerprints. Linking neighbours in sorted order inside a variant keeps its group connected without
    emitting its pairs.
    """
    balls = prints.select("fp", F.explode(F.expr("concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))")).alias("variant"))
    before = F.lag("fp").over(Window.partitionBy("variant").orderBy("fp"))
    return balls.select(F.col("fp").alias("a"), before.alias("b")).where("b is not null and bit_count(a ^ b) <= 2").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, fp, component_id, first_digest) per row of ``docs``.

    The component is the smallest id reachable over links, and ``first_digest`` tells which text of that id comes first.
    Null or empty texts have fingerprint zero and link like any other. A null id stays null in the result, ranks as the
    largest id, and names a component (as null) only if all its ids are null. Repeated rows are returned as often as
    they come. Equal fingerprints are one node, so copies are never paired.
    """
    rows = stored(fingerprints(docs), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min(F.struct("key", "digest")).alias("root"))
    labels = components(ball_links(nodes.select("fp")))
    nodes = nodes.join(labels, nodes.fp == labels.node, "left").select("fp", "root", F.coalesce("label", "fp").alias("label"))
    lows = nodes.groupBy("label").agg(F.min("root").alias("low"))
    named = nodes.join(lows, "label").select("fp", "low")
    known = lambda c: F.when(c != LAST_KEY, c)
    return rows.join(named, "fp", "left").select(
        known(F.col("key")).alias("doc_id"), "digest", "fp", known(F.col("low.key")).alias("component_id"), F.col("low.digest").alias("first_digest")
    )


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay when one document of each group is kept: smallest id, then smallest text digest.

    A row that repeats the id and the text of the kept one is the same document and stays with it.
    """
    groups = near_duplicates(docs).where("doc_id <=> component_id and digest = first_digest")
    kept = groups.select(F.coalesce("doc_id", F.lit(LAST_KEY)).alias("key"), "digest").distinct()
    return with_verdict(docs, kept, "left_semi")
