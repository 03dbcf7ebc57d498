"""Substring dedup: super-k-mers of words, whose buckets count windows exactly by sorting."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import keyed
from riskweave.llm.superwindows import Bucket, Spans, covered, spans, word_units

WINDOW, GRAM = 20, 4


def _ranks(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.unique(left.astype(np.int64) * (int(right.max(initial=0)) + 1) + right, return_inverse=True)[1]


def window_ranks(ids: np.ndarray, size: int) -> np.ndarray:
    """Equal numbers for equal runs of ``size`` ids: ranks of 1, 2, 4, ... ids, each by sorting pairs of the last."""
    ranks, width, out, have = ids, 1, None, 0
    while True:
        if size & width:  # windows are put together from their powers of two, left to right
            n = len(ids) - have - width + 1
            out = ranks[:n] if out is None else _ranks(out[:n], ranks[have : have + n])
            have += width
        width *= 2
        if width > size:
            return out
        n = len(ids) - width + 1
        ranks = _ranks(ranks[:n], ranks[width // 2 : width // 2 + n])


def _later(size: int):
    def judge(bucket: Bucket) -> Spans:
        """Windows that also start earlier, by (key, place)."""
        order = np.lexsort((bucket.first, bucket.key))
        heads: dict[bytes, int] = {}
        whole, reps = [], []
        for i in order.tolist():
            head = heads.setdefault(bucket.chunks[i], i)
            if (bucket.key[i], bucket.first[i]) > (bucket.key[head], bucket.first[head]):
                whole.append(i)  # the same string starts earlier, so each of its windows does
            else:
                reps.append(i)
        whole, reps = np.array(whole, np.int64), np.array(reps, np.int64)
        names: dict[bytes, int] = {}
        ids = np.array([names.setdefault(w, len(names)) for i in reps for w in bucket.chunks[i].split(b" ")], np.int64)
        windows = bucket.n[reps].astype(np.int64)
        begin = np.concatenate(([0], np.cumsum(windows + size - 1)[:-1])).astype(np.int64)
        owner = np.repeat(np.arange(len(reps)), windows)
        offset = np.arange(len(owner)) - np.repeat(np.concatenate(([0], np.cumsum(windows)[:-1])), windows)
        rank = window_ranks(ids, size)[begin[owner] + offset]
        key, place = bucket.key[reps][owner], bucket.first[reps][owner] + offset
        order = np.lexsort((place, key, rank))
        r = rank[order]
        new = np.ones(len(r), bool)
        new[1:] = r[1:] != r[:-1]
        head = order[np.maximum.accumulate(np.where(new, np.arange(len(r)), 0))]
        gone = np.zeros(len(r), bool)
        gone[order] = (key[order] != key[head]) | (place[order] != place[head])
        starts = np.flatnonzero(gone & np.concatenate(([True], ~gone[:-1] | (owner[1:] != owner[:-1]))))
        ends = np.flatnonzero(gone & np.concatenate((~gone[1:] | (owner[1:] != owner[:-1]), [True]))) + 1
        return (
            np.concatenate((whole, reps[owner[starts]])),
            np.concatenate((np.zeros(len(whole), np.int64), offset[starts])),
            np.concatenate((bucket.n[whole], ends - starts)),
        )

    return judge


def repeated_windows(docs: DataFrame, size: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(key, digest, spans): runs of word windows whose sequence starts earlier in the corpus, per document with any."""
    return spans(docs, size, gram, word_units, _later(size), both_ways=False, orders=1)


def cut_words(text: bytes, found: list | None, size: int = WINDOW) -> tuple[bytes, int, int]:
    """(kept words joined by a space, words, removed words)."""
    words = text.split()
    gone = covered(found, len(words), size)
    kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if found else words
    return b" ".join(kept), len(words), len(words) - len(kept)


def _digests(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = [cut_words(t, s, size) for t, s in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True)]
            columns = [batch.column("doc_id"), pa.array([c[1] for c in cut], pa.int64()), pa.array([c[2] for c in cut], pa.int64())]
            columns.append(pa.array([hashlib.sha256(c[0]).hexdigest() for c in cut], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return run


def word_digest(docs: DataFrame, size: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) per row, after cutting words in windows that start earlier.

    Earlier is a smaller id, or the same id and a smaller place. Null texts have no words; a null id ranks as the largest.
    Rows that share an id are one document in that order, so neither loses a window to the other at the same place.
    """
    joined = keyed(docs).join(repeated_windows(docs, size, gram), ["key", "digest"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_digests(size), "doc_id long, n_words long, n_removed long, kept_sha256 string")
