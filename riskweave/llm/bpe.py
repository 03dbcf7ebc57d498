"""Byte-level BPE with length-bucketed numpy matrices."""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import slices

_NONE = np.int32(2**31 - 1)
#: Pieces, and bytes of pieces and their ids, that a worker remembers; wider pieces are forgotten after their slice.
_CACHED, _CACHED_BYTES = 300_000, 64 << 20
_WIDEST = 256
_CELLS = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class PairTable:
    """(left id, right id) -> id of the joined bytes, in an open hash table looked up for whole arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, _NONE, np.int32)
        left, what = np.array(keys, np.int64), np.array(values, np.int32)
        slot, self.steps = self._slot(left), 1
        while len(left):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = left[free]  # of several, the last one stays
            placed = self.keys[slot] == left
            self.values[slot[placed]] = what[placed]
            left, what, slot = left[~placed], what[~placed], (slot[~placed] + 1) & (len(self.keys) - 1)
            self.steps += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the joined pairs; a padded side (-1) or an unknown pair gives the largest integer."""
        keys = left.astype(np.int64) << 32 | right
        out = np.full(keys.shape, _NONE, np.int32)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        flat, into = keys.ravel(), out.ravel()
        slot = self._slot(flat[open_])
        for _ in range(self.steps):
            if not len(open_):
                break
            there = self.keys[slot]
            same = there == flat[open_]
            into[open_[same]] = self.values[slot[same]]
            on = ~same & (there >= 0)
            open_, slot = open_[on], (slot[on] + 1) & (len(self.keys) - 1)
        return into.reshape(keys.shape)


def narrow(pattern: str, below: int = 0x250) -> str:
    """``pattern`` with its Unicode classes spelt out for code points under ``below``, for the faster ``re``."""
    out, inside = "", False
    for part in re.findall(r"\\p\{\w+\}|\\.|.", pattern, re.S):
        if re.fullmatch(r"\\p\{\w+\}|\\s", part) or part == "\\S":
            fits = regex.compile(part.replace("S", "s") if part == "\\S" else part).fullmatch
            members = "".join(re.escape(chr(c)) for c in range(below) if fits(chr(c)))
            out += members if inside else f"[{'^' * (part == '\\S')}{members}]"
        else:
            inside = part == "[" or (inside and part != "]")
            out += part
    return out


class Encoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.find = ranks, regex.compile(pattern).findall
        self.find_narrow, self.wide = re.compile(narrow(pattern)).findall, re.compile("[^\0-\u024f]").search
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.pairs = PairTable(ranks)
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        if (self.byte < 0).any():
            raise ValueError("a byte-level vocabulary needs all 256 single bytes")
        self.cache: dict[str, bytes] = {}
        self.cached_bytes = 0

    def matrix(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of like length. Each row merges its leftmost pair of the smallest id once a round."""
        sizes = np.array([len(p) for p in pieces])
        width = int(sizes.max())
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        ids = np.where(np.arange(width) < sizes[:, None], self.byte[raw], np.int32(-1))
        done: list = [None] * len(pieces)
        rows = np.arange(len(pieces))
        joined = self.pairs(ids[:, :-1], ids[:, 1:]) if width > 1 else np.zeros((len(pieces), 0), np.int32)
        while len(rows):
            at = joined.argmin(1) if joined.shape[1] else np.zeros(len(rows), np.int64)
            best = joined[np.arange(len(rows)), at] if joined.shape[1] else np.full(len(rows), _NONE)
            over = best == _NONE
            for r in np.flatnonzero(over).tolist():
                done[rows[r]] = ids[r][ids[r] >= 0]
            if over.all():
                break
            on = ~over  # rows that can merge no more leave, and the columns close up behind each merge
            rows, ids, joined, at, best = rows[on], ids[on], joined[on], at[on], best[on]
            all_rows = np.arange(len(rows))
            ids[all_rows, at] = best
            columns = np.arange(ids.shape[1] - 1) + (np.arange(ids.shape[1] - 1) > at[:, None])
            ids = np.take_along_axis(ids, columns, 1)
            if ids.shape[1] < 2:
                joined = np.zeros((len(rows), 0), np.int32)
                continue
            columns = np.arange(joined.shape[1] - 1) + (np.arange(joined.shape[1] - 1) >= at[:, None])
            joined = np.take_along_axis(joined, columns, 1)
            right = np.flatnonzero(at < joined.shape[1])
            joined[right, at[right]] = self.pairs(ids[right, at[right]], ids[right, at[right] + 1])
            left = np.flatnonzero(at > 0)
            joined[left, at[left] - 1] = self.pairs(ids[left, at[left] - 1], ids[left, at[left]])
        return done

    def long_piece(self, piece: bytes) -> np.ndarray:
        """The same merges for one piece wider than any bucket, with a heap, as a round must not cost its whole length."""
        ids = [int(self.byte[b]) for b in piece]
        before, after = list(range(-1, len(ids) - 1)), [*range(1, len(ids)), -1]
        first = self.pairs(np.array(ids[:-1]), np.array(ids[1:]))
        heap = [(int(first[i]), i, ids[i], ids[i + 1]) for i in np.flatnonzero(first != _NONE).tolist()]
        heapq.heapify(heap)
        tokens, ranks = self.tokens, self.ranks
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j < 0 or ids[j] != right:
                continue
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (new := ranks.get(tokens[ids[a]] + tokens[ids[b]])) is not None:
                    heapq.heappush(heap, (new, a, ids[a], ids[b]))
        return np.array([i for i in ids if i >= 0], np.int32)

    def learn(self, pieces: set[str]) -> None:
        """Put the ids of pieces that are not yet known into the cache, as little-endian 32-bit integers."""
        if len(self.cache) > _CACHED or self.cached_bytes > _CACHED_BYTES:
            self.cache.clear()
            self.cached_bytes = 0
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            if piece in self.cache:
                continue
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                self.cache[piece] = rank.to_bytes(4, "little")
                self.cached_bytes += len(raw) + 4
            elif len(raw) > _WIDEST:
                self.cache[piece] = self.long_piece(raw).astype("<u4").tobytes()
            else:
                buckets.setdefault(-(-len(raw) // 4) if len(raw) < 32 else 8 + len(raw).bit_length(), []).append((piece, raw))
        for bucket in buckets.values():
            step = max(1, _CELLS // max(len(raw) for _, raw in bucket))
            for at in range(0, len(bucket), step):
                part = bucket[at : at + step]
                for (piece, _), ids in zip(part, self.matrix([raw for _, raw in part]), strict=True):
                    self.cache[piece] = ids.astype("<u4").tobytes()
                    self.cached_bytes += len(piece) + 4 * len(ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [(self.find if self.wide(t) else self.find_narrow)(t) for t in texts]
        pieces = set().union(*split)
        self.learn(pieces)
        get = self.cache.__getitem__
        ids = [b"".join(map(get, s)) for s in split]
        for piece in pieces:
            if len(piece) > _WIDEST // 4 and len(piece.encode()) > _WIDEST:
                del self.cache[piece]
        return ids

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder(vocabulary, pattern: str) -> Encoder:
    """One per Python worker and vocabulary."""
    ranks = vocabulary.value
    at = (ranks["name"], pattern)
    if at not in _ENCODERS:
        _ENCODERS[at] = Encoder(ranks["ranks"], pattern)
    return _ENCODERS[at]


def _texts(batch: pa.RecordBatch) -> list[str]:
    return [t.decode("utf-8", "replace") for t in batch.column("text").to_pylist()]


def _vocabulary(docs: DataFrame, path: str):
    """Read by the driver, so executors need no file; its size is that of the vocabulary, whatever the corpus."""
    ranks = read_ranks(path)
    name = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()
    return docs.sparkSession.sparkContext.broadcast({"name": name, "ranks": ranks})


def _input(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids) per row; ``ids`` are little-endian unsigned 32-bit integers, without special tokens.

    Null texts are empty and have no ids. Texts are encoded whole; each match of ``pattern`` is merged on its own.
    """
    vocabulary = _vocabulary(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, pattern)
        for batch in slices(batches):
            ids = encoder.encode(_texts(batch))
            counts = pa.array([len(i) // 4 for i in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), counts, pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    return _input(docs).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, text as bytes) per row of (doc_id, ids)."""
    vocabulary = _vocabulary(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, pattern)
        for batch in slices(batches, "ids"):
            texts = [encoder.decode(i) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "text"])

    return encoded.select("doc_id", F.coalesce("ids", F.lit(b"")).alias("ids")).mapInArrow(run, "doc_id long, text binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row: encoded, then decoded from the ids alone."""
    vocabulary = _vocabulary(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, pattern)
        for batch in slices(batches):
            ids = encoder.encode(_texts(batch))
            columns = [
                batch.column("doc_id"),
                pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                pa.array([hashlib.sha256(encoder.decode(i)).hexdigest() for i in ids], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _input(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
