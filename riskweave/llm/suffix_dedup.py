"""Suffix-array dedup: induced sorting of shards, permuted common prefixes, and removal of repeated byte strings.

Shards are buckets of minimisers: all places where two equal strings of ``size`` bytes can begin are in one shard, so the
shard arrays need no merging.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import keyed
from riskweave.llm.superwindows import Bucket, Spans, byte_units, covered, spans
from riskweave.llm.words import mix, powers, running

SIZE, GRAM = 200, 32
_SHARD = 3 << 20


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than the next one. Runs of one symbol take the type of what follows; the last is smaller."""
    rise = np.zeros(len(text), np.int8)
    rise[:-1] = np.sign(text[1:].astype(np.int32) - text[:-1])
    rise[-1] = 1
    at = np.where(rise != 0, np.arange(len(text)), len(text) - 1)
    return rise[np.minimum.accumulate(at[::-1])[::-1]] > 0


def _deal(suffixes: np.ndarray, text: np.ndarray, into: list[list[np.ndarray]], own: int) -> np.ndarray:
    """Append suffixes to the lists of their first symbols, in order; those of symbol ``own`` are returned instead."""
    symbol = text[suffixes]
    same = symbol == own
    rest, symbol = suffixes[~same], symbol[~same]
    if len(rest):
        order = np.argsort(symbol, kind="stable")
        rest, symbol = rest[order], symbol[order]
        cuts = [0, *(np.flatnonzero(symbol[1:] != symbol[:-1]) + 1).tolist(), len(rest)]
        for begin, end in pairwise(cuts):
            into[symbol[begin]].append(rest[begin:end])
    return suffixes[same]


_EMPTY = np.zeros(0, np.int64)


def induce(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """Order of all suffixes that follows from the order of the leftmost-smaller ones in ``lms``, in linear time.

    Each bucket of a first symbol is one array operation for each place in a run of that symbol: its larger suffixes are
    induced in rising order from what stands before them, its smaller ones in falling order from what stands behind.
    """
    larger: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    seeds: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    _deal(lms, text, seeds, -1)

    def before(suffixes: np.ndarray, kind: bool) -> np.ndarray:
        left = suffixes[suffixes > 0] - 1
        return left[smaller[left] == kind]

    sorted_larger = []
    for c in range(symbols):
        wave = np.concatenate(larger[c]) if larger[c] else _EMPTY
        done = []
        while len(wave):
            done.append(wave)
            wave = _deal(before(wave, False), text, larger, c)
        if seeds[c]:
            _deal(before(np.concatenate(seeds[c]), False), text, larger, -1)
        sorted_larger.append(np.concatenate(done) if done else _EMPTY)
    falling: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    if smaller[-1]:
        falling[text[-1]].append(np.array([len(text) - 1]))  # nothing stands behind the last suffix to induce it
    out = [_EMPTY] * symbols
    for c in range(symbols - 1, -1, -1):
        wave = np.concatenate(falling[c]) if falling[c] else _EMPTY
        done = []
        while len(wave):
            done.append(wave)
            wave = _deal(before(wave, True), text, falling, c)
        _deal(before(sorted_larger[c][::-1], True), text, falling, -1)
        out[c] = np.concatenate((sorted_larger[c], np.concatenate(done)[::-1])) if done else sorted_larger[c]
    return np.concatenate(out)


def _order(names: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the suffixes of a string of names by their first ``depth`` names or more.

    Each level sorts pairs of the last level's ranks, and only where ranks are still shared.
    """
    order = np.argsort(names, kind="stable")
    sorted_names = names[order]
    place = np.arange(len(names))
    heads = np.maximum.accumulate(np.where(np.append(True, sorted_names[1:] != sorted_names[:-1]), place, 0))
    rank = np.empty(len(names), np.int64)
    rank[order] = heads
    width, shared = 1, place
    while width < depth:
        new = np.append(heads[1:] != heads[:-1], True)  # the last of its group
        shared = shared[~(new & np.append(True, new[:-1]))]  # groups of one are settled
        if not len(shared):
            break
        at = order[shared]
        behind = at + width
        second = np.where(behind < len(rank), rank[np.minimum(behind, len(rank) - 1)] + 1, 0)
        key = rank[at] * (len(rank) + 1) + second
        by = np.argsort(key)
        at, key = at[by], key[by]
        order[shared] = at
        heads = shared[np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), np.arange(len(key)), 0))]
        rank[at] = heads
        width *= 2
    return rank


def suffix_array(text: np.ndarray, symbols: int = 258, depth: int = SIZE) -> np.ndarray:
    """Suffixes of ``text`` in order of their first ``depth`` symbols or more, by induced sorting.

    ``text`` ends with symbol 0, which is nowhere else. Suffixes are classified, substrings between leftmost-smaller suffixes are sorted by one
    induction and named, the string of names is sorted by recursion on pairs of names, and a second induction sorts all.
    Every substring has two symbols or more, so half of ``depth`` names are enough.
    """
    smaller = suffix_types(text)
    is_lms = smaller.copy()
    is_lms[0] = False
    is_lms[1:] &= ~smaller[:-1]
    lms = np.flatnonzero(is_lms)
    if len(lms) < 2:
        return induce(text, smaller, lms, symbols)
    first = induce(text, smaller, lms, symbols)
    first = first[is_lms[first]]
    place = np.cumsum(is_lms) - 1  # of a leftmost-smaller suffix among them, in the order of the text
    ends = np.append(lms[1:], len(text) - 1) + 1
    sums, inverse = running(text.astype(np.uint16)), powers(len(text))[1]
    substring = mix((sums[ends] - sums[lms]) * inverse[lms] + (ends - lms).astype(np.uint64))
    named = substring[place[first]]
    names = np.empty(len(lms), np.int64)
    names[place[first]] = np.cumsum(np.concatenate(([0], named[1:] != named[:-1])))
    rank = _order(names, depth // 2 + 1)
    return induce(text, smaller, lms[np.argsort(rank, kind="stable")], symbols)


def permuted_prefixes(raw: bytes, order: np.ndarray, window: np.ndarray, size: int) -> np.ndarray:
    """For each place, how many leading bytes its suffix shares with the one before it in ``order``, in eights up to ``size``.

    Only places and neighbours where ``window`` is true are compared; others share nothing. The result is in the order of
    the text.
    """
    eights = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    out = np.zeros(len(raw), np.int32)
    both = window[order[1:]] & window[order[:-1]]
    here, there = order[1:][both], order[:-1][both]
    for step in [*range(0, size - 7, 8), size - 8]:
        same = eights[here + step] == eights[there + step]
        here, there = here[same], there[same]
        if not len(here):
            break
        out[here] = step + 8
    return out


def repeated_places(chunks: list[bytes], size: int = SIZE) -> list[np.ndarray]:
    """For each string, the places from which ``size`` bytes start that start at another place of any of the strings too."""
    raw = b"\0".join(chunks) + b"\0" * 8
    text = np.frombuffer(raw, np.uint8).astype(np.int16) + 2
    ends = np.cumsum([len(c) + 1 for c in chunks]) - 1
    begins = np.concatenate(([0], ends[:-1] + 1))
    text[ends] = 1
    text[ends[-1]] = 0
    text = text[: ends[-1] + 1]
    window = np.zeros(len(raw), bool)
    edge = np.zeros(len(raw) + 1, np.int32)
    np.add.at(edge, begins, 1)
    np.add.at(edge, np.maximum(ends - size + 1, begins), -1)
    window[:] = np.cumsum(edge[:-1]) > 0
    order = suffix_array(text, depth=size)
    hit = permuted_prefixes(raw, order, window, size)[order[1:]] >= size
    again = np.zeros(len(raw), bool)
    again[order[1:][hit]] = True
    again[order[:-1][hit]] = True
    found = np.flatnonzero(again)
    cuts = np.searchsorted(found, begins)
    return [found[a:b] - begin for a, b, begin in zip(cuts, [*cuts[1:], len(found)], begins.tolist(), strict=True)]


def _anywhere(size: int):
    def judge(bucket: Bucket) -> Spans:
        """Windows that start at another place too. Strings that come twice go whole; the rest are sorted by suffix."""
        kinds: dict[bytes, int] = {}
        kind = np.array([kinds.setdefault(c, len(kinds)) for c in bucket.chunks], np.int64)
        strings = list(kinds)
        rows = np.bincount(kind, minlength=len(strings))
        repeated = rows > 1
        first_row = np.full(len(strings), -1)
        first_row[kind[::-1]] = np.arange(len(kind))[::-1]
        m = bucket.m[first_row]
        whole = np.flatnonzero(repeated[kind])
        out = [(whole, np.zeros(len(whole), np.int64), bucket.n[whole].astype(np.int64))]
        # A string alone in its minimiser can still repeat a window in itself, if it is long enough to.
        _, into = np.unique(m, return_inverse=True)
        single = np.bincount(into, ~repeated)[into] > 0
        shard = np.flatnonzero(single & ((np.bincount(into)[into] > 1) | (bucket.n[first_row] > 1)))
        place = 0
        while place < len(shard):
            take, held = [], 0
            while place < len(shard) and (held < _SHARD or (take and m[shard[place]] == m[take[-1]])):
                take.append(shard[place])
                held += len(strings[shard[place]])
                place += 1
            for s, places in zip(take, repeated_places([strings[s] for s in take], size), strict=True):
                if repeated[s] or not len(places):
                    continue
                cut = np.flatnonzero(np.diff(places) > 1) + 1
                starts, stops = places[np.concatenate(([0], cut))], places[np.concatenate((cut - 1, [len(places) - 1]))] + 1
                out.append((np.full(len(starts), first_row[s]), starts, stops - starts))
        return tuple(np.concatenate(c) for c in zip(*out, strict=True))

    return judge


def repeated_bytes(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """(key, digest, spans): runs of byte windows that also start anywhere else in the corpus, per document with any."""
    return spans(docs, size, gram, byte_units, _anywhere(size), both_ways=True, orders=2)


def cut_bytes(text: bytes, found: list | None, size: int = SIZE) -> tuple[bytes, int, int]:
    """(kept bytes, removed bytes, maximal removed runs)."""
    if not found:
        return text, 0, 0
    gone = covered(found, len(text), size)
    runs = int(np.count_nonzero(gone & np.concatenate(([True], ~gone[:-1]))))
    return np.frombuffer(text, np.uint8)[~gone].tobytes(), int(np.count_nonzero(gone)), runs


def _digests(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            cut = [cut_bytes(t, s, size) for t, s in zip(texts, batch.column("spans").to_pylist(), strict=True)]
            columns = [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64())]
            columns += [pa.array([c[k] for c in cut], pa.int64()) for k in (1, 2)]
            columns.append(pa.array([hashlib.sha256(c[0]).hexdigest() for c in cut], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return run


def byte_digest(docs: DataFrame, size: int = SIZE, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row, after removing repeated strings of ``size`` bytes.

    Null texts are empty. Every place counts, in the same row and in rows that repeat an id or a whole row: a row that
    comes twice repeats all its strings.
    """
    joined = keyed(docs).join(repeated_bytes(docs, size, gram), ["key", "digest"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_digests(size), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
