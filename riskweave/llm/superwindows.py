"""Windows of a text, packed by their minimiser: runs of consecutive windows with one minimiser travel as one string.

A window is ``size`` units long (words or bytes). Its minimiser is the smallest hash of the ``gram``-unit runs inside it,
or those in two orders, taken together. Equal windows have equal minimisers wherever they stand, and can only meet in the
bucket of that minimiser. Windows whose minimiser has too many different strings take one over a longer gram instead,
level by level, up to the whole window.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import bytes_of, keyed, partitions, slices, stored_at
from riskweave.llm.words import bit_set, find_words, in_set, mix, powers, running
from riskweave.sources.shared import remove

#: Windows in one packed string, strings of one minimiser beyond which a longer gram divides them, bits of the lookup tables.
MOST_WINDOWS, CROWD, MOST_BITS = 256, 20_000, 26
_CHUNK = "m long, chunk binary, key long, digest long, first int, n int, sure boolean"
#: Bytes of text that numpy arrays are built over at once.
SLICE = 1 << 19


@dataclass
class Units:
    """Units of all texts of a slice one after another; unit u of text r is ``begin[r] + u``."""

    raw: np.ndarray
    begin: np.ndarray
    starts: np.ndarray | None  # byte places of units; None if units are bytes
    ends: np.ndarray | None
    sums: np.ndarray  # running hash over units
    base: np.ndarray

    def pack(self, first: int, units: int) -> bytes:
        if self.starts is None:
            return self.raw[first : first + units].tobytes()
        return self.raw[self.starts[first] : self.ends[first + units - 1]].tobytes()

    def grams(self, size: int) -> np.ndarray:
        """Hash of the ``size`` units that begin at each unit."""
        n = max(len(self.sums) - size, 0)
        return mix((self.sums[size : size + n] - self.sums[:n]) * self.base[:n])

    def content(self, first: np.ndarray, units: np.ndarray) -> np.ndarray:
        return mix((self.sums[first + units] - self.sums[first]) * self.base[first])


def byte_units(column: pa.Array) -> Units:
    raw, offsets = bytes_of(column)
    return Units(raw, offsets, None, None, running(raw), powers(len(raw))[1])


def word_units(column: pa.Array) -> Units:
    joined = pa.array([b" ".join(t.split()) for t in column.to_pylist()], pa.binary())
    words = find_words(joined)
    power, inverse = powers(len(words.hashes) + 1)
    sums = np.zeros(len(words.hashes) + 1, np.uint64)
    np.cumsum(words.hashes * power[: len(words.hashes)], out=sums[1:])
    return Units(words.raw, np.concatenate(([0], np.cumsum(words.counts))), words.starts, words.ends, sums, inverse)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    step, out = 1, values
    while 2 * step <= width:
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        step *= 2
    rest = width - step
    return (np.minimum(out[:-rest], out[rest:]) if len(out) > rest else out[:0]) if rest else out


#: Orders of grams. Windows that repeat have the minimisers of both in common, windows at the edge of a shared passage do
#: not; a second order halves the runs, so it pays where many windows would travel for one gram.
_ORDERS = np.array([0x243F6A8885A308D3, 0x13198A2E03707344], np.uint64)
_PLACE = np.uint64(31)  # bits for a gram's place, enough for any text that fits in a row


#: Text, first unit, windows, minimiser and places of the minimiser of each packed run.
Runs = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]
#: Bits of the minimisers of a level that occur more than once, and of those with too many strings (none: no table).
Level = tuple[np.ndarray, np.ndarray | None]


def levels(gram: int, size: int) -> list[int]:
    """Gram lengths from ``gram`` up, each twice the last; the whole window comes last."""
    out = []
    while gram < size:
        out.append(gram)
        gram *= 2
    return [*out, size]


def windows(units: Units, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, first unit) of every window of the slice."""
    counts = np.maximum(np.diff(units.begin) - size + 1, 0)
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.repeat(units.begin[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(len(row))


def runs(units: Units, row: np.ndarray, at: np.ndarray, size: int, gram: int, orders: int) -> Runs:
    """Runs of windows that follow each other and share a minimiser over grams of ``gram`` units.

    The smallest upper hash bits, leftmost at ties, choose a window's minimiser, so its choice depends on the window only.
    """
    grams = units.grams(gram)
    places = np.arange(len(grams), dtype=np.uint64)
    m, place = np.zeros(len(at), np.uint64), np.zeros(len(at), np.int64)
    for salt in _ORDERS[:orders]:
        smallest = sliding_min((mix(grams ^ salt) >> _PLACE) << _PLACE | places, size - gram + 1)[at]
        here = (smallest & ((np.uint64(1) << _PLACE) - np.uint64(1))).astype(np.int64)
        m = mix(m + grams[here])
        place = place * 3 + here
    new = np.ones(len(at), bool)
    new[1:] = (m[1:] != m[:-1]) | (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
    i = np.arange(len(at))
    new |= (i - np.maximum.accumulate(np.where(new, i, 0))) % MOST_WINDOWS == 0
    first = np.flatnonzero(new)
    moved = np.cumsum(np.concatenate(([False], place[1:] != place[:-1])))
    last = np.append(first[1:], len(at)) - 1
    return row[first], at[first], last - first + 1, m[first], 1 + moved[last] - moved[first]


def runs_by_level(units: Units, size: int, grams: list[int], orders: int, known: list[Level]) -> Iterator[Runs]:
    """Runs of each level in ``known``, without those that cannot repeat and those that a longer gram divides, then all
    runs of the level after them. Equal windows take the same level, as their minimisers alone decide it."""
    row, at = windows(units, size)
    for gram, level in zip(grams, [*known, None], strict=False):
        if not len(at):
            return
        found = runs(units, row, at, size, gram, orders)
        if level is None:
            yield found
            return
        repeated, crowded = level
        found = tuple(c[in_set(repeated, found[3])] for c in found)
        if crowded is None:
            yield found
            return
        crowd = in_set(crowded, found[3])
        yield tuple(c[~crowd] for c in found)
        each = found[2][crowd]
        row = np.repeat(found[0][crowd], each)
        at = np.repeat(found[1][crowd] - np.concatenate(([0], np.cumsum(each)[:-1])).astype(np.int64), each) + np.arange(len(row))


def _tally(units_of: Callable, size: int, grams: list[int], orders: int, known: list[Level]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE):
            units = units_of(batch.column("text"))
            for k, (_, at, n, m, places) in enumerate(runs_by_level(units, size, grams, orders, known)):
                if k < len(known):
                    continue
                _, once = np.unique(mix(m + np.uint64(1)) ^ units.content(at, n + size - 1), return_index=True)
                values, into = np.unique(m, return_inverse=True)
                total = np.bincount(into, places, len(values)).astype(np.int64)
                distinct = np.bincount(into[once], minlength=len(values))
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(total), pa.array(distinct)], ["m", "n", "chunks"])

    return run


def _packed(units_of: Callable, size: int, grams: list[int], orders: int, known: list[Level], both_ways: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[bytes, tuple[int, int] | bool] = {}
            for part in slices([batch], limit=SLICE):
                units = units_of(part.column("text"))
                key, digest = part.column("key").to_numpy(), part.column("digest").to_numpy()
                for row, at, n, m, _ in runs_by_level(units, size, grams, orders, known):
                    sent, sure = [], []
                    for r, a, count, value in zip(row.tolist(), at.tolist(), n.tolist(), m.view(np.int64).tolist(), strict=True):
                        chunk = units.pack(a, count + size - 1)
                        name = xxhash.xxh3_128_digest(chunk)
                        own = (int(key[r]), a - int(units.begin[r]))
                        had = seen.get(name)
                        place = (own[0], int(digest[r]), own[1], count)
                        if had is None:
                            seen[name] = own
                        elif both_ways and had is True or not both_ways and own > had:
                            sure.append(place)
                            continue
                        elif both_ways:  # the second of a string tells its bucket that it comes again; further ones need not
                            seen[name] = True
                        sent.append((value, chunk, *place))
                    if sent:
                        yield _rows(sent)
                    if sure:
                        yield _sure(sure)

    return run


_SCHEMA = pa.schema([("m", pa.int64()), ("chunk", pa.binary()), ("key", pa.int64()), ("digest", pa.int64()), ("first", pa.int32()), ("n", pa.int32()), ("sure", pa.bool_())])


def _rows(found: list[tuple]) -> pa.RecordBatch:
    columns = [*zip(*found, strict=True), [False] * len(found)]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)


def _sure(found: list[tuple]) -> pa.RecordBatch:
    key, digest, first, n = zip(*found, strict=True)
    spread = [hash((k, f)) for k, f in zip(key, first, strict=True)]
    columns = [spread, [None] * len(found), key, digest, first, n, [True] * len(found)]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)


@dataclass
class Bucket:
    """Packed strings of whole minimisers."""

    chunks: list[bytes]
    m: np.ndarray
    key: np.ndarray
    digest: np.ndarray
    first: np.ndarray
    n: np.ndarray


Spans = tuple[np.ndarray, np.ndarray, np.ndarray]  # row of the bucket, first window, windows


_SPAN = ["key", "digest", "first", "n"]


def settle(held: list[pa.RecordBatch], both_ways: bool) -> tuple[pa.RecordBatch, pa.RecordBatch]:
    """(rows that decide about others, rows that are decided) of one bucket.

    A string that starts earlier in the bucket, or that comes twice in it where ``both_ways`` counts, is cut whole, and
    tells other strings nothing that the earliest one, or the first two, do not. Ties of (key, first) all stay.
    """
    t = pa.Table.from_batches(held).combine_chunks()
    kind = pa.compute.dictionary_encode(t.column("chunk").combine_chunks()).indices.to_numpy()
    key, first = t.column("key").to_numpy(), t.column("first").to_numpy()
    order = np.lexsort((first, key, kind))
    place = np.arange(len(order))
    head = np.maximum.accumulate(np.where(np.append(True, kind[order][1:] != kind[order][:-1]), place, 0))
    decided = np.zeros(len(order), bool)
    decided[order] = place - head > 1 if both_ways else (key[order] != key[order][head]) | (first[order] != first[order][head])
    return tuple(pa.RecordBatch.from_struct_array(t.filter(pa.array(f)).to_struct_array().combine_chunks()) for f in (~decided, decided))


def _in_buckets(judge: Callable[[Bucket], Spans], both_ways: bool, most_bytes: int = 3 << 20):
    def judged(tables: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(tables).combine_chunks()
        get = lambda c: t.column(c).to_numpy()
        bucket = Bucket(t.column("chunk").to_pylist(), *(get(c) for c in ("m", *_SPAN)))
        row, first, n = judge(bucket)
        columns = [bucket.key[row], bucket.digest[row], (bucket.first[row] + first).astype(np.int32), n.astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], _SPAN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, most = 0, 2 * most_bytes
        for batch in batches:
            sure = batch.column("sure")
            if batch.num_rows and pa.compute.any(sure).as_py():
                yield batch.filter(sure).select(_SPAN)
                batch = batch.filter(pa.compute.invert(sure))
            for part in slices([batch], "chunk", most_bytes // 4):
                m = part.column("m").to_numpy()
                if size >= most_bytes and held:
                    # only a change of minimiser may end a bucket
                    last = held[-1].column("m")[-1].as_py()
                    cut = int(np.searchsorted(m != last, True)) if m[0] == last else 0
                    if cut < len(m):
                        yield judged([*held, part.slice(0, cut)] if cut else held)
                        held, size, most, part = [], 0, 2 * most_bytes, part.slice(cut)
                held.append(part)
                size += part.column("chunk").nbytes
                if size >= most:  # what one minimiser keeps grows with its different strings only
                    kept, decided = settle(held, both_ways)
                    yield decided.select(_SPAN)
                    held, size = [kept], kept.column("chunk").nbytes
                    most = max(2 * most_bytes, 2 * size)
        if held:
            yield judged(held)

    return run


def spans(docs: DataFrame, size: int, gram: int, units_of: Callable, judge: Callable[[Bucket], Spans], both_ways: bool, orders: int) -> DataFrame:
    """(key, digest, spans array of (first, n)): runs of windows to cut, per document.

    Pass 1 counts minimisers, summed per slice before the shuffle. Those that occur once cannot hold a repeated window;
    the others are set in a table of at most 2**26 bits, whatever the corpus: at sizes where it fills up, more strings
    travel, and none is missed. Windows whose minimiser has more than ``CROWD`` different strings are counted again by a
    minimiser over a gram twice as long, and so on, up to the whole window. Pass 2 sends packed strings to buckets. A string
    that comes again in its Arrow batch is decided there, so a passage that a third of all documents share leaves one or two
    strings per batch; a bucket keeps one or two of these.
    """
    texts = keyed(docs).select("key", "digest", "text")
    grams, known = levels(gram, size), []
    for length in grams:
        tally = texts.mapInArrow(_tally(units_of, size, grams, orders, list(known)), "m long, n long, chunks long")
        many, path = stored_at(tally.groupBy("m").agg(F.sum("n").alias("n"), F.sum("chunks").alias("chunks")).where("n > 1").select("m", "chunks"), "minimisers")
        crowded = many.where((F.col("chunks") > CROWD) & F.lit(length < size))
        table = lambda rows, n, spare: bit_set(rows, "m", min(MOST_BITS, max(12, math.ceil(math.log2(1 + n)) + spare)))
        crowd = crowded.count()
        known.append((table(many, many.count(), 4), table(crowded, crowd, 6) if crowd else None))
        remove(docs.sparkSession, path)
        if not crowd:
            break
    packed = texts.mapInArrow(_packed(units_of, size, grams, orders, known, both_ways), _CHUNK)
    buckets = packed.repartition(partitions(docs.sparkSession), "m").sortWithinPartitions("sure", "m")
    cut = buckets.mapInArrow(_in_buckets(judge, both_ways), "key long, digest long, first int, n int")
    return cut.groupBy("key", "digest").agg(F.collect_set(F.struct("first", "n")).alias("spans"))


def covered(spans: list | None, units: int, size: int) -> np.ndarray:
    """Which of a text's units lie in a window of ``spans``."""
    if not spans:
        return np.zeros(units, bool)
    edge = np.zeros(units + 1, np.int64)
    first = np.array([s["first"] for s in spans])
    np.add.at(edge, first, 1)
    np.add.at(edge, first + np.array([s["n"] for s in spans]) + size - 1, -1)
    return np.cumsum(edge[:-1]) > 0
