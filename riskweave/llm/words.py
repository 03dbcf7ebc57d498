"""Words and their hashes for many texts at once, as numpy arrays over one byte buffer."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import bytes_of

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_ODD = np.random.default_rng(7).integers(0, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
#: ASCII white space, and everything in ASCII but letters and digits.
SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
PLAIN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LATIN_MARKS = re.compile(rb"\xc2[\x80-\xbf]")
_WIDE_MARKS = re.compile(rb"\xe2(?:\x80[\x80-\xbf]|\x81[\x80-\xaf])|\xe3\x80\x80")


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least ``n`` of each."""
    n = 1 << max(n, 1 << 19).bit_length()
    return _powers(_BASE, n), _powers(_INVERSE, n)


def running(raw: np.ndarray) -> np.ndarray:
    """Prefix sums of byte times power; a span's hash is the difference of two, times the inverse power of its start."""
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers(len(raw))[0][: len(raw)], out=out[1:])
    return out


@dataclass
class Words:
    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray  # per text
    hashes: np.ndarray | None = None

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word, and hash, of each run of ``k`` words inside one text."""
        n = len(self.starts) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        rows = self.rows
        at = np.flatnonzero(rows[:n] == rows[k - 1 :])
        total = np.full(len(at), k, np.uint64)
        for j in range(k):
            total += self.hashes[at + j] * _ODD[j]
        return at, mix(total)

    def span(self, first: int, k: int) -> bytes:
        return b" ".join(self.raw[s:e].tobytes() for s, e in zip(self.starts[first : first + k], self.ends[first : first + k], strict=True))


def find_words(column: pa.Array, between: np.ndarray = SPACE, hashed: bool = True) -> Words:
    """Words of a binary column: runs of bytes for which ``between`` is false, never across rows."""
    raw, offsets = bytes_of(column)
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = ~between[raw]
    first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(raw))]
    first[borders] = inside[1:-1][borders]
    last[borders - 1] = inside[1:-1][borders - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    words = Words(raw, starts, ends, np.diff(np.searchsorted(starts, offsets)))
    if hashed:
        sums = running(raw)
        words.hashes = mix((sums[ends] - sums[starts]) * powers(len(raw))[1][starts])
    return words


def lowered(column: pa.Array) -> list[bytes]:
    return [t.decode("utf-8", "replace").lower().encode() for t in column.to_pylist()]


def plain_words(texts: list[bytes]) -> Words:
    """Words of lower-case texts: letters and digits only. Marks outside ASCII are blanked byte by byte, so that places
    in the texts stay."""
    blank = [t if t.isascii() else _WIDE_MARKS.sub(b"   ", _LATIN_MARKS.sub(b"  ", t)) for t in texts]
    return find_words(pa.array(blank, pa.binary()), PLAIN)


def bit_set(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """A table of 2**bits bits with those of ``column`` (long hashes) set; its size does not depend on the input.

    Rows that reach the driver are words of the table, at most 2**bits / 64 of them. Looking up gives false hits, which
    grow with the number of hashes, but never misses one.
    """
    place = F.shiftrightunsigned(F.col(column), 64 - bits)
    rows = hashes.select(place.alias("p")).select(F.expr("shiftright(p, 6) AS at"), F.expr("shiftleft(1L, cast(p & 63 AS int)) AS bit"))
    got = rows.groupBy("at").agg(F.bit_or("bit").alias("bit")).toPandas()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[got["at"].to_numpy(np.int64)] = got["bit"].to_numpy(np.int64).view(np.uint64)
    return out


def in_set(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - (len(table).bit_length() - 1 + 6))
    return (table[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) != 0
