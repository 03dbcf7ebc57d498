"""Text expressions: passages, tokens, run lengths and keyword hits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskweave.functions import fixed


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(fixed.WHITESPACE))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\S+"))


def section_label(text: Column, marker: str = ":") -> Column:
    """Prefix before the first marker when the marker lies near the start of the text."""
    head = F.substring(text, 1, fixed.SECTION_PREFIX_CHARS)
    label = strip(F.substring_index(text, marker, 1))
    return F.when(F.instr(head, marker) > 0, label).otherwise(F.lit(fixed.SECTION_DEFAULT))


def long_enough(text: Column, minimum: int = fixed.MIN_PASSAGE_CHARS) -> Column:
    """True for text whose stripped length reaches the minimum; false for NULL."""
    return F.coalesce(F.length(strip(text)) >= minimum, F.lit(False))


def chunks(text: Column, size: int = fixed.CHUNK_CHARS, overlap: int = fixed.CHUNK_OVERLAP) -> Column:
    """Overlapping slices; a slice that would only repeat the overlap is not produced."""
    step = size - overlap
    last_start = F.greatest(F.length(text) - F.lit(overlap + 1), F.lit(0))
    starts = F.sequence(F.lit(0), last_start, F.lit(step))
    return F.transform(starts, lambda start: F.substr(text, start + 1, F.lit(size)))


def tokens(text: Column, pattern: str = fixed.TOKEN_PATTERN) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def run_ends(ordered: Column) -> Column:
    """Positions in a sorted array where a run of equal elements ends."""
    last = F.size(ordered) - 1
    positions = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.filter(positions, lambda i: (i == last) | (F.get(ordered, i) != F.get(ordered, i + 1)))


def run_lengths(ordered: Column, ends: Column) -> Column:
    """Array of (term, tf) from a sorted array and its run ends."""
    return F.transform(
        ends,
        lambda end, k: F.struct(
            F.get(ordered, end).alias("term"),
            (end - F.coalesce(F.get(ends, k - 1), F.lit(-1))).cast("double").alias("tf"),
        ),
    )


def keyword_hits(text: Column, keywords: Sequence[str], whole_word: bool = False) -> Column:
    """Keywords that occur in the lower-cased text, in list order."""
    lowered = F.lower(text)

    def found(keyword: str) -> Column:
        if whole_word:
            return F.regexp_like(lowered, F.lit(rf"\b\Q{keyword}\E\b"))
        return F.contains(lowered, F.lit(keyword))

    return F.array_compact(F.array(*[F.when(found(k), F.lit(k)) for k in keywords]))
