"""Quality rules as a ledger: each rule is evaluated once per document, failures are bits, policies are masks over them."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import keyed, slices

_SPACES = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
#: Bytes that do not begin a code point, and white space: what is left has one byte per code point of a word.
_UNCOUNTED = bytes(range(0x80, 0xC0)) + _SPACES
#: Whole words without a letter (beyond ASCII all counts as one), words that begin with two capitals of Latin-1, and
#: words that end in two marks.
_UNLETTERED = re.compile(rb"(?<![^\x20\x09-\x0d])[^\x20\x09-\x0dA-Za-z\x80-\xff]+(?![^\x20\x09-\x0d])")
_SHOUTED = re.compile(rb"(?<![^\x20\x09-\x0d])(?:[A-Z]|\xc3[\x80-\x9e]){2}")
_MARKED = re.compile(rb"[.!?:;,]{2}(?![^\x20\x09-\x0d])")
_WINDOW = 3

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_unlettered", "n_shouted", "n_marked", "longest_bytes")


def repeated_words(words: Sequence[bytes], width: int = _WINDOW) -> int:
    """Words covered by a window of ``width`` words that is found twice or more; exact, by numbered words and windows."""
    if len(words) < width:
        return 0
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    windows = codes[: len(words) - width + 1]
    for k in range(1, width):  # both factors are under the number of words, so the product stays exact
        windows = np.unique(windows * len(number) + codes[k : len(words) - width + 1 + k], return_inverse=True)[1]
    again = np.bincount(windows)[windows] > 1
    covered = np.zeros(len(words), bool)
    for k in range(width):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def measure(text: bytes) -> tuple[int, ...]:
    """``MEASURES`` of one whole text; all zero but for one line if it is empty."""
    words, lines = text.split(), text.split(b"\n")
    written = [line for line in lines if line.strip()]
    return (
        len(words),
        len(text.translate(None, _UNCOUNTED)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(written) - len(set(written)),
        repeated_words(words),
        len(written),
        len(_UNLETTERED.findall(text)),
        len(_SHOUTED.findall(text)),
        len(_MARKED.findall(text)),
        max(map(len, words), default=0),
    )


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = np.array([measure(t) for t in batch.column("text").to_pylist()], np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(rows[:, k]) for k in range(len(MEASURES)))], ["doc_id", *MEASURES])


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, measurements) per row: one pass over whole texts, a null text counting as empty; nothing is shuffled."""
    return keyed(docs).select("doc_id", "text").mapInArrow(_measured, ", ".join(f"{c} long" for c in ("doc_id", *MEASURES)))


@dataclass(frozen=True)
class Rule:
    """A failure as a condition on the measurements; its place in a rule list is its bit, for good."""

    name: str
    fails: str


#: One or two lines that frame a short text are no list of copies, so the line rule asks for three.
#: Rules are only ever appended: a bit never changes its meaning, so ledgers and policies of any age fit together.
RULES = (
    Rule("short", "n_words < 50"),
    Rule("repeats", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("dup_lines", "n_dup_lines >= 3 and 100 * n_dup_lines > 30 * n_lines"),
    Rule("word_length", "word_chars < 3 * n_words or word_chars > 10 * n_words"),
    Rule("unlettered", "100 * n_unlettered > 20 * n_words"),
    Rule("shouting", "100 * n_shouted > 30 * n_words"),
    Rule("marks", "100 * n_marked > 30 * n_words"),
    Rule("endless_word", "longest_bytes > 1000"),
)


def mask(*names: str, rules: Sequence[Rule] = RULES) -> int:
    bits = {r.name: 1 << k for k, r in enumerate(rules)}
    return sum(bits[n] for n in set(names))


#: A document is rejected by a policy if it fails a rule of its mask. A changed policy is a new version.
POLICIES = {
    ("base", 1): mask("short", "repeats"),
    ("web", 1): mask("short", "repeats", "symbols", "dup_lines", "word_length"),
    ("web", 2): mask(*(r.name for r in RULES)),
}
CURRENT = ("web", 2)


def ledger(rows: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Measurements with ``failures``: bit k is set if rule k fails. A null measurement fails no rule that needs it."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << k)).otherwise(F.lit(0)).cast("long") for k, r in enumerate(rules)]
    total = F.lit(0).cast("long")
    for bit in bits:
        total = total.bitwiseOR(bit)
    return rows.withColumn("failures", total)


def passes(policy: tuple[str, int] | int, failures: Column | str = "failures") -> Column:
    """Whether a document is kept by a policy, a version of ``POLICIES`` or a mask."""
    bits = policy if isinstance(policy, int) else POLICIES[policy]
    return (F.col(failures) if isinstance(failures, str) else failures).bitwiseAND(F.lit(bits).cast("long")) == 0


def outcomes(book: DataFrame, policies: dict[tuple[str, int], int] = POLICIES, by: Sequence[str] = ()) -> DataFrame:
    """(by..., policy, version, n_docs, n_kept): every policy over one ledger, in one aggregate per failure pattern."""
    listed = F.array(*[F.struct(F.lit(p).alias("policy"), F.lit(v).alias("version"), F.lit(m).cast("long").alias("mask")) for (p, v), m in policies.items()])
    rows = _patterns(book, by).select(*by, "failures", "n", F.explode(listed).alias("_p")).select(*by, "failures", "n", "_p.*")
    clean = F.col("failures").bitwiseAND(F.col("mask")) == 0
    return rows.groupBy(*by, "policy", "version").agg(F.sum("n").alias("n_docs"), F.sum(F.when(clean, F.col("n")).otherwise(0)).alias("n_kept"))


def ablations(book: DataFrame, policy: tuple[str, int] = CURRENT, rules: Sequence[Rule] = RULES, by: Sequence[str] = ()) -> DataFrame:
    """(by..., rule, n_failed, n_only, n_kept, n_kept_without) per rule of a policy.

    ``n_only`` documents fail this rule of the policy alone, so that many more are kept without it. Rows meet as counts
    of failure patterns, at most two to the number of rules, counted per task before the shuffle.
    """
    bits = POLICIES[policy]
    used = [(r.name, 1 << k) for k, r in enumerate(rules) if bits >> k & 1]
    listed = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(bit).cast("long").alias("bit")) for name, bit in used])
    failed = F.col("failures").bitwiseAND(F.lit(bits).cast("long")).alias("failures")
    rows = _patterns(book, by).select(*by, failed, "n", F.explode(listed).alias("_r")).select(*by, "failures", "n", "_r.*")
    total = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    kept, only = total(F.col("failures") == 0), total(F.col("failures") == F.col("bit"))
    return rows.groupBy(*by, "rule").agg(
        total(F.col("failures").bitwiseAND(F.col("bit")) != 0).alias("n_failed"), only.alias("n_only"), kept.alias("n_kept"), (kept + only).alias("n_kept_without")
    )


def _patterns(book: DataFrame, by: Sequence[str]) -> DataFrame:
    return book.groupBy(*by, "failures").agg(F.count(F.lit(1)).alias("n"))


def verdicts(docs: DataFrame, policy: tuple[str, int] = CURRENT) -> DataFrame:
    """(doc_id, measurements, failures, base_failed, kept) per row; empty and null texts fail as short.

    Repeated rows and rows that share an id are judged each by its own text; an empty table gives no row.
    """
    book = ledger(measured(docs))
    both = POLICIES["base", 1] | POLICIES[policy]
    return book.withColumns({"base_failed": ~passes(POLICIES["base", 1]), "kept": passes(both)})
