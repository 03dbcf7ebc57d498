"""Toxicity: Levenshtein automata run over a lexicon trie, with windows that tell quotation from abuse."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import slices, stored_at
from riskweave.llm.folds import in_fold, training_rows
from riskweave.llm.words import SPACE, Words, lowered, plain_words
from riskweave.sources.shared import remove

FOLDS, HELD_OUT, CUT = 3, 1, 0.7
#: Most labelled rows that a fit reads, most terms of a lexicon, and most clean words that look like a term, over any corpus.
FIT_ROWS, TERMS, HARMLESS = 24_000, 2_000, 20_000
_WINDOW = 48  # bytes on either side of a hit
_KNOWN = 400_000  # words whose verdict a worker remembers
_QUOTES = re.compile("[\"“”„«»‘’]|(?<![^\\W_])'|'(?![^\\W_])")
#: Words that announce a quotation or a mention, fixed values.
_REPORTS = re.compile(r"\b(?:said|says|quote[ds]?|quoting|called|calls|word|words|term|terms|wrote|writes|phrase|slur|insult|report(?:ed|s)?|sagte|wort|zitat|nannte|dit|mot|cite|dijo|palabra|cita)\b")
N_FEATURES = 7
#: What a misspelt hit counts for beside an exact one.
MISSPELT = 0.7


def allowed_edits(length: int) -> int:
    """Letters put in, left out, replaced, or swapped with their neighbour, by the length of a term."""
    return 0 if length < 4 else 1 if length < 9 else 2


class Trie:
    """Lexicon as a trie; every node knows the shortest and longest rest below it, so that hopeless branches are cut.

    A word within k edits of a term holds one of any k + 1 pieces of the term unchanged, or, where a swap goes over the
    border of two pieces, one of these with the letter of the other; words without a piece of any term need no walk.
    """

    def __init__(self, terms: dict[str, float]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        for term in terms:
            node = 0
            for char in term:
                if char not in self.children[node]:
                    self.children[node][char] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                node = self.children[node][char]
            self.term[node] = term
        self.pieces: dict[int, set[str]] = {}
        for term in terms:
            parts = allowed_edits(len(term)) + 1
            cuts = [len(term) * i // parts for i in range(parts + 1)]
            pieces = [term[begin:end] for begin, end in pairwise(cuts)]
            swapped = [p for a, b in pairwise(pieces) for p in (a[:-1] + b[0], a[-1] + b[1:])]
            for piece in (*pieces, *swapped):
                self.pieces.setdefault(len(piece), set()).add(piece)
        self.shortest, self.longest, self.most = ([0] * len(self.term) for _ in range(3))
        for node in range(len(self.term) - 1, -1, -1):  # children come after their parents
            below = list(self.children[node].values())
            own = self.term[node]
            self.shortest[node] = min([0] * (own is not None) + [1 + self.shortest[c] for c in below], default=0)
            self.longest[node] = max([1 + self.longest[c] for c in below], default=0)
            self.most[node] = max([allowed_edits(len(own)) if own else 0] + [self.most[c] for c in below])

    def near(self, word: str) -> tuple[str, int] | None:
        """The term at the smallest allowed distance of ``word``, and that distance; ties by term.

        The automaton of ``word`` holds, for each number of edits, the set of places reached as bits; it walks the trie
        depth first and leaves a branch as soon as no place is left within the edits any term below allows. A swap goes on
        from the places of the letter before, so those are kept along.
        """
        size = len(word)
        if not self.shortest[0] - 2 <= size <= self.longest[0] + 2:
            return None
        if not any(word[i : i + n] in held for n, held in self.pieces.items() for i in range(size - n + 1)):
            return None
        places: dict[str, int] = {}
        for i, char in enumerate(word):
            places[char] = places.get(char, 0) | 1 << i
        full = (1 << (size + 1)) - 1
        best = None
        stack = [(0, 1, 0b11 & full, 0b111 & full, 0, 0, 0)]
        while stack:
            node, zero, one, two, old_zero, old_one, last = stack.pop()
            term = self.term[node]
            if term is not None:
                edits = 0 if zero >> size & 1 else 1 if one >> size & 1 else 2 if two >> size & 1 else 3
                if edits <= allowed_edits(len(term)) and (best is None or (edits, term) < (best[1], best[0])):
                    best = (term, edits)
            for char, child in self.children[node].items():
                hit = places.get(char, 0)
                z = (zero & hit) << 1
                o = two_ = 0
                most = self.most[child]
                if most:
                    o = ((one & hit) << 1 | zero | zero << 1 | z << 1 | ((old_zero & hit) << 1 & last) << 1) & full
                if most > 1:
                    two_ = ((two & hit) << 1 | one | one << 1 | o << 1 | ((old_one & hit) << 1 & last) << 1) & full
                alive = z | o | two_
                if alive and size - (alive.bit_length() - 1) <= self.longest[child] + 2:
                    stack.append((child, z & full, o, two_, zero, one, hit))
        return best


def quotation(text: bytes, start: int, end: int) -> float:
    """From 0 (abuse) to 1 (quotation or mention), from the window around a hit: enclosing marks and reporting words."""
    before = text[max(0, start - _WINDOW) : start].decode("utf-8", "ignore")
    after = text[end : end + _WINDOW].decode("utf-8", "ignore")
    enclosed = bool(_QUOTES.search(before)) and bool(_QUOTES.search(after)) and len(_QUOTES.findall(before)) % 2 == 1
    tight = bool(before) and bool(after) and bool(_QUOTES.match(before[-1])) and bool(_QUOTES.match(after[0]))
    return min(1.0, 0.5 * enclosed + 0.4 * tight + 0.4 * bool(_REPORTS.search(before)))


def linked(words: Words, widest: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each run of words with one mark between neighbours and at most ``widest`` bytes in all."""
    starts, ends, row = words.starts, words.ends, words.rows
    if len(starts) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    joins = (starts[1:] == ends[:-1] + 1) & (row[1:] == row[:-1]) & ~SPACE[words.raw[ends[:-1]]]
    first = np.flatnonzero(joins & ~np.append(False, joins[:-1]))
    last = np.flatnonzero(joins & ~np.append(joins[1:], False)) + 1
    fits = ends[last] - starts[first] <= widest
    return first[fits], last[fits]


class Finder:
    """Lexicon hits of texts; words once looked up are remembered, up to a bound.

    Words with one mark between them are also looked up as one, with the marks and without, if none of them is a hit.
    Words in ``harmless`` are no misspelling of anything.
    """

    def __init__(self, lexicon: dict[str, float], harmless: frozenset[str] = frozenset()):
        self.lexicon, self.harmless, self.trie = lexicon, harmless, Trie(lexicon)
        self.known: dict[int, tuple[str, int] | None] = {}
        self.known_linked: dict[bytes, tuple[str, int] | None] = {}

    def look_up(self, word: str) -> tuple[str, int] | None:
        return self.trie.near(word) if word in self.lexicon or word not in self.harmless else None

    def look_up_linked(self, raw: bytes) -> tuple[str, int] | None:
        """The nearer of ``raw`` with its marks and without them; leaving all marks out is one of the allowed edits."""
        word = raw.decode("utf-8", "replace")
        bare = self.look_up("".join(c for c in word if not c.isascii() or c.isalnum()))
        found = [f for f in (self.trie.near(word), bare and (bare[0], bare[1] + 1)) if f and f[1] <= allowed_edits(len(f[0]))]
        return min(found, key=lambda f: (f[1], f[0]), default=None)

    def _hits(self, words: Words) -> Iterator[tuple[int, int, tuple[str, int]]]:
        """(first word, last word, (term, edits)) of each hit."""
        distinct, first, into = np.unique(words.hashes, return_index=True, return_inverse=True)
        if len(self.known) > _KNOWN:
            self.known.clear()
        if len(self.known_linked) > _KNOWN:
            self.known_linked.clear()
        verdicts: dict[int, tuple[str, int]] = {}
        for i, (key, at) in enumerate(zip(distinct.tolist(), first.tolist(), strict=True)):
            if key in self.known:
                found = self.known[key]
            else:
                found = self.known[key] = self.look_up(words.span(at, 1).decode("utf-8", "replace"))
            if found:
                verdicts[i] = found
        marked = np.zeros(len(distinct), bool)
        marked[list(verdicts)] = True
        marked = marked[into] if len(distinct) else marked
        for at in np.flatnonzero(marked).tolist():
            yield at, at, verdicts[int(into[at])]
        hits = np.concatenate(([0], np.cumsum(marked)))
        begin, end = linked(words, 2 * (self.trie.longest[0] + 2))
        free = hits[end + 1] == hits[begin]
        for a, b in zip(begin[free].tolist(), end[free].tolist(), strict=True):
            raw = words.raw[words.starts[a] : words.ends[b]].tobytes()
            if raw not in self.known_linked:
                self.known_linked[raw] = self.look_up_linked(raw)
            if self.known_linked[raw]:
                yield a, b, self.known_linked[raw]

    def features(self, column: pa.Array) -> np.ndarray:
        """Per text: exact and misspelt hits outside quotation, hits in quotation, the strongest weight, hits per word."""
        texts = lowered(column)
        out = np.zeros((len(texts), N_FEATURES))
        if not self.lexicon:
            return out
        words = plain_words(texts)
        begins = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        row = words.rows
        for first, last, (term, edits) in self._hits(words):
            r = int(row[first])
            quoted = quotation(texts[r], int(words.starts[first] - begins[r]), int(words.ends[last] - begins[r]))
            weight = self.lexicon[term]
            out[r, 0 if not edits else 1] += 1 - quoted
            out[r, 2] += quoted
            out[r, 3] = max(out[r, 3], weight * (1 - quoted) * (1 if not edits else MISSPELT))
            out[r, 4] += weight * (1 - quoted) * (1 if not edits else MISSPELT)
            out[r, 5] = max(out[r, 5], weight * quoted)
        out[:, 6] = out[:, 4] / np.maximum(words.counts, 1) * 100
        out[:, :3] = np.log1p(out[:, :3])
        out[:, 4] = np.log1p(out[:, 4])
        out[:, 6] = np.log1p(out[:, 6])
        return out


def evidence(x: np.ndarray) -> np.ndarray:
    """What weights are learnt for: exact and misspelt hits as one column, as labelled rows may hold few misspellings."""
    return np.column_stack((np.log1p(np.expm1(x[:, 0]) + MISSPELT * np.expm1(x[:, 1])), x[:, 2:]))


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic texts, other texts, hashes of the words before it in toxic texts), summed within a batch."""
    for batch in slices(batches, limit=1 << 20):
        label = batch.column("label").to_numpy()
        words = plain_words(lowered(batch.column("text")))
        row = words.rows
        distinct, first, into = np.unique(words.hashes, return_index=True, return_inverse=True)
        seen = np.unique(into.astype(np.int64) << 32 | row)
        toxic = np.bincount((seen >> 32)[label[seen & 0xFFFFFFFF] > 0], minlength=len(distinct))
        other = np.bincount((seen >> 32)[label[seen & 0xFFFFFFFF] <= 0], minlength=len(distinct))
        near: dict[int, set] = defaultdict(set)
        for at in np.flatnonzero(label[row] > 0).tolist():
            near[int(into[at])].add(int(words.hashes[at - 1].view(np.int64)) if at and row[at - 1] == row[at] else 0)
        found = [(words.span(int(first[i]), 1).decode("utf-8", "replace"), int(toxic[i]), int(other[i]), list(near[i])) for i in sorted(near)]
        rest = [(words.span(int(first[i]), 1).decode("utf-8", "replace"), 0, int(other[i]), []) for i in np.flatnonzero(toxic == 0).tolist()]
        columns = list(zip(*(found + rest), strict=True)) or [(), (), (), ()]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["word", "toxic", "other", "near"])


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, toxic, other, near) from labelled ``rows``, summed within batches only."""
    return rows.select("label", "text").mapInArrow(_word_rows, "word string, toxic long, other long, near array<long>")


def learn_lexicon(sums: DataFrame, most: int = TERMS, least: int = 4, most_clean: float = 0.1) -> dict[str, float]:
    """Terms and weights from ``word_counts``: words of toxic texts that hardly occur in others.

    Copies of one toxic text would lift all its words, so what counts is how many different words stand before a term. A
    term needs ``least`` of them and at most ``most_clean`` of its texts clean. ``most`` bounds what reaches the driver.
    """
    counts = sums.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    places = sums.select("word", F.explode("near").alias("before")).distinct().groupBy("word").agg(F.count(F.lit(1)).alias("places"))
    fits = (F.col("places") >= least) & (F.col("places") >= 0.5 * F.col("toxic")) & (F.col("other") <= most_clean * (F.col("toxic") + F.col("other"))) & (F.length("word") >= 3)
    best = counts.join(places, "word").where(fits).orderBy(F.desc("places"), "word").limit(most).collect()
    return {r.word: math.log((r.places + 0.5) / (r.other + 0.5)) for r in best if r.places > r.other}


def learn_harmless(sums: DataFrame, lexicon: dict[str, float], most: int = HARMLESS, least: int = 1) -> frozenset[str]:
    """Words from ``word_counts`` that look like a term but stand in ``least`` clean texts or more, and in no more toxic ones.

    Of more than ``most``, those in most clean texts are taken, ties by word; that bounds what reaches the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(lexicon)
        for batch in batches:
            like = [w not in lexicon and trie.near(w) is not None for w in batch.column("word").to_pylist()]
            yield batch.filter(pa.array(like, pa.bool_()))

    counts = sums.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    clean = counts.where((F.col("other") >= least) & (F.col("other") >= F.col("toxic"))).select("word", "other")
    best = clean.mapInArrow(run, "word string, other long").orderBy(F.desc("other"), "word").limit(most).collect()
    return frozenset(r.word for r in best)


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    """Logistic regression by Newton steps; the last weight is the bias."""
    x = np.concatenate((x, np.ones((len(x), 1))), 1)
    weight = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weight, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ weight)
        weight += step
        if np.abs(step).max() < 1e-6:
            break
    return weight


def _hits(lexicon: dict[str, float], harmless: frozenset[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(lexicon, harmless)
        for batch in slices(batches, limit=1 << 20):
            x = finder.features(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), *(pa.array(x[:, k]) for k in range(N_FEATURES))], ["doc_id", "label", *(f"x{k}" for k in range(N_FEATURES))])

    return run


def train(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, most: int = FIT_ROWS) -> tuple[dict[str, float], np.ndarray, frozenset[str]]:
    """(lexicon, weights, harmless words) from at most ``most`` labelled rows outside the held-out fold.

    Null texts count as empty. Of several rows with one id, the text of the smallest hash is learnt from. Where no term is
    found (no such row, or rows of one label only), all weights are zero: nothing is learnt, and every score is 0.5.
    """
    picked = training_rows(docs, labels, "toxic", folds, held_out, most).groupBy("doc_id").agg(F.max("label").alias("label"), F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    rows, path = stored_at(picked, "toxic_rows")
    sums, sums_path = stored_at(word_counts(rows), "toxic_words")
    lexicon = learn_lexicon(sums)
    harmless = learn_harmless(sums, lexicon) if lexicon else frozenset()
    kinds = "doc_id long, label int, " + ", ".join(f"x{k} double" for k in range(N_FEATURES))
    got = rows.mapInArrow(_hits(lexicon, harmless), kinds).orderBy("doc_id").limit(most).toPandas() if lexicon else None
    for done in (path, sums_path):
        remove(docs.sparkSession, done)
    if got is None:
        return lexicon, np.zeros(N_FEATURES), harmless
    x, y = got[[f"x{k}" for k in range(N_FEATURES)]].to_numpy(float), got["label"].to_numpy(float)
    return lexicon, _fit(evidence(x), (y > 0).astype(float)), harmless


def score(docs: DataFrame, lexicon: dict[str, float], weights: np.ndarray, harmless: frozenset[str] = frozenset(), cut: float = CUT, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row, in one pass without a shuffle; lexicon, weights and words are bounded.

    Null texts count as empty. A null id is not held out. Only the text is read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(lexicon, harmless)
        for batch in slices(batches):
            margin = evidence(finder.features(batch.column("text"))) @ weights[:-1] + weights[-1]
            scores = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    out = rows.mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", in_fold(F.col("doc_id"), folds, held_out).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
