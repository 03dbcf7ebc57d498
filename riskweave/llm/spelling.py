"""Spelling variants: words one edit apart, found by scanning sorted word lists with edit-matrix rows shared by prefixes."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import keyed, stored_at
from riskweave.sources.shared import remove

#: Maximal runs of the letters of Latin-1 after lower-casing A-Z that hold at least ``SHORTEST`` code points.
SHORTEST = 5
RUNS = re.compile(f"[a-zÀ-ÿ]{{{SHORTEST},}}")
LEAST = 3
#: Letters that are lost on purpose: of every run whose hash with the id is divisible by this.
_LOSS = 97
#: A bucket over this many words, or this many code points, is cut at a further place of the edit.
CROWD, CROWD_LETTERS = 256, 1 << 20
#: What a task counts before it hands its counts on: words, and letters of words over ``_LONG``; cells of one scan's matrix.
_COUNTED, _COUNTED_LETTERS, _LONG, _CELLS = 200_000, 16 << 20, 64, 1 << 21
_BUCKET = ("l", "lo", "hi", "bucket")


def _pour(total: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()
    letters = 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            name = zlib.crc32(b":" if doc_id is None else b"%d:" % doc_id)
            runs = Counter(RUNS.findall(text.as_py().lower().decode("utf-8", "replace")))
            for run in [r for r in runs if zlib.crc32(r.encode(), name) % _LOSS == 0]:
                n, at = runs.pop(run), zlib.crc32(run.encode(), name) % len(run)
                if len(run) > SHORTEST:
                    total[run[:at] + run[at + 1 :]] += n
            total.update(runs)
            letters += sum(len(r) for r in runs if len(r) > _LONG)
            if len(total) > _COUNTED or letters > _COUNTED_LETTERS:
                yield _pour(total)
                total, letters = Counter(), 0
    if total:
        yield _pour(total)


def vocabulary(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(word, n) of all words with at least ``least`` occurrences in whole texts; counted per task before the shuffle.

    A null text has no word; a null id counts as empty in the hash that loses letters; repeated rows count each time.
    """
    parts = keyed(docs).select("doc_id", "text").mapInArrow(_counts, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _bucket(l: Column, lo: Column, hi: Column) -> Column:
    """Hash of the letters around an edit at one of the places lo to hi - 1 of the shorter word, which has ``l`` letters.

    Both words of a pair that first differ at such a place share ``lo`` letters at the front and ``l - hi`` at the end.
    Two buckets with one hash only make a list longer, as every pair is compared in full.
    """
    tail = F.greatest(l - hi, F.lit(0))
    return F.xxhash64(l, lo, hi, F.substring("word", F.lit(1), lo), F.substring("word", F.length("word") - tail + 1, tail))


def _regions(words: DataFrame, spans: Column) -> DataFrame:
    """``words`` (word, n, ...) in the bucket of each of ``spans`` (l, lo, hi)."""
    rows = words.select("word", "n", F.explode(spans).alias("_s")).select("word", "n", "_s.*")
    return rows.withColumn("bucket", _bucket(F.col("l"), F.col("lo"), F.col("hi")))


def _span(l: Column, lo: Column, hi: Column) -> Column:
    return F.struct(l.alias("l"), lo.alias("lo"), hi.alias("hi"))


def buckets(words: DataFrame, crowd: int = CROWD) -> tuple[DataFrame, list[str]]:
    """(word, n, l, lo, hi, bucket), and the scratch tables below it.

    A word is the shorter one (or one of two equally long) with ``l`` its length, and the longer one with ``l`` its length
    less one. The places 0 to l where the words of a pair can first differ are cut in two halves, and again in every
    bucket that is crowded, until it is not or one place is left. Then words differ in one letter, or two letters stand
    between equal parts: at most the square of the alphabet, whatever the input.
    """
    size, half = F.length("word"), lambda l: F.floor(l / 2).cast("int")
    both = [_span(l, lo, hi) for l in (size, size - 1) for lo, hi in ((F.lit(0), half(l)), (half(l), l + 1))]
    rows, scratch, ready = _regions(words, F.filter(F.array(*both), lambda s: s["l"] >= SHORTEST)), [], []
    while True:
        sizes = rows.groupBy(*_BUCKET).agg(F.count(F.lit(1)).alias("_n"), F.sum(F.length("word")).alias("_letters"))
        crowded, path = stored_at(sizes.where((F.col("hi") - F.col("lo") > 1) & ((F.col("_n") > crowd) | (F.col("_letters") > CROWD_LETTERS))).select(*_BUCKET, F.lit(True).alias("_crowded")), "crowded")
        scratch.append(path)
        if crowded.isEmpty():
            return reduce(DataFrame.unionByName, [*ready, rows]), scratch
        marked = rows.join(crowded, list(_BUCKET), "left")
        ready.append(marked.where("_crowded is null").select(*rows.columns))
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        cut = F.array(_span(F.col("l"), F.col("lo"), middle), _span(F.col("l"), middle, F.col("hi")))
        rows, path = stored_at(_regions(marked.where("_crowded"), cut), "cut_buckets")
        scratch.append(path)


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words as rows of a matrix, with at least two zeros at each end, and lengths."""
    texts = words.to_pylist()
    size = np.array([len(t) for t in texts], np.int32)
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    out = np.zeros((len(texts), int(size.max()) + 2), np.uint32)
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out, size


def scan(letters: np.ndarray, size: np.ndarray, bucket: np.ndarray, lowest: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (a, b), a before b, of words exactly one edit apart inside the buckets of a sorted list.

    Every word walks the rest of its bucket. Of the edit matrix only the band of three cells around the diagonal is kept,
    one row per letter of the word that is visited, capped at two. The next word starts from the row at the length of
    the prefix that it shares with the one before; if a row has no cell under two, all words that share so many letters
    are passed over. All words walk at once, one letter a step. ``lowest`` is the length of a bucket's shorter words; a pair
    counts in the bucket whose places ``lo`` to ``hi`` - 1 hold the first letter that differs, hence once.
    """
    n, width = letters.shape
    same = np.empty(n + 1, np.int32)  # letters shared with the word before; -1 where a bucket begins
    same[0] = same[n] = -1
    differ = letters[1:] != letters[:-1]
    same[1:n] = np.where(bucket[1:] == bucket[:-1], np.where(differ.any(1), differ.argmax(1), size[1:]), -1)
    past = np.empty((width, n + 1), np.int32)  # [d, i]: first word after i that shares under d letters with its predecessor
    places = np.arange(n + 1, dtype=np.int32)
    for d in range(width):
        stop = np.where(same < d, places, n)
        past[d, n] = n
        past[d, :n] = np.minimum.accumulate(stop[::-1])[::-1][1:]
    rows = np.ones((n, width, 3), np.uint8)  # a word against itself: one, zero, one
    rows[:, :, 1] = 0
    rows[:, 0, 0] = 2
    rows[np.arange(n), size, 2] = 2
    q = np.flatnonzero(same[1:] >= 0).astype(np.int32)
    at = q + 1
    depth = same[at]
    shared = depth.copy()
    found_a, found_b = [], []
    while len(q):
        letter, before, long = letters[at, depth], rows[q, depth], size[q]
        own = letters[q[:, None], np.maximum(depth[:, None] + np.array([-1, 0, 1], np.int32), 0)] != letter[:, None]
        new = np.empty((len(q), 3), np.uint8)
        new[:, 0] = np.minimum(before[:, 1] + 1, before[:, 0] + own[:, 0])
        new[:, 1] = np.minimum(np.minimum(before[:, 2], new[:, 0]) + 1, before[:, 1] + own[:, 1])
        new[depth >= long, 1] = 2
        new[:, 2] = np.minimum(new[:, 1] + 1, before[:, 2] + own[:, 2])
        new[depth + 1 >= long, 2] = 2
        np.minimum(new, 2, out=new)
        depth = depth + 1
        rows[q, depth] = new
        dead, done = new.min(1) > 1, depth == size[at]
        cell = long - depth + 1
        hit = np.flatnonzero(done & ~dead & (cell >= 0) & (cell <= 2))
        hit = hit[new[hit, cell[hit]] == 1]
        a, b, first = q[hit], at[hit], shared[hit]
        own_bucket = (np.minimum(size[a], size[b]) == lowest[a]) & (first >= lo[a]) & (first < hi[a])
        found_a.append(a[own_bucket])
        found_b.append(b[own_bucket])
        move = np.flatnonzero(dead | done)
        at[move] = np.where(dead[move], past[depth[move], at[move]], at[move] + 1)
        depth[move] = same[at[move]]
        shared[move] = np.minimum(shared[move], depth[move])
        if (depth[move] < 0).any():
            walking = depth >= 0
            q, at, depth, shared = q[walking], at[walking], depth[walking], shared[walking]
    return np.concatenate([*found_a, q]), np.concatenate([*found_b, q])


def _near(part: pa.Table, bucket: np.ndarray) -> pa.RecordBatch:
    """(word, n_near, form_n, form) of the words in whole buckets of a sorted list that have a near word there."""
    letters, size = _letters(part.column("word").combine_chunks())
    get = lambda name: part.column(name).to_numpy()
    a, b = scan(letters, size, bucket, get("l"), get("lo"), get("hi"))
    word, near = np.concatenate((a, b)), np.concatenate((b, a))
    n = get("n")
    order = np.lexsort((near, -n[near], word))  # inside a bucket, places are in the order of code points
    word, near = word[order], near[order]
    first = np.flatnonzero(np.diff(word, prepend=-1))
    many = np.diff(first, append=len(word))
    texts = part.column("word").combine_chunks()
    return pa.RecordBatch.from_arrays(
        [texts.take(pa.array(word[first])), pa.array(many, pa.int64()), pa.array(n[near[first]], pa.int64()), texts.take(pa.array(near[first]))],
        ["word", "n_near", "form_n", "form"],
    )


def _scans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scan a stream that is sorted by bucket and word; only the bucket that a batch ends in waits for the next batch."""
    rest = None
    for batch in batches:
        held = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        if held.num_rows:
            begins = _begins(held)
            yield from _whole(held.slice(0, int(begins[-1])), begins[:-1])
            rest = held.slice(int(begins[-1]))
    if rest is not None and rest.num_rows:
        yield from _whole(rest, np.zeros(1, np.int64))


def _begins(held: pa.Table) -> np.ndarray:
    new = np.zeros(held.num_rows, bool)
    new[0] = True
    for name in _BUCKET:
        values = held.column(name).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _whole(held: pa.Table, begins: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Buckets of more than one word, as many at a time as the letter matrix may hold, or one larger bucket."""
    ends = np.append(begins[1:], held.num_rows)
    cells = (ends - begins) * (held.column("l").to_numpy()[begins] + 3) if len(begins) else begins
    k = 0
    while k < len(begins):
        stop = max(k + 1, int(np.searchsorted(np.cumsum(cells[k:]), _CELLS, "right")) + k)
        several = ends[k:stop] - begins[k:stop] > 1
        if several.any():
            part = held.slice(int(begins[k]), int(ends[stop - 1] - begins[k]))
            number = np.repeat(np.arange(stop - k), ends[k:stop] - begins[k:stop])
            yield _near(part.filter(pa.array(several[number])), number[several[number]])
        k = stop


def _roots(formed: DataFrame) -> tuple[DataFrame, list[str]]:
    """(word, root) of the words of ``formed`` (word, form), by doubling: a step replaces each target by its own target.

    A form is at least twice as frequent as its word, so chains have at most as many links as the largest count has bits,
    and the rounds grow with the logarithm of that.
    """
    step, path = stored_at(formed.select("word", F.col("form").alias("root")), "roots")
    scratch = [path]
    while True:
        far = step.select(F.col("word").alias("root"), F.col("root").alias("_far"))
        longer, path = stored_at(step.join(far, "root", "left").select("word", F.coalesce("_far", "root").alias("root"), F.col("_far").isNotNull().alias("_moved")), "roots")
        scratch.append(path)
        step = longer.select("word", "root")
        if longer.where("_moved").isEmpty():
            return step, scratch


def variants(words: DataFrame, crowd: int = CROWD) -> tuple[DataFrame, list[str]]:
    """(word, form, root, n, n_near, form_n) of all ``words`` (word, n; distinct), and the scratch tables below it.

    Two words are near if one inserted, deleted or replaced code point tells them apart. The form is the near word of
    the largest n, of equal ones the first in code-point order, if its n is at least twice the word's; else null.
    """
    rows, scratch = buckets(words, crowd)
    lists = rows.repartition(*_BUCKET).sortWithinPartitions(*_BUCKET, "word").select("word", F.col("n"), *_BUCKET)
    found = lists.mapInArrow(_scans, "word string, n_near long, form_n long, form string")
    everyone = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("struct<m:bigint,form:string>").alias("best"))
    near = found.select("word", F.lit(None).cast("long").alias("n"), "n_near", F.struct((-F.col("form_n")).alias("m"), "form").alias("best"))
    one = everyone.unionByName(near).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    good = -F.col("best.m") >= 2 * F.col("n")
    judged = one.select("word", F.when(good, F.col("best.form")).alias("form"), "n", "n_near", F.when(good, -F.col("best.m")).alias("form_n"))
    judged, path = stored_at(judged, "variants")
    roots, more = _roots(judged.where("form is not null"))
    out = judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
    for old in [*scratch, *more[:-1]]:
        remove(words.sparkSession, old)
    return out, [path, more[-1]]


def spelling_variants(docs: DataFrame, least: int = LEAST, crowd: int = CROWD) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word of at least five letters with ``least`` occurrences or more.

    Null and empty texts add no word and an empty table gives no row; repeated rows count each time; other columns than
    ``doc_id`` and ``text`` are not read. The two tables that the result reads stay in the shared folder.
    """
    words, path = stored_at(vocabulary(docs, least), "vocabulary")
    out, _ = variants(words, crowd)
    remove(docs.sparkSession, path)
    return out
