"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from riskweave.llm.common import slices
from riskweave.llm.folds import in_fold, training_rows
from riskweave.llm.words import SPACE, find_words

FOLDS, HELD_OUT, CUT = 4, 2, 0.7
#: Most labelled rows that a fit reads, over any corpus.
FIT_ROWS = 8000
WORD_BITS, STEPS, FACTORS = 15, 16, 8
_STATISTICS = 11
SIZE = (1 << WORD_BITS) + _STATISTICS * STEPS


@dataclass
class Features:
    """Rows of a sparse matrix: entries ``index`` and ``value``, row r from ``begin[r]`` on."""

    begin: np.ndarray
    index: np.ndarray
    value: np.ndarray


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets])


def features(texts: pa.Array, n_chars: np.ndarray) -> Features:
    """Distinct hashed words, each 1 / sqrt(their number), and one step of each statistic, each 1.

    ``n_chars`` is metadata of the row, NaN where it is missing. Empty texts have their own step in each statistic.
    """
    lower = pa.array([t.lower() for t in texts.to_pylist()], pa.binary())
    words, rows = find_words(lower, SPACE), len(texts)
    raw = find_words(texts, SPACE, hashed=False).raw
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts.to_pylist()]))).astype(np.int64)
    row = words.rows
    keys = np.sort((row.astype(np.int64) << WORD_BITS) | (words.hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64))
    keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))] if len(keys) else keys
    distinct = np.bincount(keys >> WORD_BITS, minlength=rows)
    same = np.zeros(len(row), bool)
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (row[1:] == row[:-1])
    n_bytes, n_words = np.diff(offsets), words.counts
    over = lambda a, b: np.where(b > 0, a / np.maximum(b, 1), np.nan)
    upper = _per_text((raw >= 65) & (raw <= 90), offsets)
    letters = _per_text(((raw | 32) >= 97) & ((raw | 32) <= 122) | (raw >= 128), offsets)
    lines = _per_text(raw == 10, offsets) + 1
    shares = [  # each from 0 to 1, in steps that are finer towards 0
        np.sqrt(over(upper, letters)), np.sqrt(1 - np.minimum(1, over(letters + _per_text(SPACE[raw], offsets), n_bytes))),
        np.sqrt(over(np.bincount(row[same], minlength=rows), n_words)), over(distinct, n_words), np.sqrt(over(_per_text((raw >= 48) & (raw <= 57), offsets), n_bytes)),
        np.sqrt(over(_per_text((raw == 33) | (raw == 63), offsets), n_words)), np.sqrt(over(_per_text((raw == 124) | (raw == 42) | (raw == 35) | (raw == 36) | (raw == 37) | (raw == 38), offsets), n_words)),
    ]
    counts = [n_words, over(n_bytes, n_words), over(n_bytes, lines) / 16, n_chars]
    steps = [np.where(np.isnan(s), 0, 1 + np.minimum(np.nan_to_num(s), 1) * (STEPS - 2)) for s in shares]
    steps += [np.where(np.isnan(c), 0, np.minimum(1 + np.log2(1 + np.maximum(np.nan_to_num(c), 0)), STEPS - 1)) for c in counts]
    dense = np.stack([np.floor(s).astype(np.int64) + (1 << WORD_BITS) + k * STEPS for k, s in enumerate(steps)], 1)
    begin = np.concatenate(([0], np.cumsum(distinct + _STATISTICS)))
    index, value = np.empty(begin[-1], np.int64), np.ones(begin[-1], np.float32)
    at = begin[:-1, None] + np.arange(_STATISTICS)
    index[at] = dense
    word = np.ones(len(index), bool)
    word[at] = False
    index[word] = keys & ((1 << WORD_BITS) - 1)
    value[word] = np.repeat(1 / np.sqrt(np.maximum(distinct, 1)), distinct)
    return Features(begin, index, value)


@dataclass
class Machine:
    bias: float
    weight: np.ndarray
    factor: np.ndarray
    learnt: bool = True  # false where there was no row to learn from

    def parts(self, x: Features) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(margin, sum of v x per row, v x per entry); every row has entries."""
        vx = self.factor[x.index] * x.value[:, None]
        sums = np.add.reduceat(vx, x.begin[:-1], axis=0)
        # sum of squares identity: all pairs of entries at the cost of one pass over them
        pairs = 0.5 * (sums**2 - np.add.reduceat(vx * vx, x.begin[:-1], axis=0)).sum(1)
        return self.bias + np.add.reduceat(self.weight[x.index] * x.value, x.begin[:-1]) + pairs, sums, vx

    def score(self, x: Features) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.parts(x)[0].astype(np.float64), -30, 30)))


def fit(x: Features, label: np.ndarray, passes: int = 12, batch: int = 128, rate: float = 0.02, decay: float = 1e-4, seed: int = 11) -> Machine:
    """Logistic loss by Adam over small batches in a seeded order; the same rows in the same order give the same machine.

    Without rows the machine is zero and marked as not learnt.
    """
    rng = np.random.default_rng(seed)
    if not len(label):
        return Machine(0.0, np.zeros(SIZE, np.float32), np.zeros((SIZE, FACTORS), np.float32), learnt=False)
    share = np.clip(label.mean(), 1e-3, 1 - 1e-3)
    table = np.concatenate((np.zeros((SIZE, 1)), rng.normal(0, 0.02, (SIZE, FACTORS))), 1).astype(np.float32)
    machine = Machine(float(np.log(share / (1 - share))), table[:, 0], table[:, 1:])
    first, second, bias_first, bias_second, step = np.zeros_like(table), np.zeros_like(table), 0.0, 0.0, 0
    for _ in range(passes):
        order = rng.permutation(len(label))
        for at in range(0, len(order), batch):
            rows = order[at : at + batch]
            sizes = np.diff(x.begin)[rows]
            begin = np.concatenate(([0], np.cumsum(sizes)))
            take = np.repeat(x.begin[rows] - begin[:-1], sizes) + np.arange(begin[-1])
            part = Features(begin, x.index[take], x.value[take])
            margin, sums, vx = machine.parts(part)
            error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - label[rows]) / len(rows)
            each = np.repeat(error, sizes)[:, None] * part.value[:, None]
            slope = np.concatenate((each, each * (np.repeat(sums, sizes, axis=0) - vx)), 1)
            used, into = np.unique(part.index, return_inverse=True)
            gradient = np.zeros((len(used), 1 + FACTORS), np.float32)
            np.add.at(gradient, into, slope.astype(np.float32))
            gradient += decay * table[used]
            step += 1
            first[used] = 0.9 * first[used] + 0.1 * gradient
            second[used] = 0.99 * second[used] + 0.01 * gradient**2
            table[used] -= rate * (first[used] / (1 - 0.9**step)) / (np.sqrt(second[used] / (1 - 0.99**step)) + 1e-6)
            bias_first, bias_second = 0.9 * bias_first + 0.1 * error.sum(), 0.99 * bias_second + 0.01 * error.sum() ** 2
            machine.bias -= float(rate * (bias_first / (1 - 0.9**step)) / (np.sqrt(bias_second / (1 - 0.99**step)) + 1e-6))
    return machine


def _chars(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("n_chars").to_numpy(zero_copy_only=False).astype(np.float64)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        x = features(batch.column("text"), _chars(batch))
        lists = lambda v, kind: pa.ListArray.from_arrays(pa.array(x.begin, pa.int32()), pa.array(v, kind))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), lists(x.index, pa.int32()), lists(x.value, pa.float32())], ["doc_id", "label", "index", "value"])


def _with_chars(rows: DataFrame) -> DataFrame:
    """``n_chars`` as a double that may be null, also where the table has no such column or one that is no number."""
    numeric = "n_chars" in rows.columns and isinstance(rows.schema["n_chars"].dataType, NumericType)
    return rows.withColumn("n_chars", F.col("n_chars").cast("double") if numeric else F.lit(None).cast("double"))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, held_out: int = HELD_OUT, most: int = FIT_ROWS) -> Machine:
    """Fit on at most ``most`` labelled rows outside the held-out fold; features are made in place by Spark.

    No such row (no labels, only null ones, or none of these documents) gives a machine that is marked as not learnt.
    """
    rows = _with_chars(training_rows(docs, labels, label, folds, held_out, most))
    # one row repeated many times must not outgrow the bound
    made = rows.mapInArrow(_featurise, "doc_id long, label int, index array<int>, value array<float>").dropDuplicates(["doc_id"]).orderBy("doc_id").limit(most).toArrow()
    index, value = made.column("index").combine_chunks(), made.column("value").combine_chunks()
    if not len(made):
        return fit(Features(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.float32)), np.zeros(0))
    sizes = index.value_lengths().to_numpy()
    x = Features(np.concatenate(([0], np.cumsum(sizes))), index.flatten().to_numpy().astype(np.int64), value.flatten().to_numpy())
    return fit(x, made.column("label").to_numpy().astype(np.float64))


def score(docs: DataFrame, machine: Machine, cut: float = CUT, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row, in one pass without a shuffle.

    A machine that has not learnt scores every row 0.5. The machine has a fixed size. Null texts count as empty. A null id is not held out. Only text and ``n_chars`` are read.
    """
    table = np.concatenate((machine.weight[:, None], machine.factor), 1)
    bias = machine.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Machine(bias, table[:, 0], table[:, 1:])
        for batch in slices(batches, limit=1 << 20):
            scores = own.score(features(batch.column("text"), _chars(batch)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores)], ["doc_id", "score"])

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = _with_chars(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("text"), "n_chars")
    out = rows.mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", in_fold(F.col("doc_id"), folds, held_out).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, machine: Machine, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that the machine accepts, with all columns, in one pass. An ``n_chars`` that is no number is
    not looked at. A machine that has not learnt knows nothing against any row: all are kept, with a warning."""
    if not machine.learnt:
        warnings.warn("no labelled row to learn quality from: all rows are kept", stacklevel=2)
        return docs
    numeric = "n_chars" in docs.columns and isinstance(docs.schema["n_chars"].dataType, NumericType)
    table = np.concatenate((machine.weight[:, None], machine.factor), 1)
    bias = machine.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Machine(bias, table[:, 0], table[:, 1:])
        for batch in batches:
            texts = pa.compute.fill_null(batch.column("text").cast(pa.binary()), b"")
            chars = batch.column("n_chars").cast(pa.float64()) if numeric else pa.nulls(batch.num_rows, pa.float64())
            parts = slices([pa.RecordBatch.from_arrays([texts, chars], ["text", "n_chars"])], limit=1 << 20)
            good = [own.score(features(p.column("text"), _chars(p))) >= cut for p in parts]
            yield batch.filter(pa.array(np.concatenate([*good, np.zeros(0, bool)])))

    return docs.mapInArrow(run, docs.schema)
