"""Exact top-k passages by TF-IDF cosine that reads only postings which can still change the answer.

The index is made of segments of bounded size. A segment counts its own terms, learns from all segments in how many passages
each of them is, and keeps the postings of a term in levels of falling weight, in blocks of bounded size, heaviest first. Only
terms of segments are shuffled by term, and counts once by segment: no posting carries its term, its passage's name or its weight,
which follows from the count, the idf and the passage's length.

A query first sums the heaviest postings of its terms and scores the passages that gain most in full, which bounds its k-th best
similarity from below. Its commonest terms, as far as they cannot make up that bound by themselves, are not read: what they add
is at most the sum of their largest weights, and at most the length of their part of the query, as passages have length one.
Only passages that still can reach the bound get the unread terms from their own counts.

An index of few passages goes to the queries instead, as a small table does in a join: each task holds it in arrays, and no term
and no posting of a query is shuffled. Heads, bound and unread terms are the same there; of a common term what is left unread is
its list after the head.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructType
from pyspark.sql.window import Window

from riskweave.functions import fixed
from riskweave.functions import text as tx
from riskweave.operators.grounding import term_rows
from riskweave.sources.shared import fresh_path

#: Levels to a halving of the weight; all weights under the last level share it. Weights are at most one.
_PER_HALVING, _LAST_LEVEL = 2, 60
#: Postings of a block at most, and of a term's head.
_BLOCK, _HEAD = 1024, 64
#: Similarities are compared to nine digits; passages this close to the bound are still scored.
_SLACK = 1e-8
#: Passages of a segment at most, as bits of their number, and words; one longer passage has a segment of its own.
_PLACE_BITS, _WORDS = 16, 1 << 23
#: Of a term's number in a segment; the rest of it is zero for all but rare terms.
_LOW_BITS = 15
#: Groups of a term's heaviest postings before they meet.
_GROUPS = 64
#: Steps to a doubling in which lists hold the length of a passage, to bound a weight where it is read.
_STEPS = 32
#: Passages scored in full for the bound, for each of the k; share of the bound that unread terms may make up.
_TRIALS, _UNREAD = 8, 0.8
#: Passages and postings up to which an index goes to the queries; numbers of a tile of their sums by passage, or of what is read at a time.
_FEW, _FEW_POSTINGS, _TILE = 2 * _BLOCK, 1 << 20, 1 << 20
#: Numbers of terms in a corpus are many: larger dictionaries and zstd keep the stored tables small.
_FORMAT = {"compression": "zstd", "parquet.dictionary.page.size": str(4 << 20)}


class PrunedIndex(NamedTuple):
    """Stored below ``path``: counts (of each segment's passages and terms), places (term, df, idf and its number in a
    segment), lists (postings by segment, term, level, block) and lengths (number, length).

    Views of these: terms (term, idf, df), weights (term, number, weight), heads (term, number, weight), blocks (term, level,
    block, most, postings) and passages (number, passage_id, nos, tfs).
    """

    spark: SparkSession
    path: str
    passages: int

    def stored(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def table(self, name: str) -> DataFrame:
        return _VIEWS[name](self)


def _number() -> Column:
    return F.shiftleft("segment", _PLACE_BITS) + F.col("place")


def _terms(index: PrunedIndex) -> DataFrame:
    return index.stored("places").where("first = 0").select("term", "idf", "df")


def _passages(index: PrunedIndex) -> DataFrame:
    return index.stored("counts").where(F.col("term").isNull()).select(_number().alias("number"), "passage_id", "nos", "tfs")


def _lists(index: PrunedIndex) -> DataFrame:
    return index.stored("lists").where(F.col("term").isNotNull()).drop("lengths", "steps")


def _weighed(rows: DataFrame, index: PrunedIndex) -> DataFrame:
    """One row a posting from rows that hold the columns of ``lists`` and ``idf``: these give way to number and weight."""
    each = rows.select("*", F.explode(F.arrays_zip("places", "tfs")).alias("_p")).drop("places", "tfs")
    each = each.withColumns({"place": F.col("_p.places"), "_tf": F.col("_p.tfs")}).withColumn("number", _number()).drop("_p", "place", "segment")
    return each.join(index.stored("lengths"), "number").withColumn("weight", F.col("_tf") * F.col("idf") / F.col("length")).drop("_tf", "idf", "length")


def _weights(index: PrunedIndex) -> DataFrame:
    return _weighed(_lists(index).join(_terms(index), "term"), index)


def _blocks(index: PrunedIndex) -> DataFrame:
    named = _weights(index).join(_passages(index).select("number", "passage_id"), "number")
    posting = F.struct("passage_id", "weight")
    return named.groupBy("term", "level", "block").agg(F.max("weight").alias("most"), F.collect_list(posting).alias("postings"))


def _heads(index: PrunedIndex, terms: DataFrame | None = None) -> DataFrame:
    """(term, number, weight): the heaviest postings of each term of ``terms`` (term, idf; all without it).

    Only the upper levels that together hold enough are opened, of each list only its start, and these meet group by group.
    """
    lists = _lists(index).join(_terms(index).select("term", "idf") if terms is None else terms, "term")
    start = [F.slice(c, 1, _HEAD).alias(c) for c in ("places", "tfs")]
    starts = lists.select("term", "idf", "segment", "level", *start)
    sizes = lists.groupBy("term", "level").agg(F.sum(F.size("places")).alias("_n"))
    above = Window.partitionBy("term").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    lowest = sizes.withColumn("_above", F.coalesce(F.sum("_n").over(above), F.lit(0))).where(F.col("_above") < _HEAD)
    lowest = lowest.groupBy(F.col("term").alias("_term")).agg(F.max("level").alias("_lowest"))
    upper = starts.join(lowest, (F.col("term") == F.col("_term")) & (F.col("level") <= F.col("_lowest"))).select("term", "idf", "segment", "places", "tfs")
    heads = _weighed(upper, index).withColumn("_g", F.pmod(F.xxhash64("number"), F.lit(_GROUPS)))
    for group in (["term", "_g"], ["term"]):
        best = Window.partitionBy(*group).orderBy(F.desc("weight"), "number")
        heads = heads.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= _HEAD).drop("_r")
    return heads.select("term", "number", "weight")


_VIEWS = {"terms": _terms, "passages": _passages, "weights": _weights, "blocks": _blocks, "heads": _heads}


def _segments(batches: Iterator[pa.RecordBatch], most: int, words: int) -> Iterator[list[pa.RecordBatch]]:
    """Consecutive rows, cut before there are over ``most`` of them or over ``words`` words in several."""
    held, rows, size = [], 0, 0
    for batch in batches:
        ends, start = np.cumsum(pc.list_value_length(batch.column("words")).to_numpy(zero_copy_only=False)), 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            take = min(int(np.searchsorted(ends, done + words - size, "right")) - start, most - rows)
            if take <= 0 and held:
                yield held
                held, rows, size = [], 0, 0
                continue
            take = min(max(take, 1), batch.num_rows - start)
            held.append(batch.slice(start, take))
            start, rows, size = start + take, rows + take, size + int(ends[start + take - 1] - done)
    if held:
        yield held


def _lists_of(starts: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(values, pa.int32()))


def _counted(held: list[pa.RecordBatch], segment: int, stop_words: list[str]) -> list[dict[str, pa.Array]]:
    """The rows of ``counts`` of a segment: its passages with numbers and counts of terms, then its terms, commonest first."""
    words = pa.concat_arrays([b.column("words") for b in held])
    coded, owner = pc.list_flatten(words).dictionary_encode(), pc.list_parent_indices(words).to_numpy().astype(np.int64)
    kept = pc.invert(pc.is_in(coded.dictionary, value_set=pa.array(stop_words, coded.dictionary.type))).to_numpy(zero_copy_only=False).astype(bool)
    code, width = coded.indices.to_numpy().astype(np.int64), max(len(kept), 1)
    pairs, tfs = np.unique((owner * width + code)[kept[code]] if len(code) else owner, return_counts=True)
    owner, code = pairs // width, pairs % width
    n = np.bincount(code, minlength=len(kept))
    order = np.argsort(-n, kind="stable")[: np.count_nonzero(n)]
    no = np.empty(len(kept), np.int64)
    no[order] = np.arange(len(order))
    starts = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))])
    passages = {"place": pa.array(np.arange(len(words)), pa.int32()), "passage_id": pa.concat_arrays([b.column("passage_id") for b in held])}
    passages |= {"nos": _lists_of(starts, no[code]), "tfs": _lists_of(starts, tfs)}
    terms = {"place": pa.array(np.arange(len(order)), pa.int32()), "term": coded.dictionary.take(pa.array(order)), "n": pa.array(n[order], pa.int64())}
    return [x | {"segment": pa.array(np.full(len(x["place"]), segment), pa.int64())} for x in (passages, terms)]


def _counts(corpus: DataFrame, row_id: str, text: str, stop_words: list[str], pattern: str) -> DataFrame:
    """(segment, place, passage_id, nos, tfs, term, n): a row for each passage of a segment, without term, and for each term.

    ``place`` numbers the passages of a segment, or its terms, of which a passage holds ``nos`` so many (``tfs``) times.
    """
    split = corpus.where(F.col(text).isNotNull()).select(F.col(row_id).alias("passage_id"), tx.tokens(F.col(text), pattern).alias("words"))
    schema = StructType().add("segment", LongType()).add("place", IntegerType()).add("passage_id", split.schema["passage_id"].dataType)
    schema = schema.add("nos", ArrayType(IntegerType())).add("tfs", ArrayType(IntegerType())).add("term", StringType()).add("n", LongType())
    most, words, names, listed = 1 << _PLACE_BITS, _WORDS, schema.fieldNames(), list(stop_words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 24
        for i, held in enumerate(_segments(batches, most, words)):
            kinds = {"nos": pa.list_(pa.int32()), "tfs": pa.list_(pa.int32()), "n": pa.int64(), "term": held[0].schema.field("words").type.value_type}
            kinds["passage_id"] = held[0].schema.field("passage_id").type
            for rows in _counted(held, first + i, listed):
                yield pa.RecordBatch.from_arrays([rows[c] if c in rows else pa.nulls(len(rows["place"]), kinds[c]) for c in names], names)

    return split.mapInArrow(count, schema)


def _placed(counts: DataFrame, size: int) -> DataFrame:
    """(term, segment, no, df, idf, first): each term of each segment, with the number of its postings in all and in earlier ones."""
    own = Window.partitionBy("term")
    before = own.orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    terms = counts.where(F.col("term").isNotNull()).select("term", "segment", F.col("place").alias("no"), "n")
    placed = terms.select("term", "segment", "no", F.sum("n").over(own).alias("df"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return placed.withColumn("idf", F.log((F.lit(float(size)) + 1) / (F.col("df") + 1)) + 1)


def _weigh_segment(terms: pa.Table, passages: pa.Table, size: int) -> pa.Table:
    """The rows of ``lists`` of a segment; one without a term has the lengths of its passages."""
    terms, low = terms.sort_by("no"), passages["low"].combine_chunks()
    segment, places = passages["segment"][0].as_py(), passages["place"].to_numpy()
    idf, first = np.log((size + 1) / (terms["df"].to_numpy() + 1)) + 1, terms["first"].to_numpy()
    high, owner = pc.list_flatten(passages["high"].combine_chunks()).to_numpy(), pc.list_parent_indices(low).to_numpy()
    no = (high.astype(np.int64) << _LOW_BITS) + pc.list_flatten(low).to_numpy()
    tf = pc.list_flatten(passages["tfs"].combine_chunks()).to_numpy()
    raw = tf * idf[no]
    lengths = np.sqrt(np.bincount(owner, raw * raw, minlength=len(places)))
    weight = raw / lengths[owner]
    level = np.clip(np.floor(-np.log2(weight) * _PER_HALVING), 0, _LAST_LEVEL).astype(np.int64)
    by_term, n = np.argsort(no, kind="stable"), np.bincount(no, minlength=len(idf))
    block = np.empty(len(no), np.int64)
    block[by_term] = (first.repeat(n) + np.arange(len(no)) - (np.cumsum(n) - n).repeat(n)) // _BLOCK
    most = int(block.max(initial=0)) + 1
    step = np.floor(np.log2(np.maximum(lengths, 1.0)) * _STEPS).astype(np.int64)
    key = (no * (_LAST_LEVEL + 1) + level) * most + block
    order = np.lexsort((-weight, key))
    key = key[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    ends, one = np.append(starts, len(key)), order[starts]
    held = {
        "segment": pa.array(np.full(len(one), segment), pa.int64()), "term": terms["term"].combine_chunks().take(pa.array(no[one])),
        "level": pa.array(level[one], pa.int32()), "block": pa.array(block[one], pa.int64()),
        "places": _lists_of(ends, places[owner[order]]), "tfs": _lists_of(ends, tf[order]), "steps": _lists_of(ends, step[owner[order]]), "lengths": pa.nulls(len(one), pa.list_(pa.float64())),
    }
    own = [[segment], [None], [None], [None], [places], [None], [None], [lengths]]
    held = pa.table(held)
    return pa.concat_tables([held, pa.table([pa.array(v, f.type) for v, f in zip(own, held.schema, strict=True)], held.schema)])


def write_index(corpus: DataFrame, row_id: str, text: str, path: str, stop_words: list[str] = tuple(fixed.STOP_WORDS), pattern: str = fixed.TOKEN_PATTERN) -> PrunedIndex:
    """Fit the corpus once and store the four tables; null texts are no passages, and rows with one id are passages of their own.

    Texts are split into terms once. A segment is bounded in passages and in words, and so is what one task holds of a term.
    """
    index = PrunedIndex(corpus.sparkSession, path, 0)
    _counts(corpus, row_id, text, stop_words, pattern).write.options(**_FORMAT).parquet(f"{path}/counts")
    index = open_index(index.spark, path)
    _placed(index.stored("counts"), index.passages).write.options(**_FORMAT).parquet(f"{path}/places")
    terms = index.stored("places").select("segment", "no", "term", "df", "first").groupBy("segment")
    low = F.transform("nos", lambda no: no.bitwiseAND((1 << _LOW_BITS) - 1).cast("short")).alias("low")
    high = F.transform("nos", lambda no: F.shiftright(no, _LOW_BITS).cast("short")).alias("high")  # mostly 0: a shuffle packs it
    passages = index.stored("counts").where(F.col("term").isNull()).select("segment", "place", low, high, "tfs").groupBy("segment")
    size = index.passages
    lists = "segment long, term string, level int, block long, places array<int>, tfs array<int>, steps array<int>, lengths array<double>"
    terms.cogroup(passages).applyInArrow(lambda t, p: _weigh_segment(t, p, size), lists).write.options(**_FORMAT).parquet(f"{path}/lists")
    own = index.stored("lists").where(F.col("term").isNull()).select("segment", F.explode(F.arrays_zip("places", "lengths")).alias("_p"))
    own = own.select("segment", F.col("_p.places").alias("place"), F.col("_p.lengths").alias("length"))
    own.select(_number().alias("number"), "length").write.options(**_FORMAT).parquet(f"{path}/lengths")
    return index


def open_index(spark: SparkSession, path: str) -> PrunedIndex:
    index = PrunedIndex(spark, path, 0)
    return index._replace(passages=index.table("passages").count())


def _kept(df: DataFrame, path: str) -> DataFrame:
    """Stored, so that the planner knows its size: what few queries ask for is then sent to the index, and not the other way."""
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _looked_up(pairs: DataFrame, terms: DataFrame, row_id: str, index: PrunedIndex) -> DataFrame:
    """``pairs`` (id, number, ...) with passage_id, length and ``found``: what the ``terms`` (id, term, x) of the id add there."""
    named = terms.select(row_id, "term", "x").join(index.stored("places").select("term", "segment", "no", "idf"), "term")
    asked = named.groupBy(row_id, "segment").agg(F.collect_list(F.struct("no", "idf", "x")).alias("_q"))
    met = pairs.select("number")
    passages = index.table("passages").join(met, "number", "left_semi").join(index.stored("lengths").join(met, "number", "left_semi"), "number")
    full = pairs.withColumn("segment", F.shiftright("number", _PLACE_BITS)).join(asked, [row_id, "segment"], "left").join(passages, "number")
    full = full.withColumn("_tf", F.map_from_arrays("nos", "tfs"))
    part = lambda s, t: s + F.coalesce(F.try_element_at("_tf", t["no"]) * t["idf"] / F.col("length"), F.lit(0.0)) * t["x"]
    found = F.coalesce(F.aggregate("_q", F.lit(0.0), part), F.lit(0.0)).alias("found")
    return full.select(*pairs.columns, "passage_id", "length", found)


def _floors(x: DataFrame, heads: DataFrame, row_id: str, index: PrunedIndex, k: int, path: str) -> DataFrame:
    """(id, floor): the k-th best dot product among the passages that gain most from the heads."""
    sums = x.join(heads, "term").groupBy(row_id, "number").agg(F.sum(F.col("x") * F.col("weight")).alias("s"))
    best = lambda s: F.row_number().over(Window.partitionBy(row_id).orderBy(F.desc(s), "number"))
    trials = _kept(sums.withColumn("_r", best("s")).where(F.col("_r") <= _TRIALS * k).select(row_id, "number"), path)
    scored = _looked_up(trials, x, row_id, index).select(row_id, "number", "found").withColumn("_r", best("found"))
    return scored.where(F.col("_r") == k).select(row_id, (F.col("found") - _SLACK).alias("floor"))


def query_terms(queries: DataFrame, row_id: str, text: str, index: PrunedIndex, k: int, pattern: str = fixed.TOKEN_PATTERN) -> DataFrame:
    """(id, term, x, idf, most, floor, cut, norm): weights of the query; a term with a ``cut`` is not read.

    The k-th best dot product reaches ``floor`` at least. The commonest terms are left unread as long as what they can add
    stays under a share of it; their cutoffs are parts of that bound, so their sum over the query weights is the bound.
    Terms of the queries and their heads are stored, as several steps read them.
    """
    path = fresh_path(index.spark, "query_heads")
    known = term_rows(queries, row_id, text, pattern).join(index.table("terms"), "term")
    x = _kept(known.select(row_id, "term", "idf", (F.col("tf") * F.col("idf")).alias("x"), "df"), f"{path}/terms")
    words = _kept(x.select("term", "idf").distinct(), f"{path}/words")
    heads = _kept(_heads(index, words), f"{path}/heads")
    floors = _floors(x, heads, row_id, index, k, f"{path}/trials")
    x = x.join(heads.groupBy("term").agg(F.max("weight").alias("most")), "term").join(floors, row_id, "left")
    x = x.withColumn("floor", F.greatest(F.coalesce("floor", F.lit(0.0)), F.lit(0.0)))
    own = Window.partitionBy(row_id)
    common = own.orderBy(F.desc("df"), "term").rowsBetween(Window.unboundedPreceding, 0)
    square = F.col("x") * F.col("x")
    x = x.withColumn("_l2", F.sum(square).over(common)).withColumn("_rest", F.least(F.sum(F.col("x") * F.col("most")).over(common), F.sqrt("_l2")))
    x = x.withColumn("_cut", F.col("_rest") <= F.col("floor") * _UNREAD)
    all_cut = lambda c: F.max(F.when(F.col("_cut"), F.col(c))).over(own)
    cut = F.when(F.col("_cut"), F.col("x") * all_cut("_rest") / all_cut("_l2")).otherwise(0.0)
    return x.select(row_id, "term", "x", "idf", "most", "floor", cut.alias("cut"), F.sqrt(F.sum(square).over(own)).alias("norm"))


def read_postings(terms: DataFrame, row_id: str, index: PrunedIndex) -> DataFrame:
    """(id, term, x, floor, number, raw, weight): all postings of the terms without a cutoff.

    ``raw`` is a weight before it is divided by the length of its passage, and ``weight`` at least the weight.
    """
    wanted = terms.where(F.col("cut") == 0).select(row_id, "term", "x", "idf", "floor")
    lists = index.stored("lists").where(F.col("term").isNotNull()).select("term", "segment", F.arrays_zip("places", "tfs", "steps").alias("_p"))
    rows = wanted.join(lists, "term").select(row_id, "term", "x", "idf", "floor", "segment", F.inline("_p").alias("place", "_tf", "_step"))
    raw = F.col("_tf") * F.col("idf")
    weight = F.least(raw / F.pow(F.lit(2.0), F.col("_step") / _STEPS) * (1 + _SLACK), F.lit(1.0))
    return rows.select(row_id, "term", "x", "floor", _number().alias("number"), raw.alias("raw"), weight.alias("weight"))


def candidates(terms: DataFrame, postings: DataFrame, row_id: str) -> DataFrame:
    """(id, number, read) pairs that can still reach the floor: what was read, and what the terms that were not can add.

    ``read`` sums the raw products, which the length of the passage divides in the end.
    """
    unread = terms.where(F.col("cut") > 0).groupBy(row_id).agg(F.sum(F.col("x") * F.col("cut")).alias("_rest"))
    seen = postings.groupBy(row_id, "number").agg(
        F.sum(F.col("x") * F.col("weight")).alias("_over"), F.first("floor").alias("floor"), F.sum(F.col("x") * F.col("raw")).alias("read")
    )
    reach = F.col("_over") + F.coalesce("_rest", F.lit(0.0)) + _SLACK
    return seen.join(unread, row_id, "left").where(F.col(row_id).isNotNull() & (reach >= F.col("floor"))).select(row_id, "number", "read")


def similarities(queries: DataFrame, row_id: str, text: str, index: PrunedIndex, k: int, pattern: str = fixed.TOKEN_PATTERN) -> DataFrame:
    """(id, passage_id, dot, norm) of all passages that can be among the best k of a query, and maybe some more.

    Only terms with a cutoff are looked up in a passage, as the others were read in full. A query without a known term
    has no row. ``dot`` over ``norm`` is the cosine. The terms of the queries are stored once, as three steps read them.
    """
    path = fresh_path(index.spark, "query_terms")
    terms = _kept(query_terms(queries, row_id, text, index, k, pattern), f"{path}/terms")
    pairs = _kept(candidates(terms, read_postings(terms, row_id, index), row_id), f"{path}/pairs")
    full = _looked_up(pairs, terms.where(F.col("cut") > 0), row_id, index).join(terms.groupBy(row_id).agg(F.first("norm").alias("norm")), row_id)
    return full.select(row_id, "passage_id", (F.col("read") / F.col("length") + F.col("found")).alias("dot"), "norm")


class _Few(NamedTuple):
    """A small index in arrays: passages in the order of their ids, and the postings of each term, heaviest first."""

    ids: pa.Array
    terms: pa.Array
    idf: np.ndarray
    starts: np.ndarray
    places: np.ndarray
    weights: np.ndarray
    held: np.ndarray  # place and term of each posting as one number, sorted
    held_at: np.ndarray  # and where it is in the lists

    def sums(self, rows: int, row: np.ndarray, term: np.ndarray, x: np.ndarray, first: int, last: int | None) -> np.ndarray:
        """What the postings ``first`` to ``last`` of the terms add, by row and passage."""
        sizes = np.diff(self.starts)[term]
        n = np.maximum((sizes if last is None else np.minimum(sizes, last)) - first, 0)
        at = np.repeat(self.starts[term] + first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        cells = np.repeat(row, n) * len(self.ids) + self.places[at]
        return np.bincount(cells, np.repeat(x, n) * self.weights[at], minlength=rows * len(self.ids)).reshape(rows, -1)

    def looked_up(self, row: np.ndarray, place: np.ndarray, n: np.ndarray, term: np.ndarray, x: np.ndarray) -> np.ndarray:
        """What the tails of the terms of its row, ``n`` a row, add to each passage (row, place)."""
        start, times = (np.cumsum(n) - n)[row], n[row]
        of = np.repeat(start - (np.cumsum(times) - times), times) + np.arange(times.sum())
        wanted = np.repeat(place, times) * len(self.idf) + term[of]
        near = np.minimum(np.searchsorted(self.held, wanted), len(self.held) - 1)
        at = self.held_at[near]
        tail = (self.held[near] == wanted) & (at - self.starts[term[of]] >= _HEAD)
        return np.bincount(np.repeat(np.arange(len(row)), times), np.where(tail, x[of] * self.weights[at], 0.0), minlength=len(row))

    def dots(self, rows: int, row: np.ndarray, term: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
        """Dot products by row and passage, 0 where a passage cannot be among the best k; terms come by row."""
        known = self.sums(rows, row, term, x, 0, _HEAD)
        places = len(self.ids)
        floor = np.maximum(np.partition(known, places - k, axis=1)[:, places - k] - _SLACK, 0.0) if places >= k else np.zeros(rows)
        tails = np.diff(self.starts)[term] - _HEAD
        row, term, x, tails = (v[tails > 0] for v in (row, term, x, tails))
        order = np.lexsort((term, -tails, row))
        row, term, x, tails = (v[order] for v in (row, term, x, tails))
        begin = np.searchsorted(row, np.arange(rows))[row]  # commonest terms of a row first
        upto = lambda v: (c := np.concatenate([[0.0], np.cumsum(v)]))[1:] - c[begin]
        rest = np.minimum(upto(x * self.weights[np.minimum(self.starts[term] + _HEAD, len(self.weights) - 1)]), np.sqrt(np.maximum(upto(x * x), 0.0))) + _SLACK
        over = np.flatnonzero(rest > floor[row] * _UNREAD)
        stop = np.full(rows, len(row))
        np.minimum.at(stop, row[over], over)
        cut = np.arange(len(row)) < stop[row]
        unread = np.zeros(rows)
        np.maximum.at(unread, row[cut], rest[cut])
        known += self.sums(rows, row[~cut], term[~cut], x[~cut], _HEAD, None)
        can = known + unread[:, None] + _SLACK >= floor[:, None]
        row, term, x, tails = (v[cut] for v in (row, term, x, tails))
        n = np.bincount(row, minlength=rows)
        dear = (np.count_nonzero(can, axis=1) * n > np.bincount(row, tails, minlength=rows))[row]  # reading on costs less
        known += self.sums(rows, row[dear], term[dear], x[dear], _HEAD, None)
        row, term, x = (v[~dear] for v in (row, term, x))
        n = np.bincount(row, minlength=rows)
        cells = np.nonzero(can & (n > 0)[:, None])
        known[cells] += self.looked_up(*cells, n, term, x)
        return np.where(can, known, 0.0)

    def tiles(self, row: np.ndarray, term: np.ndarray, rows: int) -> Iterator[tuple[int, int]]:
        """Rows from and to, so that sums by passage and postings of a tile are bounded."""
        read = np.concatenate([[0], np.cumsum(np.bincount(row, np.diff(self.starts)[term], minlength=rows))])
        start = 0
        while start < rows:
            stop = int(np.searchsorted(read, read[start] + _TILE, "right")) - 1
            stop = min(max(stop, start + 1), start + max(1, _TILE // len(self.ids)), rows)
            yield start, stop
            start = stop

    def best(self, words: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and similarities of the best k passages of each list of words; equal ones in the order of their ids."""
        rows, k = len(words), min(k, len(self.ids))
        flat, width = pc.list_flatten(words), max(len(self.idf), 1)
        no = pc.fill_null(pc.index_in(flat, value_set=self.terms.cast(flat.type)), -1).to_numpy()
        pairs = pc.list_parent_indices(words).to_numpy().astype(np.int64) * width + no
        pairs, tf = np.unique(pairs[no >= 0], return_counts=True)
        row, term = pairs // width, pairs % width
        x = tf * self.idf[term]
        norm = np.sqrt(np.bincount(row, x * x, minlength=rows))
        place, dot = np.zeros((rows, k), np.int64), np.zeros((rows, k))
        for start, stop in self.tiles(row, term, rows):
            own = slice(*np.searchsorted(row, [start, stop]))
            found = self.dots(stop - start, row[own] - start, term[own], x[own], k)
            shown = np.round(found, 9)
            each = np.arange(stop - start)
            for i in range(k):
                at = shown.argmax(axis=1)
                place[start:stop, i], dot[start:stop, i] = at, found[each, at]
                shown[each, at] = -1.0
        return place, np.divide(dot, norm[:, None], out=np.zeros_like(dot), where=norm[:, None] > 0)


def _few(index: PrunedIndex) -> _Few | None:
    """The index in arrays, if it has few passages, each with an id of its own."""
    if not 0 < index.passages <= _FEW or (index.table("terms").agg(F.sum("df")).first()[0] or 0) > _FEW_POSTINGS:
        return None
    passages = index.table("passages").select("number", "passage_id").orderBy("passage_id").toArrow().combine_chunks()
    ids = passages["passage_id"].combine_chunks()
    if pc.count_distinct(ids, mode="all").as_py() < len(ids):
        return None
    terms, postings = index.table("terms").select("term", "idf").toArrow(), index.table("weights").select("term", "number", "weight").toArrow()
    names = terms["term"].combine_chunks()
    no = pc.index_in(postings["term"], value_set=names).to_numpy().astype(np.int64)
    place = pc.index_in(postings["number"], value_set=passages["number"].combine_chunks()).to_numpy().astype(np.int64)
    weight = postings["weight"].to_numpy()
    order = np.lexsort((place, -weight, no))
    no, place, weight = no[order], place[order], weight[order]
    held = place * len(names) + no
    held_at = np.argsort(held)
    starts = np.concatenate([[0], np.cumsum(np.bincount(no, minlength=len(names)))])
    return _Few(ids, names, terms["idf"].to_numpy(), starts, place, weight, held[held_at], held_at)


def _top_of_few(few: _Few, queries: DataFrame, row_id: str, text: str, index: PrunedIndex, k: int, pattern: str) -> DataFrame:
    """``top_passages`` where the queries are; ids that come twice or are null take the join, where their rows meet."""
    path = fresh_path(index.spark, "query_best")
    schema = StructType([queries.schema[row_id]])
    schema = schema.add("ids", ArrayType(index.table("passages").schema["passage_id"].dataType)).add("similarities", ArrayType(DoubleType()))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, similarity = few.best(batch.column("_words"), k)
            ends = pa.array(np.arange(len(place) + 1) * place.shape[1], pa.int32())
            ids = pa.ListArray.from_arrays(ends, few.ids.take(pa.array(place.ravel())))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, pa.ListArray.from_arrays(ends, pa.array(similarity.ravel()))], schema.names)

    found = _kept(queries.select(row_id, tx.tokens(F.col(text), pattern).alias("_words")).mapInArrow(find, schema), f"{path}/found")
    counts = found.groupBy(F.col(row_id).alias("_id")).agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") > 1) | F.col("_id").isNull())
    shared = _kept(counts.select("_id"), f"{path}/shared")
    each = lambda df: df.select(row_id, F.posexplode(F.arrays_zip("ids", "similarities")).alias("_r", "_p"))
    named = lambda df: each(df).select(row_id, F.col("_p.ids").alias("passage_id"), F.col("_p.similarities").alias("similarity"), (F.col("_r") + 1).alias("rank"))
    if shared.isEmpty():
        return named(found)
    is_shared = F.col(row_id).eqNullSafe(F.col("_id"))
    met = _top_of_join(queries.join(shared, is_shared, "left_semi"), row_id, text, index, k, pattern)
    return named(found.join(shared, is_shared, "left_anti")).unionByName(met)


def _top_of_join(queries: DataFrame, row_id: str, text: str, index: PrunedIndex, k: int, pattern: str) -> DataFrame:
    """``top_passages`` by joins of terms and postings, for any number of passages."""
    found = similarities(queries, row_id, text, index, k, pattern).withColumn("similarity", F.coalesce(F.try_divide("dot", "norm"), F.lit(0.0)))
    first = index.table("passages").select("passage_id").orderBy("passage_id").limit(2 * k).collect()
    listed = F.array(*[F.lit(r["passage_id"]) for r in first]).cast(f"array<{index.table('passages').schema['passage_id'].dataType.simpleString()}>")
    rest = queries.select(row_id, F.explode(listed).alias("passage_id"), F.lit(None).cast("double").alias("dot"), F.lit(0.0).alias("similarity"))
    rows = found.select(row_id, "passage_id", "dot", "similarity").unionByName(rest)
    one = rows.groupBy(row_id, "passage_id").agg(F.coalesce(F.max("dot"), F.lit(0.0)).alias("dot"), F.max("similarity").alias("similarity"))
    order = Window.partitionBy(row_id).orderBy(F.desc(F.round("dot", 9)), F.asc("passage_id"))
    return one.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(row_id, "passage_id", "similarity", "rank")


def top_passages(queries: DataFrame, row_id: str, text: str, index: PrunedIndex, k: int = 2, pattern: str = fixed.TOKEN_PATTERN) -> DataFrame:
    """Best k passages per query by cosine: (id, passage_id, similarity, rank), as ``grounding.top_passages``.

    Passages without a common term have similarity 0 and complete the k in the order of their ids.
    """
    few = _few(index)
    return _top_of_join(queries, row_id, text, index, k, pattern) if few is None else _top_of_few(few, queries, row_id, text, index, k, pattern)


def grounding_scores(queries: DataFrame, row_id: str, text: str, index: PrunedIndex, k: int = 2, pattern: str = fixed.TOKEN_PATTERN) -> DataFrame:
    """(id, grounding): mean of the best k similarities over as many passages as there are, as ``grounding.grounding_scores``."""
    best = top_passages(queries, row_id, text, index, k, pattern).groupBy(row_id).agg(F.sum("similarity").alias("_s"))
    slots = F.lit(float(min(k, index.passages)))
    return queries.select(row_id).join(best, row_id, "left").select(row_id, F.coalesce(F.try_divide(F.col("_s"), slots), F.lit(0.0)).alias("grounding"))
