"""Merkle manifest of a dataset: per language a tree over its documents, over the languages one more, with proofs.

Nodes are nested inside bounded blocks of 512: rank digits are grouped away one after another, each level an array of
structs inside its parent. Blocks are the leaves of the next tier, until one node is left. On the way back a block meets
the steps above it in one grouping, and a transform over its nested structs explodes into its children's steps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.common import stored_at
from riskweave.sources.shared import remove

#: Children of a node as a power of two, and levels inside a block.
_BITS, _LEVELS = 3, 3
_FAN, _SPAN = 1 << _BITS, 1 << _BITS * _LEVELS
_STEPS = "array<struct<left:string,right:string>>"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf(*values: Column) -> Column:
    """Digest of a row: each value as its byte count, a colon and its text, or a dash if it is null."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def fold(digest: Column, steps: Column) -> Column:
    """Root that a digest and its steps (digests to the left and right of it, level by level) lead to."""
    return F.aggregate(steps, digest, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def _ranked(nodes: DataFrame, by: Sequence[str]) -> tuple[DataFrame, int, str]:
    """``nodes`` with their rank and number per ``tree`` in the order of ``by`` and hash; the largest number; a scratch path.

    Rows are range-partitioned and numbered inside their range, so no task holds a tree. The stored layout keeps ranks
    stable if a task is repeated. Rows that tie in all columns are alike, and may fall into several ranges.
    """
    order = ["tree", *by, "hash"]
    placed = nodes.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order, "_tie").withColumn("_range", F.spark_partition_id())
    placed, path = stored_at(placed, "ranges")
    counts = placed.groupBy("tree", "_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("tree").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("tree").alias("_tree"), F.col("_range").alias("_at"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy("tree")).alias("size"),
    )
    most = counts.agg(F.max("size")).first()[0] or 0
    number = F.row_number().over(Window.partitionBy("tree", "_range").orderBy(*by, "hash", "_tie")).cast("long")
    both = placed.withColumn("_no", number).join(counts, F.col("tree").eqNullSafe(F.col("_tree")) & (F.col("_range") == F.col("_at")))
    return both.select("tree", (F.col("_before") + F.col("_no") - 1).alias("rank"), "size", "hash", "item"), most, path


def _blocks(rows: DataFrame) -> DataFrame:
    """(tree, rank, size, hash, kids) per block of ``rows`` (tree, rank, size, hash, item), one shuffle for all levels.

    ``size`` is the number of rows of the tree. A level is hashed only if the tree has several nodes there.
    """
    digits = [F.shiftright("rank", _BITS * k).bitwiseAND(F.lit(_FAN - 1)).alias(f"d{k}") for k in range(_LEVELS)]
    block = F.shiftright("rank", _BITS * _LEVELS).alias("rank")
    nodes, inside = rows.select("tree", block, "size", "hash", "item", *digits).repartition("tree", "rank"), "item"
    for level in range(_LEVELS):
        kid = F.struct(f"d{level}", "hash", inside)
        nodes = nodes.groupBy("tree", "rank", *[f"d{k}" for k in range(level + 1, _LEVELS)]).agg(
            F.max("size").alias("size"), F.array_sort(F.collect_list(kid)).alias("kids")
        )
        hashes = F.col("kids.hash")
        nodes = nodes.withColumn("hash", F.when(F.col("size") > _FAN**level, F.sha2(F.array_join(hashes, ""), 256)).otherwise(hashes[0]))
        inside = "kids"
    return nodes.select("tree", "rank", "size", "hash", "kids")


def _tree(rows: DataFrame, most: int) -> list[tuple[DataFrame, str]]:
    """Stored blocks of all tiers, the lowest first; the last tier has one row per tree, whose hash is the tree's."""
    tiers = [stored_at(_blocks(rows), "blocks")]
    while most > _SPAN:
        most = -(-most // _SPAN)
        upper = tiers[-1][0].select("tree", "rank", F.ceil(F.col("size") / _SPAN).alias("size"), "hash", F.col("rank").alias("item"))
        tiers.append(stored_at(_blocks(upper), "blocks"))
    return tiers


def _unrolled(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """(tree, hash, item, steps, marks) per child of ``blocks``; ``above`` holds (tree, rank, steps, marks) of the blocks."""
    empty = F.array().cast(_STEPS)
    block, upper = F.struct("size", "kids").alias("block"), F.struct("steps", "marks").alias("above")
    none = lambda df, c: F.lit(None).cast(df.select(c).schema[0].dataType).alias(df.select(c).columns[0])
    both = blocks.select("tree", "rank", block, none(above, upper)).unionByName(above.select("tree", "rank", none(blocks, block), upper))
    whole = both.groupBy("tree", "rank").agg(F.first("block", True).alias("block"), F.first("above", True).alias("above"))

    def spread(kids: Column, level: int, steps: Column) -> Column:
        def child(kid: Column, at: Column) -> Column:
            hashes = F.transform(kids, lambda k: k["hash"])
            step = F.struct(F.array_join(F.slice(hashes, F.lit(1), at), "").alias("left"), F.array_join(F.slice(hashes, at + 2, F.lit(_FAN)), "").alias("right"))
            longer = F.concat(F.when(F.col("block.size") > _FAN**level, F.array(step)).otherwise(empty), steps)
            if level:
                return spread(kid["kids"], level - 1, longer)
            return F.struct(kid["hash"].alias("hash"), kid["item"].alias("item"), longer.alias("steps"))

        return F.flatten(F.transform(kids, child)) if level else F.transform(kids, child)

    children = F.explode(spread(F.col("block.kids"), _LEVELS - 1, F.col("above.steps"))).alias("c")
    return whole.select("tree", children, "above.marks").select("tree", "c.hash", "c.item", "c.steps", "marks")


def _down(tiers: list[tuple[DataFrame, str]], above: DataFrame) -> DataFrame:
    """Children of the lowest tier with all steps; ``above`` belongs to the highest."""
    for blocks, _ in reversed(tiers[1:]):
        above = _unrolled(blocks, above).select("tree", F.col("item").alias("rank"), "steps", "marks")
    return _unrolled(tiers[0][0], above)


def proofs(nodes: DataFrame, by: Sequence[str]) -> DataFrame:
    """(tree, hash, item, steps, subroot, root) per row of ``nodes`` (tree, hash, item, and the columns of ``by``).

    Rows of a tree ascend by ``by`` (nulls first) and hash; trees ascend by name, a null first. While a tree has several
    nodes, every eight consecutive ones become the digest of their concatenation, a last run of fewer too. ``steps`` are
    the digests left and right of a node in its run, level by level to the root. An empty table has no root and no row.
    """
    rows, most, path = _ranked(nodes, by)
    tiers = _tree(rows, most)
    trees = tiers[-1][0].select(F.lit(0).alias("tree"), "hash", F.col("tree").alias("item"), F.col("tree").alias("name"))
    named, count, other = _ranked(trees, ["name"])
    top = _tree(named, count)
    for old in (path, other):
        remove(nodes.sparkSession, old)
    first = top[-1][0].select("tree", "rank", F.array().cast(_STEPS).alias("steps"), F.struct(F.col("hash").alias("root")).alias("marks"))
    tops = _down(top, first)
    above = tops.select(F.col("item").alias("tree"), F.lit(0).cast("long").alias("rank"), "steps", F.struct("marks.root", F.col("hash").alias("subroot")).alias("marks"))
    return _down(tiers, above).select("tree", "hash", "item", "steps", "marks.subroot", "marks.root")


def tampered(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, steps, altered) per row of documents; ``altered`` is the leaf after tampering.

    A third of the ids, by crc32, have the A-Z of their text lower-cased after sealing; a null id or text is not
    altered. Only the five fields of a leaf are read, so other columns cannot clash. Rows with equal ids are leaves of
    their own, ordered by digest; a null id comes first.
    """
    value = {c: F.col(c) for c in FIELDS}
    sealed = leaf(*value.values())
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    other = leaf(*{**value, "text": tampered(F.col("text"))}.values())
    nodes = docs.select(*FIELDS).select(F.col("lang").alias("tree"), "doc_id", sealed.alias("hash"), F.when(hit, other).alias("_other"))
    nodes = nodes.select("tree", "doc_id", "hash", F.struct("doc_id", F.coalesce("_other", "hash").alias("altered")).alias("item"))
    nodes, path = stored_at(nodes, "leaves")
    found = proofs(nodes, ["doc_id"])
    remove(docs.sparkSession, path)
    return found.select("item.doc_id", F.col("hash").alias("leaf"), "subroot", "root", "steps", "item.altered")


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) per row, from ``manifest``."""
    found = manifest(docs).withColumn("folded_root", fold(F.col("altered"), F.col("steps")))
    listed = F.array_join(F.transform("steps", lambda s: F.concat(s["left"], s["right"])), "")
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(listed, 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
