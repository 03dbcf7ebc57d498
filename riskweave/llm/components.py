"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import stored_at
from riskweave.sources.shared import remove


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.expr("bit_xor(xxhash64(a, b))"), F.sum(F.col("a").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b: long); the label is the smallest node that can be reached.

    Each round links every larger neighbour to the smallest one (large star), then every smaller neighbour (small
    star), until nothing changes. Rounds grow with the logarithm of a component's size. The table of a round goes to the
    shared folder and is removed after the next; the driver sees a count and checksums only. Loops and repeated edges are ignored, null ends too.
    """
    edge = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edge, path = stored_at(edge, "edges")
    mark = _mark(edge)
    while mark[0]:
        both = edge.union(edge.select("b", "a")).toDF("a", "b")
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", "low"), F.struct(F.col("b").alias("a"), "low"))).alias("e"))
        old = path
        edge, path = stored_at(small.select("e.a", F.col("e.low").alias("b")).where("a <> b").distinct(), "edges")
        last, mark = mark, _mark(edge)
        remove(edge.sparkSession, old)
        if last == mark:
            break
    return edge.select(F.col("a").alias("node"), F.col("b").alias("label")).union(edge.select("b", "b").distinct())
