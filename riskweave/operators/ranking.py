"""Exact order statistics without a global sort and without an unbounded group."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from riskweave.sources.local import small_frame

_PER_E_FOLD = 64
_PARTS = 1024


def _coarse(value: Column) -> Column:
    size = F.least(F.log1p(F.abs(value)), F.lit(710.0))
    return F.floor(F.signum(value) * size * _PER_E_FOLD).cast("long")


def _part(value: Column, low: Column, high: Column) -> Column:
    """Index of the equal-width part of [low, high] that holds the value."""
    place = F.floor((value - low) / (high - low) * _PARTS).cast("long")
    return F.when(high > low, F.least(place, F.lit(_PARTS - 1))).otherwise(F.lit(0).cast("long"))


def _preceding(keys: Sequence[str], *order: str):
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


class _Want(NamedTuple):
    """A zero-based rank still to be resolved, and the bucket known to hold it."""

    key: tuple
    prob: int
    end: int
    rank: int
    weight: float
    bucket: tuple
    before: int
    rows: int
    low: float
    high: float


def _local(spark: SparkSession, df: DataFrame, keys: Sequence[str], extra: str, rows) -> DataFrame:
    schema = StructType([df.schema[k] for k in keys])
    for field in StructType.fromDDL(extra):
        schema = schema.add(field)
    return F.broadcast(small_frame(spark, rows, schema))


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probs: Sequence[float],
    method: str = "linear",
    bucket_rows: int = 1_000_000,
) -> dict[tuple, list[float]]:
    """Exact quantiles per group: key values -> one number per probability.

    ``linear`` interpolates between neighbours at position p*(n-1); ``discrete`` gives the
    element of rank ceil(p*n). NULL and NaN values and NULL keys are left out. ``keys`` must
    have few combinations (feature names, classes): per combination two ranks for each
    probability come back to the caller, whatever the number of rows.

    Every scan aggregates before it shuffles. The first counts logarithmic buckets. While a
    bucket with a wanted rank has more than ``bucket_rows`` rows, a scan cuts it into equal parts
    between its own minimum and maximum, so a crowded stretch of the axis is split again. The
    last scan counts the distinct values of what is left. Buckets are pure functions of the
    data: a recomputed task gives the same answer. Cutting goes on until every bucket is small
    enough or holds one value.
    """
    if method not in ("linear", "discrete"):
        raise ValueError(f"unknown quantile method {method}")
    spark = df.sparkSession
    usable = F.col("_v").isNotNull() & ~F.isnan("_v")
    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where(usable)
    rows = rows.dropna(subset=keys).withColumn("_b", _coarse(F.col("_v")))
    numbers = [F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]
    found: dict[tuple, float] = {}

    def holding(buckets: DataFrame, rank: Column, before: Column) -> DataFrame:
        return buckets.where((rank >= before) & (rank < before + F.col("_n")))

    def settle(hits: list, bucket_names: list[str]) -> list[_Want]:
        """Note ranks whose bucket holds one value only; return the others."""
        open_wants = []
        for h in hits:
            key = tuple(h[k] for k in keys)
            bucket = tuple(h[b] for b in bucket_names)
            want = _Want(
                key, h["prob"], h["end"], h["rank"], h["w"], bucket, h["before"], h["_n"], h["_lo"], h["_hi"]
            )
            weights[key, want.prob] = want.weight
            if h["_lo"] == h["_hi"]:
                found[key, want.prob, want.end] = h["_lo"]
            else:
                open_wants.append(want)
        return open_wants

    weights: dict[tuple, float] = {}
    want_ddl = "prob int, end int, rank long, w double, _start long"

    coarse = rows.groupBy(*keys, "_b").agg(*numbers)
    coarse = coarse.select(
        "*",
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_total"),
        F.coalesce(F.sum("_n").over(_preceding(keys, "_b")), F.lit(0)).alias("before"),
    )
    # Each probability asks for one rank, or for the two neighbours of its position.
    listed = ", ".join(f"CAST({p!r} AS DOUBLE)" for p in probs)
    exploded = coarse.select("*", F.posexplode(F.expr(f"array({listed})")).alias("prob", "p"))
    last = F.col("_total") - 1
    if method == "discrete":
        rank = F.greatest(F.ceil(F.col("p") * F.col("_total")) - 1, F.lit(0)).cast("long")
        exploded = exploded.withColumns({"end": F.lit(0), "rank": rank, "w": F.lit(0.0)})
    else:
        exploded = exploded.withColumns({"end": F.explode(F.expr("array(0, 1)")), "w": F.col("p") * last})
        floor = F.floor("w").cast("long")
        exploded = exploded.withColumns(
            {"rank": F.least(floor + F.col("end"), last), "w": F.col("w") - floor}
        )
    hits = holding(exploded, F.col("rank"), F.col("before")).collect()
    left = settle(hits, ["_b"])

    near, place = rows, [*keys, "_b"]

    def asked(wants: list[_Want]) -> DataFrame:
        ddl = ", ".join([*(f"{b} long" for b in place[len(keys) :]), want_ddl])
        return _local(
            spark, df, keys, ddl,
            [(*w.key, *w.bucket, w.prob, w.end, w.rank, w.weight, w.before) for w in wants],
        )

    def resolve(buckets: DataFrame, name: str, wants: list[_Want]) -> list:
        """Ranks of the wants located in finer buckets of each place."""
        earlier = F.coalesce(F.sum("_n").over(_preceding(place, name)), F.lit(0))
        placed = buckets.withColumn("_in", earlier).join(asked(wants), place)
        placed = placed.withColumn("before", F.col("_start") + F.col("_in"))
        return holding(placed, F.col("rank"), F.col("before")).collect()

    level = 0
    while any(w.rows > bucket_rows for w in left):  # a round parts the smallest value of a place from the largest
        name = f"_p{level}"
        ddl = ", ".join([*(f"{b} long" for b in place[len(keys) :]), "_lo double, _hi double"])
        cut = _local(spark, df, keys, ddl, {(*w.key, *w.bucket, w.low, w.high) for w in left})
        part = _part(F.col("_v"), F.col("_lo"), F.col("_hi"))
        near = near.join(cut, place).select(*place, part.alias(name), "_v")
        parts = near.groupBy(*place, name).agg(*numbers)
        left = settle(resolve(parts, name, left), [*place[len(keys) :], name])
        place = [*place, name]
        level += 1

    if left:
        ddl = ", ".join(f"{b} long" for b in place[len(keys) :])
        places = _local(spark, df, keys, ddl, {(*w.key, *w.bucket) for w in left})
        values = near.join(places, place).groupBy(*place, "_v").agg(*numbers)
        settle(resolve(values, "_v", left), place[len(keys) :])

    result: dict[tuple, list[float]] = {}
    for key in {k for k, _, _ in found}:
        result[key] = []
        for i in range(len(probs)):
            low = found[key, i, 0]
            high = found.get((key, i, 1), low)
            result[key].append(low if high == low else low + (high - low) * weights[key, i])
    return result


def running_before(
    df: DataFrame, keys: list[str], value: str, measures: list[str], rows_per_part: int = 250_000
) -> DataFrame:
    """Add ``<measure>_before``: the sum over all rows of the group with a smaller value.

    ``df`` holds one row per (keys, value): aggregate duplicates first, so that a value shared
    by many rows is one row here. Rows whose value is NULL or NaN have no place and are left out;
    NULL keys form a group. Pass a stored or cheap frame: it is scanned once per level and once more.

    Values are put into logarithmic buckets, and a bucket with more than ``rows_per_part`` rows is
    cut into equal parts between its own minimum and maximum, level by level, until all are small
    or hold one number. A row's sum is that of the earlier buckets of each level, and of the
    earlier rows of its own. So no window sees more than the buckets of one level or the rows of
    one part, at any table size and for any ``rows_per_part``, which does not change the result.
    """
    number = F.col(value).cast("double")
    placed = df.where(number.isNotNull() & ~F.isnan(number)).withColumn("_at0", _coarse(number))
    path = ["_at0"]
    while True:
        sums = [F.sum(m).alias(f"_t_{m}") for m in measures]
        bounds = [F.count("*").alias("_n"), F.min(number).alias("_lo"), F.max(number).alias("_hi")]
        buckets = placed.groupBy(*keys, *path).agg(*bounds, *sums)
        crowded = (F.col("_n") > rows_per_part) & (F.col("_lo") < F.col("_hi"))
        if not buckets.agg(F.coalesce(F.bool_or(crowded), F.lit(False))).first()[0]:
            break
        finer = buckets.select(*keys, *path, "_lo", "_hi", crowded.alias("_cut"))
        part = F.when(F.col("_cut"), _part(number, F.col("_lo"), F.col("_hi"))).otherwise(F.lit(0).cast("long"))
        name = f"_at{len(path)}"
        placed = _same(placed, finer, [*keys, *path]).withColumn(name, part).drop("_lo", "_hi", "_cut")
        path.append(name)
    offsets = buckets.select(*keys, *path, *[F.col(f"_t_{m}") for m in measures], *[F.lit(0).alias(f"_o_{m}") for m in measures])
    for level in range(len(path)):
        upper = [*keys, *path[:level]]
        own = offsets.groupBy(*upper, path[level]).agg(*[F.sum(f"_t_{m}").alias(f"_s_{m}") for m in measures])
        before = [F.coalesce(F.sum(f"_s_{m}").over(_preceding(upper, path[level])), F.lit(0)).alias(f"_b_{m}") for m in measures]
        own = own.select(*upper, path[level], *before)
        offsets = _same(offsets, own, [*upper, path[level]])
        offsets = offsets.withColumns({f"_o_{m}": F.col(f"_o_{m}") + F.col(f"_b_{m}") for m in measures})
        offsets = offsets.drop(*[f"_b_{m}" for m in measures])
    offsets = offsets.drop(*[f"_t_{m}" for m in measures])
    inside = _preceding([*keys, *path], value)
    local = placed.select("*", *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"_i_{m}") for m in measures])
    joined = _same(local, offsets, [*keys, *path])
    totals = {f"{m}_before": F.col(f"_o_{m}") + F.col(f"_i_{m}") for m in measures}
    return joined.select(*df.columns, *[c.alias(n) for n, c in totals.items()])


def _same(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join on columns that may be NULL."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    test = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in on])
    return left.join(renamed, test).drop(*[f"_r_{c}" for c in on])


def with_ordinal(df: DataFrame, order: str, name: str, rows_per_part: int = 250_000) -> DataFrame:
    """Zero-based position of each row in the order of a unique numeric column.

    Rows without a number have no position and are left out. A number that comes twice raises.
    """
    ones = df.select("*", F.lit(0).alias("_g"), F.lit(1).cast("long").alias("_one"))
    counts = df.where(F.col(order).isNotNull()).groupBy(order).agg(F.count("*").alias("_n")).where("_n > 1")
    if not counts.isEmpty():
        raise ValueError(f"{order} is not unique")
    numbered = running_before(ones, ["_g"], order, ["_one"], rows_per_part)
    return numbered.drop("_g", "_one").withColumnRenamed("_one_before", name)
