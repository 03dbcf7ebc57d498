"""What the operators of this package share: row keys, stored tables, byte-bounded slices of Arrow batches.

Rows are told apart by value: ``key`` is the integer id, with null counted as the largest id, and ``digest`` a hash of
the text. Rows that repeat both are the same document and get the same verdict; rows that share only the id are judged
each by its own text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.sources.shared import fresh_path

#: Stands for a null id wherever ids are ordered.
LAST_KEY = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, digest, text as bytes); only ``doc_id`` and ``text`` are read, so other columns cannot clash."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_KEY)).alias("key"),
        F.xxhash64(text).alias("digest"),
        text.cast("binary").alias("text"),
    )


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_verdict(docs: DataFrame, verdicts: DataFrame, how: str) -> DataFrame:
    """Join whole rows of ``docs`` with ``verdicts`` (key, digest, ...), whatever else their columns are called."""
    key, digest = free_name(docs, "row_key"), free_name(docs, "row_digest")
    wide = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_KEY)), digest: F.xxhash64(F.coalesce("text", F.lit("")))})
    same = (wide[key] == verdicts["key"]) & (wide[digest] == verdicts["digest"])
    rest = [c for c in verdicts.columns if c not in ("key", "digest")]
    joined = wide.join(verdicts, same, how)
    return joined.select(*[wide[c] for c in docs.columns], *([] if "semi" in how or "anti" in how else [verdicts[c] for c in rest]))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage in a way that survives lost executors."""
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``stored``, with the path, for an owner that removes the table when nothing reads it any more."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column one after another, and where each row begins (one entry more than rows)."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds at most ``limit`` bytes, or one row that is longer."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        _, offsets = bytes_of(batch.column(at))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end
