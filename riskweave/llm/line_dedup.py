"""Line dedup: hash ranges sorted by document and position, first occurrences streamed, keep bitmaps returned."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.llm.common import free_name, keyed, partitions, with_verdict

_BLANK = b" \t\n\x0b\x0c\r"
_OCCURRENCE = "slot int, hi long, lo long, key long, digest long, pos int, sure boolean"


def line_key(line: bytes) -> bytes:
    return line.strip(_BLANK).lower()


def _long_enough(key: bytes, least: int) -> bool:
    """At least so many code points; bytes are counted first, as that settles nearly all."""
    if len(key) < least:
        return False
    return len(key) >= 4 * least or sum((b & 0xC0) != 0x80 for b in key) >= least


def _occurrences(least: int, slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, rows, places = [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                for pos, line in enumerate(text.split(b"\n")):
                    key = line_key(line)
                    if _long_enough(key, least):
                        digests.append(xxhash.xxh3_128_digest(key))
                        rows.append(row)
                        places.append(pos)
            if not rows:
                continue
            both = np.frombuffer(b"".join(digests), ">u8").astype("<u8").reshape(-1, 2)
            row, pos = np.array(rows), np.array(places, np.int32)
            key = batch.column("key").to_numpy()[row]
            order = np.lexsort((pos, key, both[:, 1], both[:, 0]))
            hi, lo, key, pos, row = both[order, 0], both[order, 1], key[order], pos[order], row[order]
            new = np.ones(len(hi), bool)
            new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
            sure = key != key[np.maximum.accumulate(np.where(new, np.arange(len(hi)), 0))]
            # A line that an earlier document of this batch holds is decided here; it needs no place in the hash ranges.
            slot = np.where(sure, (key ^ pos) % slots, ((hi >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)).astype(np.int32)
            hi, lo = np.where(sure, 0, hi.view(np.int64)), np.where(sure, 0, lo.view(np.int64))
            digest = batch.column("digest").to_numpy()[row]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (slot, hi, lo, key, digest, pos, sure)], ["slot", "hi", "lo", "key", "digest", "pos", "sure"])

    return run


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by hash, document and position; only the hash in hand and its first document are carried on."""
    last = (None, None, None)
    for batch in batches:
        if not batch.num_rows:
            continue
        hi, lo, key, sure = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("hi", "lo", "key", "sure"))
        decided = np.flatnonzero(~sure)
        drop = sure.copy()
        if len(decided):
            h, low, k = hi[decided], lo[decided], key[decided]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (low[1:] != low[:-1])
            first = k[np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))]
            if (h[0], low[0]) == last[:2]:
                lead = len(h) if new.sum() == 1 else int(np.flatnonzero(new)[1])
                first[:lead] = last[2]
            last = (h[-1], low[-1], first[-1])
            drop[decided] = k != first
        taken = pa.array(np.flatnonzero(drop))
        yield pa.RecordBatch.from_arrays([batch.column(c).take(taken) for c in ("key", "digest", "pos")], ["key", "digest", "pos"])


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = []
        for gone in batch.column("gone"):
            at = gone.values.to_numpy()
            keep = np.ones((int(at.max()) // 8 + 1) * 8, bool)
            keep[at] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes(), 6))
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("digest"), pa.array(maps, pa.binary())], ["key", "digest", "keep"])


def keep_bitmaps(docs: DataFrame, least: int = 10) -> DataFrame:
    """(key, digest, keep) for each document that loses lines; ``keep`` is a deflated bitmap, lines past its end stay.

    A line's key is the line without ASCII white space at both ends and with A-Z lowered. Keys of ``least`` or more code
    points that two or more documents hold stay only in the smallest id. No text is shuffled: a line travels as a 128-bit
    hash. Hashes are uniform, so the ranges have fixed borders and need no sampling pass. Lines already beaten inside
    their Arrow batch are decided there; a line that a third of all documents share leaves one document per batch.
    """
    slots = partitions(docs.sparkSession)
    found = keyed(docs).select("key", "digest", "text").mapInArrow(_occurrences(least, slots), _OCCURRENCE)
    ranges = found.repartitionById(slots, F.col("slot")).sortWithinPartitions("hi", "lo", "key", "pos")
    gone = ranges.mapInArrow(_stream, "key long, digest long, pos int")
    per_doc = gone.groupBy("key", "digest").agg(F.collect_set("pos").alias("gone"))
    return per_doc.mapInArrow(_bitmaps, "key long, digest long, keep binary")


def apply_bitmap(text: bytes, keep: bytes | None) -> tuple[bytes, int, int]:
    """(kept text, lines, dropped lines)."""
    lines = text.split(b"\n")
    if keep is None:
        return text, len(lines), 0
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8))[: len(lines)].tolist()
    kept = [line for line, bit in zip(lines, bits, strict=False) if bit] + lines[len(bits) :]
    return b"\n".join(kept), len(lines), len(lines) - len(kept)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cut = [apply_bitmap(t, k) for t, k in zip(batch.column("text").to_pylist(), batch.column("keep").to_pylist(), strict=True)]
        columns = [
            batch.column("doc_id"),
            pa.array([c[1] for c in cut], pa.int64()),
            pa.array([c[2] for c in cut], pa.int64()),
            pa.array([hashlib.sha256(c[0]).hexdigest() for c in cut], pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_lines", "n_dropped", "kept_sha256"])


def line_digest(docs: DataFrame, least: int = 10) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) per row. Null and empty texts are one empty line.

    A null id ranks as the largest; rows sharing an id are one holder of a line, each with its own positions.
    """
    maps = keep_bitmaps(docs, least)
    joined = keyed(docs).join(maps, ["key", "digest"], "left").select("doc_id", "text", "keep")
    return joined.mapInArrow(_digests, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def _texts(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            pairs = zip(batch.column("text").to_pylist(), batch.column(name).to_pylist(), strict=True)
            cut = [None if t is None else apply_bitmap(t.encode(), k)[0].decode() for t, k in pairs]
            yield from pa.Table.from_batches([batch]).drop_columns([name]).set_column(at, "text", pa.array(cut, pa.string())).to_batches()

    return run


def dedup_lines(docs: DataFrame, least: int = 10) -> DataFrame:
    """``docs`` with repeated lines cut from ``text`` and ``n_chars``, if there, counted anew. Rows and nulls stay."""
    keep = free_name(docs, "keep")
    joined = with_verdict(docs, keep_bitmaps(docs, least).withColumnRenamed("keep", keep), "left")
    out = joined.select(*docs.columns, keep).mapInArrow(_texts(keep), docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out
