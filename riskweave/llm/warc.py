"""WARC archives: writing, reading, and assembly of transactions through concurrent-to identifiers."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import stored

_MARK = b"WARC/1."
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_RECORD = (
    "record_id string, type string, concurrent_to array<string>, refers_to string, target_uri string, date string, content_type string, "
    "http_head string, payload_bytes long, payload_digest string, payload binary"
)


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hexadecimal digits are four letters. The hash is taken once per row."""

    def letters(digits: Column) -> Column:
        value = lambda i: F.conv(F.substring(digits, 5 * i + 1, 5), 16, 10).cast("int")
        letter = lambda v, shift: F.substring(F.lit(_ALPHABET), F.shiftright(v, shift).bitwiseAND(31) + 1, F.lit(1))
        return F.concat(*[letter(value(i), shift) for i in range(8) for shift in (15, 10, 5, 0)])

    return F.transform(F.array(F.sha1(data)), letters)[0]


def _one_line(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x00-\x20\x7F]", "%20")


def _record(kind: Column, uri: Column, headers: list[Column], content_type: str, block: Column, date: str, target: Column) -> Column:
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind), F.concat(F.lit("WARC-Record-ID: <"), uri, F.lit(">")), F.lit(f"WARC-Date: {date}")]
    lines += [F.concat(F.lit("WARC-Target-URI: "), target), *headers, F.lit(f"Content-Type: {content_type}")]
    size = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(F.concat_ws("\r\n", *lines, size), F.lit("\r\n\r\n"), block)  # concat_ws leaves out null headers


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write request, response or revisit, and metadata of each row of (page_id, url, html) as gzip WARC files.

    Of rows with equal payloads, the one with the largest page_id is the response, the others revisit it and keep only
    their HTTP header. A null html is an empty payload, a null url an empty target; a null page_id ranks smallest. The
    files are plain text output with the record end as line separator, so Spark's committer makes retries safe.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), _one_line(F.col("url")).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload").cast("binary")))
    last = rows.groupBy("digest").agg(F.max("page_id").alias("last"), F.min("page_id").alias("first"), F.count("page_id").alias("ids"), F.count(F.lit(1)).alias("n"))
    last = last.where("n > 1 and (first < last or ids < n)").select("digest", "last")
    rows = rows.join(last, "digest", "left")
    own = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    again = F.col("last").isNotNull() & ~F.col("last").eqNullSafe(F.col("page_id"))
    name = lambda page, role: F.concat(F.lit("urn:capture:"), page, F.lit(":"), F.col("digest"), F.lit(f":{role}"))
    capture = name(own, "response")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit("\r\n\r\n"))
    near = F.concat(F.lit("WARC-Concurrent-To: <"), capture, F.lit(">"))
    host = F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)
    asked = F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)", 1)
    response = _record(
        F.when(again, "revisit").otherwise("response"), capture,
        [
            F.concat(F.lit("WARC-Payload-Digest: sha1:"), "digest"),
            F.when(again, F.concat(F.lit("WARC-Refers-To: <"), name(F.col("last").cast("string"), "response"), F.lit(">"))),
            F.when(again, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        ],
        "application/http;msgtype=response", F.when(again, head).otherwise(F.concat(head, "payload")), date, F.col("url"),
    )
    request = _record(F.lit("request"), name(own, "request"), [near], "application/http;msgtype=request", F.concat(F.lit("GET "), F.when(asked == "", "/").otherwise(asked), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit("\r\n\r\n")), date, F.col("url"))
    metadata = _record(F.lit("metadata"), name(own, "metadata"), [near], "application/warc-fields", F.concat(F.lit("page-id: "), own, F.lit("\r\n")), date, F.col("url"))
    records = rows.select(F.explode(F.array(request, response, metadata)).alias("value"))
    records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def _fields(head: bytes) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    unfolded = re.sub(rb"\r\n[ \t]+", b" ", head)
    for line in unfolded.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if colon:
            out.setdefault(name.strip().lower().decode("utf-8", "replace"), []).append(value.strip().decode("utf-8", "replace"))
    return out


def _bare(uri: str) -> str:
    return uri.strip().removeprefix("<").removesuffix(">")


def _parsed(raw: bytes, head_end: int, length: int) -> dict:
    fields = _fields(raw[:head_end])
    one = lambda name: fields.get(name, [None])[0]
    block = raw[head_end + 4 : head_end + 4 + length]
    kind, content = one("warc-type"), one("content-type")
    http, payload = None, block
    if (content or "").lower().startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        http = head.decode("utf-8", "replace")
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    size = len(payload)
    if kind == "revisit":  # the payload is elsewhere; header and digest describe the full one
        digest = (one("warc-payload-digest") or "").rpartition(":")[2] or None
        told = re.search(r"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", http or "")
        size, payload = int(told[1]) if told else None, None
    named = one("warc-record-id"), one("warc-refers-to")
    return {
        "record_id": None if named[0] is None else _bare(named[0]), "type": kind, "concurrent_to": [_bare(u) for u in fields.get("warc-concurrent-to", [])],
        "refers_to": None if named[1] is None else _bare(named[1]), "target_uri": one("warc-target-uri"), "date": one("warc-date"), "content_type": content,
        "http_head": http, "payload_bytes": size, "payload_digest": digest, "payload": payload,
    }


class _Open:
    """A record that is being read: pieces between marks, until its own length says that it is whole."""

    def __init__(self):
        self.parts, self.size, self.need, self.head_end, self.length = [], 0, None, None, None

    def add(self, piece: bytes) -> dict | None:
        self.parts.append(piece)
        self.size += len(piece)
        if self.need is None:
            raw = b"".join(self.parts)
            self.parts = [raw]
            end = raw.find(b"\r\n\r\n")
            if end < 0:
                return None
            told = _fields(raw[:end]).get("content-length")
            if not told or not told[0].isdigit():
                raise ValueError(f"WARC record without a length: {raw[:200]!r}")
            self.head_end, self.length = end, int(told[0])
            self.need = end + 4 + self.length
        if self.size < self.need:
            return None
        raw = b"".join(self.parts)
        if raw[self.need :].strip(b"\r\n"):
            raise ValueError(f"WARC record longer than its stated length: {raw[:200]!r}")
        return _parsed(raw, self.head_end, self.length)


def _records(keep_payload: bool):
    schema = pa.schema(
        [(n, pa.string()) for n in ("record_id", "type")] + [("concurrent_to", pa.list_(pa.string()))]
        + [(n, pa.string()) for n in ("refers_to", "target_uri", "date", "content_type", "http_head")]
        + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record: _Open | None = None
        out, held = [], 0
        for batch in batches:
            for value in batch.column("value"):
                piece = value.as_py()
                if record is None:
                    if not piece.strip():
                        continue  # before a file's first mark
                    record = _Open()
                else:
                    piece = _MARK + piece
                whole = record.add(piece)
                if whole is not None:
                    if not keep_payload and whole["type"] == "response":
                        whole["payload"] = None
                    out.append(whole)
                    held += len(piece)
                    record = None
                if held > 4 << 20 or len(out) >= 4096:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, held = [], 0
        if record is not None:
            raise ValueError("WARC file ends inside a record, or a large uncompressed one was split")
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return run


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """One row per record of WARC 1.0 and 1.1 files, payload without HTTP header, digest computed from it.

    With ``keep_payload`` false the payloads of responses are left
    out. A revisit has the length and digest that its headers state. Files are read record by record as text that is split at
    the version mark; a payload that holds the mark is put together again by the record's length. gzip files, one member
    or one per record, are never split. An uncompressed file must fit in ``spark.sql.files.maxPartitionBytes``; cut or
    damaged files raise an error. An empty folder gives no rows.
    """
    lines = spark.read.option("lineSep", _MARK.decode()).text(path).select(F.col("value").cast("binary").alias("value"))
    return lines.mapInArrow(_records(keep_payload), _RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: (capture_id, response, request, requests array, metadata array).

    A response, revisit, resource or conversion is a capture, and stands under ``response`` with its type. Requests and metadata belong to the capture that their concurrent-to names, or
    that names them, or to that of a record they name. Records of a capture whose response is missing share a row without
    response, under the identifier they name. ``requests`` holds all requests, sorted by identifier, and ``request`` its
    first or null. A capture identifier that comes twice is one capture. Records without identifier are left out, as nothing can refer to them. Identifiers only
    are joined to find owners; payloads move once, to their capture.
    """
    known = records.where("record_id is not null")
    main = F.col("type").isin("response", "revisit", "resource", "conversion")
    fields = F.struct(*[c for c in records.columns if c not in ("concurrent_to",)])
    anchors = known.where(main).groupBy("record_id").agg(F.first(fields).alias("response")).withColumnRenamed("record_id", "capture_id")
    others = known.where(~main).where(F.col("type").isin("request", "metadata"))
    ids = known.where(main).select(F.col("record_id").alias("anchor")).distinct()
    named = others.select(F.col("record_id").alias("child"), F.explode("concurrent_to").alias("parent"))
    named = named.union(known.where(main).select(F.explode("concurrent_to").alias("child"), F.col("record_id").alias("parent")))
    direct = named.join(ids, named.parent == ids.anchor).select("child", "anchor")
    through = named.join(direct.withColumnRenamed("child", "middle"), F.col("parent") == F.col("middle")).select("child", "anchor")
    owners = direct.union(through).groupBy("child").agg(F.min("anchor").alias("anchor"))
    placed = others.join(owners, others.record_id == owners.child, "left")
    placed = placed.withColumn("capture_id", F.coalesce("anchor", F.get("concurrent_to", F.lit(0)), "record_id"))
    of = lambda kind: F.when(F.col("type") == kind, fields)
    rest = placed.groupBy("capture_id").agg(F.min_by(of("request"), F.when(F.col("type") == "request", F.col("record_id"))).alias("request"), *[F.array_sort(F.collect_set(of(kind))).alias(name) for kind, name in (("request", "requests"), ("metadata", "metadata"))])
    return anchors.join(rest, "capture_id", "full").select("capture_id", "response", "request", "requests", "metadata")


def page_captures(spark: SparkSession, pages: DataFrame, path: str) -> DataFrame:
    """Write ``pages`` to ``path``, read it back, and return what the assembled captures say of each page.

    Rows that repeat page_id and html are one capture and returned once.
    """
    write_archives(pages, path)
    # without payloads the records are narrow; stored, the archives are parsed once for all joins
    captures = assemble(stored(read_archives(spark, path, keep_payload=False), "records"))
    page_of = lambda text, before: F.when(F.regexp_extract(text, f"{before}(-?[0-9]+)", 1) != "", F.regexp_extract(text, f"{before}(-?[0-9]+)", 1)).cast("long")
    return captures.select(
        page_of(F.col("metadata")[0]["payload"].cast("string"), "^page-id: ").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        page_of(F.col("response.refers_to"), "^urn:capture:").alias("refers_to"),
    )
