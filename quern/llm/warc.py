"""WARC archives: writing captures, reading records, and assembling transactions.

A capture is written as a request, a response (or revisit) and a metadata record; request and metadata name the response in
``WARC-Concurrent-To``. Archives are text files whose line separator is the record separator, so Spark's own writer
makes them on any file system, committed per task; ``records_per_file`` bounds a file. A reading task holds one file as it is
stored and unpacks it record by record, in time proportional to its size. Reading follows ``Content-Length`` only, so payloads may
contain anything, and takes gzip files of one or many members. Assembly groups records by the transaction that their concurrent-to links name and gives one nested
row per capture.

Payloads of at least ``min_revisit`` bytes that are equal are stored once: the smallest page id (null ids last, of repeated rows one) is the
response, the others are revisits that refer to it. Null payloads are empty. Line breaks in a url are percent-encoded.
Records that belong to no response or revisit give a row with a null response. An unreadable rest of a file ends that file's records with
a row of type ``damaged``, whose fields name path, offset (in the unpacked file) and reason; ``assemble`` leaves it out, ``damages`` lists it.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.session import ship_package

# The record format.
VERSION = "WARC/1.1"
BREAK = "\r\n"
END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

DATE = "2000-01-01T00:00:00Z"
MIN_REVISIT = 100
RECORDS_PER_FILE = 6000
DAMAGED = "damaged"
MAGIC = b"\x1f\x8b"
PIECE = 1 << 16
BATCH_BYTES = 16 << 20


def _uuid(role: str, number: Column) -> Column:
    h = F.md5(F.concat(F.lit(f"{role}/"), number.cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(fields: dict[str, Column], block: Column) -> Column:
    """A record without its end. Fields that are null are left out."""
    lines = [F.lit(VERSION)] + [F.concat(F.lit(f"{k}: "), v) for k, v in fields.items()]
    size = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(F.concat_ws(BREAK, *lines, size), F.lit(END), block)


def plan_captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``(number, page_id, url, payload, digest, size, first, first_id)``: ``first`` numbers the response to refer to, if another."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    rows = pages.select(F.monotonically_increasing_id().alias("number"), F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        payload.alias("payload"), F.sha2(payload, 256).alias("digest"), F.octet_length(payload).cast("bigint").alias("size"))
    order = F.struct(F.col("page_id").isNull().alias("unnamed"), "page_id", "number")
    shared = rows.filter(F.col("size") >= min_revisit).groupBy("digest").agg(F.min(order).alias("f"), F.count(F.lit(1)).alias("n")).filter(
        "n > 1").select("digest", F.col("f.number").alias("first"), F.col("f.page_id").alias("first_id"))
    again = rows.join(shared, "digest", "left")
    own = F.col("first") == F.col("number")
    return again.withColumns({"first_id": F.when(~own, F.col("first_id")), "first": F.when(~own, F.col("first"))})


def write_archives(captures: DataFrame, path: str, date: str = DATE, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write ``plan_captures`` rows as archives below ``path``."""
    n = F.col("number")
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    response, day = _uuid("response", n), F.lit(date)
    common = {"WARC-Date": day, "WARC-Target-URI": url}
    digest = F.concat(F.lit("sha256:"), F.col("digest"))
    request = _record({"WARC-Type": F.lit("request"), "WARC-Record-ID": _uuid("request", n), **common, "WARC-Concurrent-To": response,
                       "Content-Type": F.lit("application/http;msgtype=request")}, F.concat(F.lit("GET "), F.coalesce(url, F.lit("")), F.lit(f" HTTP/1.1{END}")))
    full = _record({"WARC-Type": F.lit("response"), "WARC-Record-ID": response, **common, "WARC-Payload-Digest": digest,
                    "Content-Type": F.lit("application/http;msgtype=response")}, F.concat(F.lit(HTTP_HEAD), F.col("payload")))
    revisit = _record({"WARC-Type": F.lit("revisit"), "WARC-Record-ID": response, **common, "WARC-Payload-Digest": digest,
                       "WARC-Profile": F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                       "WARC-Refers-To": _uuid("response", F.col("first")), "Content-Type": F.lit("application/http;msgtype=response")}, F.lit(HTTP_HEAD))
    about = F.concat_ws(BREAK, F.concat(F.lit("page-id: "), F.col("page_id").cast("string")), F.concat(F.lit("payload-length: "), F.col("size").cast("string")))
    metadata = _record({"WARC-Type": F.lit("metadata"), "WARC-Record-ID": _uuid("metadata", n), **common, "WARC-Concurrent-To": response,
                        "Content-Type": F.lit("application/warc-fields")}, about)
    records = captures.select(F.explode(F.array(request, F.when(F.col("first").isNull(), full).otherwise(revisit), metadata)).alias("value"))
    records.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


class Damaged(ValueError):
    """What follows ``offset`` cannot be read."""

    def __init__(self, offset: int, reason: str):
        super().__init__(reason)
        self.offset, self.reason = offset, reason


def _pieces(content: bytes) -> Iterator[bytes]:
    """A file's bytes in pieces, unpacked if they are gzip members; a ``ValueError`` where that fails."""
    view, at = memoryview(content).cast("B"), 0
    if view[:2] != MAGIC:
        for at in range(0, len(view), PIECE):
            yield view[at:at + PIECE]
        return
    while view[at:at + 2] == MAGIC:
        member = zlib.decompressobj(31)
        while not member.eof:
            piece = view[at:at + PIECE]
            try:
                out = member.decompress(piece, 16 * PIECE)
            except zlib.error as e:
                raise ValueError(str(e)) from e
            if not piece and not out and not member.eof:
                raise ValueError("a gzip member is cut")
            at += len(piece) - len(member.unused_data) - len(member.unconsumed_tail)
            yield out
    if bytes(view[at:]).strip(b"\0"):
        raise ValueError("no gzip member")


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record; ``Damaged`` at a rest that is none."""
    pieces, data, at, passed, reason = _pieces(content), bytearray(), 0, 0, ""

    def more() -> bool:
        nonlocal reason
        try:
            data.extend(next(pieces))
        except StopIteration:
            return False
        except ValueError as e:
            reason = str(e)
            return False
        return True
    while True:
        while data.startswith(b"\r\n", at) or len(data) - at < 5:
            if data.startswith(b"\r\n", at):
                at += 2
            elif not more():
                if reason or data[at:].strip():
                    raise Damaged(passed + at, reason or "no record")
                return
        if not data.startswith(b"WARC/", at):
            raise Damaged(passed + at, "no record")
        seen = at
        while (stop := data.find(b"\r\n\r\n", seen)) < 0:
            seen = max(at, len(data) - 3)
            if not more():
                raise Damaged(passed + at, reason or "a header is cut")
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n")
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
        size = fields.get("content-length", "")
        if not (size.isascii() and size.isdigit()):
            raise Damaged(passed + at, "a record has no length")
        end = stop + 4 + int(size)
        while len(data) < end:
            if not more():
                raise Damaged(passed + at, reason or "a block is cut")
        yield fields, bytes(data[stop + 4:end])
        at = end
        if at > PIECE:
            del data[:at]
            passed, at = passed + at, 0


_RECORD = ("record_id string, type string, concurrent_to string, refers_to string, uri string, date string, stated_digest string, "
           "payload_digest string, payload_bytes bigint, payload binary, fields map<string,string>")


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives at ``path``. Payload is a response's body, else null; without it only its digest and size are kept."""
    def row(fields: dict[str, str], block: bytes) -> dict:
        kind, payload, more = fields.get("warc-type"), None, None
        if kind == "response":
            payload = block.partition(b"\r\n\r\n")[2]
        elif kind == "metadata":
            more = [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n")) if k]
        stated = fields.get("warc-payload-digest")
        return {
            "record_id": fields.get("warc-record-id"), "type": kind, "concurrent_to": fields.get("warc-concurrent-to"),
            "refers_to": fields.get("warc-refers-to"), "uri": fields.get("warc-target-uri"), "date": fields.get("warc-date"),
            "stated_digest": stated.partition(":")[2] if stated else None,
            "payload_digest": None if payload is None else hashlib.sha256(payload).hexdigest(),
            "payload_bytes": None if payload is None else len(payload), "payload": payload if with_payload else None, "fields": more}

    def rows(path: str, content: bytes) -> Iterator[tuple[dict, int]]:
        try:
            for fields, block in parse_records(content):
                yield row(fields, block), len(block)
        except Damaged as e:
            yield {"type": DAMAGED, "fields": [("path", path), ("offset", str(e.offset)), ("reason", e.reason)]}, 0

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                ready, held = [], 0
                for r, size in rows(path, content.as_buffer()):
                    ready.append(r)
                    held += size
                    if len(ready) == 1000 or held > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(ready, schema=kinds)
                        ready, held = [], 0
                if ready:
                    yield pa.RecordBatch.from_pylist(ready, schema=kinds)
    text = ("record_id", "type", "concurrent_to", "refers_to", "uri", "date", "stated_digest", "payload_digest")
    kinds = pa.schema([(c, pa.string()) for c in text] + [("payload_bytes", pa.int64()), ("payload", pa.binary()), ("fields", pa.map_(pa.string(), pa.string()))])
    ship_package(spark)
    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, _RECORD)


def damages(records: DataFrame) -> DataFrame:
    """``(path, offset, reason)`` of the rests of files that could not be read."""
    named = [F.col("fields")[c] for c in ("path", "offset", "reason")]
    return records.filter(F.col("type") == DAMAGED).select(named[0].alias("path"), named[1].cast("bigint").alias("offset"), named[2].alias("reason"))


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``(capture, request, response, metadata)``; metadata fields of several records are joined.

    Links may lead from request and metadata to the response, or over one record more; two records that name each other
    are one capture.
    """
    records = records.filter(F.coalesce("type", F.lit("")) != DAMAGED)
    parents = records.filter("concurrent_to IS NOT NULL").select(F.col("record_id").alias("parent"), F.col("concurrent_to").alias("grand"))
    linked = records.filter("concurrent_to IS NOT NULL").join(parents, F.col("concurrent_to") == F.col("parent"), "left")
    key = F.when(F.col("grand") == F.col("record_id"), F.least("record_id", "concurrent_to")).otherwise(F.coalesce("grand", "concurrent_to"))
    keyed = linked.select(*records.columns, key.alias("capture")).unionByName(
        records.filter("concurrent_to IS NULL").withColumn("capture", F.col("record_id")))
    whole = F.struct(*[c for c in records.columns if c not in ("concurrent_to", "fields")])
    return keyed.groupBy("capture").agg(
        F.first(F.when(F.col("type") == "request", whole), ignorenulls=True).alias("request"),
        F.first(F.when(F.col("type").isin("response", "revisit"), whole), ignorenulls=True).alias("response"),
        F.flatten(F.collect_list(F.when(F.col("type") == "metadata", F.map_entries("fields")))).alias("metadata"))


def digests(captures: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of assembled captures, page ids as text."""
    def stated(name: str) -> Column:
        return F.get(F.filter("metadata", lambda m: m["key"] == name), F.lit(0))["value"]
    flat = captures.select(
        stated("page-id").alias("page_id"), F.col("response.record_id").alias("record_id"), F.col("response.type").alias("record_type"),
        F.coalesce("response.payload_bytes", stated("payload-length").cast("bigint")).alias("payload_bytes"),
        F.coalesce("response.payload_digest", "response.stated_digest").alias("payload_digest"), F.col("response.refers_to").alias("target"))
    kept = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    targets = flat.filter("record_type = 'response'").select(F.col("record_id").alias("target"), F.col("page_id").alias("refers_to"))
    again = flat.filter("record_type = 'revisit'").join(targets, "target", "left").select(*kept, "refers_to")
    return again.unionByName(flat.filter("record_type = 'response'").select(*kept, F.lit(None).cast("string").alias("refers_to")))
