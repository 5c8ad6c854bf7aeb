"""Web archives: capture records written as WARC files, read back and assembled.

A capture is a transaction of three records: a request, a response (or a revisit,
where the payload is stored elsewhere) and a metadata record. Request and metadata
name the response in ``WARC-Concurrent-To``. Reading turns every record into a row;
``assemble`` joins the records of a transaction through these identifiers and gives
one nested row per capture.

Files are written by Spark's text sink, whose line separator is the blank lines after a
record, and compressed as a whole; so the commit protocol covers lost executors on any
store, and each file is read by one task from its beginning. Records are framed by their
``Content-Length``: a payload that looks like records is still one payload.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpath.llm import common
from clickpath.sources.tables import broadcast_if_small

VERSION = "WARC/1.1"

# What every record of any version 1 begins with, and what ends one.
MARK = "WARC/1."
END = "\r\n\r\n"

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

# Payloads of fewer bytes are always written out.
REVISIT_BYTES = 0

# Largest table of repeated payloads that is broadcast, in bytes of its stored files.
BROADCAST_BYTES = 16 << 20

# The digits of base 32 as Spark counts them and as RFC 4648 writes them.
COUNTED = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
WRITTEN = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(data: Column) -> Column:
    """The SHA-1 of a text or of bytes in base 32: 40 bits are 10 hexadecimal digits or 8 of base 32."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, k, 10), 16, 32), 8, "0") for k in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), COUNTED, WRITTEN)


def _record(kind: str, record_id: str, date: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{record_id}>", f"WARC-Date: {date}",
             *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + END.encode() + block


def _records(run: str, date: str):
    """The records of each page; identifiers come from the run, the partition and the record's place in it."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0

        def new_id() -> str:
            nonlocal n
            n += 1
            return str(uuid.UUID(bytes=hashlib.md5(f"{run}/{part}/{n}".encode()).digest()))

        for batch in batches:
            out = []
            if not n:
                out.append(_record("warcinfo", new_id(), date, [("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
            for page_id, url, html, digest, revisit, original_url in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "revisit", "original_url"))):
                uri = [] if url is None else [("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~"))]
                place = urlsplit(uri[0][1] if uri and "[" not in uri[0][1] and "]" not in uri[0][1] else "")
                capture, request, metadata = new_id(), new_id(), new_id()
                together = [("WARC-Concurrent-To", f"<urn:uuid:{capture}>")]
                asked = f"GET {place.path or '/'}{'?' + place.query if place.query else ''} HTTP/1.1\r\nHost: {place.netloc}{END}"
                out.append(_record("request", request, date, [*uri, *together, ("Content-Type", "application/http;msgtype=request")], asked.encode()))
                answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(html)}{END}".encode()
                facts = [*uri, ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
                if revisit:
                    to = [] if original_url is None else [("WARC-Refers-To-Target-URI", quote(original_url, safe="!#$%&'()*+,/:;=?@[]~"))]
                    out.append(_record("revisit", capture, date, [*facts, ("WARC-Profile", REVISIT_PROFILE), *to], answer))
                else:
                    out.append(_record("response", capture, date, facts, answer + html))
                told = "" if page_id is None else f"page-id: {page_id}\r\n"
                out.append(_record("metadata", metadata, date, [*uri, *together, ("Content-Type", "application/warc-fields")], told.encode()))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
    return make


def write(pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES, date: str | None = None) -> None:
    """Write a request, a response or revisit, and a metadata record for each row of ``pages`` (page_id, url, html).

    Of rows with equal payloads of ``revisit_bytes`` or more, the one with the largest
    page_id is a response, the others are revisits of it; rows that share that id are all
    responses, as are all of a payload that has no id. A null html is an empty payload, a
    null url or page_id is left out of the records. Other columns are ignored. An empty
    table gives no archive, which reads as no records.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", sha1_base32(F.col("html")))
    # Only payloads that occur again; counted per task first, so a payload of most rows is no hot group.
    again = rows.filter(F.octet_length("html") >= revisit_bytes).groupBy("digest").agg(
        F.max(F.struct("page_id", "url")).alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = common.materialise(again.select("digest", F.col("last.page_id").alias("original"), F.col("last.url").alias("original_url")), "warc-repeated")
    marked = rows.join(broadcast_if_small(again, BROADCAST_BYTES), "digest", "left")
    marked = marked.withColumn("revisit", F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original")))
    made = marked.select("page_id", "url", F.col("html").cast("binary").alias("html"), "digest", "revisit", "original_url").mapInArrow(
        _records(uuid.uuid4().hex, date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")), "value binary")
    made.select(F.col("value").cast("string").alias("value")).write.option("lineSep", END).option("compression", "gzip").text(path)


RECORD_SCHEMA = ("record_id string, type string, date string, target_uri string, concurrent_to array<string>, refers_to string, "
                 "header_digest string, content_type string, fields map<string,string>, whole boolean, "
                 "payload_bytes long, payload_digest string, payload binary")


def _identifier(value: str) -> str:
    return value.strip().removeprefix("<").removesuffix(">").removeprefix("urn:uuid:")


def _named(lines: str) -> list[tuple[str, str]]:
    """(lower-case name, value) of each line "name: value"."""
    pairs = (line.partition(":") for line in lines.split("\r\n") if ":" in line)
    return [(k.strip().lower(), v.strip()) for k, _, v in pairs]


def _parsed(head: bytes, block: bytes, whole: bool, with_payload: bool) -> tuple:
    """A record as a row of RECORD_SCHEMA."""
    headers = _named(head.decode("utf-8", "replace"))
    one = dict(reversed(headers))  # of repeated headers the first counts
    kind = one.get("content-type", "").lower()
    payload = block.partition(END.encode())[2] if kind.startswith("application/http") else block
    fields = _named(block.decode("utf-8", "replace")) if kind.startswith("application/warc-fields") else []
    return (_identifier(one["warc-record-id"]) if "warc-record-id" in one else None, one.get("warc-type"), one.get("warc-date"), one.get("warc-target-uri"),
            [_identifier(v) for k, v in headers if k == "warc-concurrent-to"], _identifier(one["warc-refers-to"]) if "warc-refers-to" in one else None,
            one.get("warc-payload-digest", "").removeprefix("sha1:") or None, one.get("content-type"), list(dict(reversed(fields)).items()), whole,
            len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), payload if with_payload else None)


class _Framed:
    """Puts the pieces between MARKs together again to records of their Content-Length."""

    def __init__(self, with_payload: bool) -> None:
        self.with_payload = with_payload
        self._drop()

    def _drop(self) -> None:
        self.pieces: list[bytes] = []   # of the open record
        self.size = 0                   # with the marks between them
        self.head = self.need = None    # the header, and the size of a whole record

    def add(self, piece: bytes) -> list[tuple]:
        """The records that end with this piece."""
        if not self.pieces and piece[1:3] != b"\r\n":
            return []  # what stands before the first record of a file
        self.size += len(piece) + (len(MARK) if self.pieces else 0)
        self.pieces.append(piece)
        if self.need is None:
            begun = self._joined()
            at = begun.find(END.encode())
            if at < 0:
                return []
            self.head = begun[:at]
            length = dict(reversed(_named(self.head.decode("utf-8", "replace")))).get("content-length", "")
            self.need = at + len(END) + (int(length) if length.isdecimal() else 0)
        if self.size < self.need:
            return []
        block = self._joined()[len(self.head) + len(END):self.need]
        row = _parsed(self.head, block, True, self.with_payload)
        self._drop()
        return [row]

    def _joined(self) -> bytes:
        return MARK.encode().join(self.pieces)

    def end(self) -> list[tuple]:
        """At the end of a file: a record cut short, and those that its length seemed to cover."""
        rows = []
        while self.pieces:
            rest = self.pieces[1:]
            if self.head is not None:
                rows.append(_parsed(self.head, self._joined()[len(self.head) + len(END):] if not rest else b"", False, self.with_payload))
            self._drop()
            for piece in rest:
                rows += self.add(piece)
        return rows


def _rows(with_payload: bool):
    kinds = [pa.string()] * 4 + [pa.list_(pa.string())] + [pa.string()] * 3 + [pa.map_(pa.string(), pa.string()), pa.bool_(), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in RECORD_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], names=names)

        framed, file = _Framed(with_payload), None
        for batch in batches:
            rows = []
            for name, piece in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist()):
                if name != file:
                    rows += framed.end()
                    file = name
                rows += framed.add(piece)
            if rows:
                yield made(rows)
        if rows := framed.end():
            yield made(rows)
    return run


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """The records of the compressed archives at ``path``, as rows of RECORD_SCHEMA.

    ``fields`` are the lines of a warc-fields block, ``payload_digest`` is taken from the
    payload as read and ``header_digest`` from the header. A record that its file cuts short
    has ``whole`` false; what stands between records is passed over. Without
    ``with_payload`` the payload itself is null.
    """
    common.configure(spark)
    pieces = spark.read.option("lineSep", MARK).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))
    return pieces.mapInArrow(_rows(with_payload), RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit with its request and metadata record.

    Records are joined through concurrent-to identifiers in either direction, or by way of
    one other request or metadata record of the transaction. Of several requests (or
    metadata records) the first by date, then identifier, is nested; n_requests and
    n_metadata count them all, so a capture that very many records name stays one bounded
    row. Records that belong to no capture are left out, records without an identifier
    link to nothing, and repeated rows of one record count once. ``records`` is read several times, so it
    should be stored. An empty table gives no rows; other columns pass through.
    """
    capture = F.col("type").isin("response", "revisit")
    captures = records.filter(capture)
    others = records.filter(F.col("type").isin("request", "metadata") & F.col("record_id").isNotNull())
    named = records.filter(capture | F.col("type").isin("request", "metadata")).select("record_id", F.explode("concurrent_to").alias("to"))
    links = named.select(F.col("record_id").alias("member"), "to").union(named.select(F.col("to").alias("member"), F.col("record_id").alias("to")))
    links = common.materialise(links.filter("member IS NOT NULL AND to IS NOT NULL AND member != to").distinct(), "warc-links")
    ids = captures.select(F.col("record_id").alias("to"), F.col("record_id").alias("capture")).distinct()
    direct = common.materialise(links.join(ids, "to").select("member", "capture").distinct(), "warc-direct")
    onward = links.join(direct.select(F.col("member").alias("to"), "capture"), "to").join(direct.select("member"), "member", "left_anti")
    attached = direct.union(onward.select("member", "capture").distinct())
    nested = F.struct("date", "record_id", "target_uri", "content_type", "fields", "payload_bytes", "payload_digest", "payload")
    key = F.struct("date", "record_id")
    is_request = F.col("type") == "request"
    around = others.join(attached.select(F.col("member").alias("record_id"), "capture"), "record_id").groupBy("capture").agg(
        F.min_by(F.when(is_request, nested), F.when(is_request, key)).alias("request"),
        F.min_by(F.when(~is_request, nested), F.when(~is_request, key)).alias("metadata"),
        F.count_if(is_request).alias("n_requests"), F.count_if(~is_request).alias("n_metadata"))
    whole = captures.join(around, F.col("record_id") == F.col("capture"), "left").drop("capture", "concurrent_to")
    return whole.withColumns({n: F.coalesce(n, F.lit(0)) for n in ("n_requests", "n_metadata")})


def captures(records: DataFrame) -> DataFrame:
    """One row per capture as (page_id, payload_bytes, payload_digest, record_type, refers_to).

    Sizes and digests are those of the full payload; a revisit's come from the response of
    the same payload digest, as the profile says, and so does ``refers_to``, that
    response's page_id.
    """
    rows = common.materialise(assemble(records).select(
        F.col("metadata.fields").getItem("page-id").cast("long").alias("page_id"), "type", "payload_bytes", "payload_digest", "header_digest"), "warc-captures")
    originals = rows.filter("type = 'response'").groupBy(F.col("payload_digest").alias("header_digest")).agg(
        F.max("page_id").alias("original"), F.max("payload_bytes").alias("original_bytes"))
    wanted = originals.join(rows.filter("type = 'revisit'").select("header_digest").distinct(), "header_digest", "left_semi")
    wanted = common.materialise(wanted, "warc-originals")
    revisit = F.col("type") == "revisit"
    found = rows.join(broadcast_if_small(wanted, BROADCAST_BYTES), "header_digest", "left")
    return found.select("page_id", F.when(revisit, F.col("original_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
                        F.when(revisit, F.col("header_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"),
                        F.col("type").alias("record_type"), F.when(revisit, F.col("original")).alias("refers_to"))


def oracle_sql() -> str:
    """DuckDB SQL of the query: the same report from the pages themselves."""
    digits = "||".join(f"substr('{WRITTEN}', 1 + ((part >> {5 * k}) & 31)::INT, 1)" for k in range(7, -1, -1))
    parts = "||".join("(" + digits.replace("part", f"('0x' || substr(digest, {k}, 10))::BIGINT") + ")" for k in (1, 11, 21, 31))
    return f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
     g AS (SELECT digest, max(page_id) AS last, count(*) AS copies FROM p WHERE n >= {REVISIT_BYTES} GROUP BY digest HAVING count(*) > 1),
     m AS (SELECT p.*, last, last IS NOT NULL AND page_id IS DISTINCT FROM last AS again FROM p LEFT JOIN g USING (digest))
SELECT page_id, n AS payload_bytes, {parts} AS payload_digest,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN last END AS refers_to
FROM m"""
