"""WARC: writing captures, reading archives, and transaction assembly.

Each page becomes a request, a response or revisit, and a metadata record. They are written as text with the record
separator of WARC as line separator, gzip-compressed by Spark's writer. An archive holds ARCHIVE_BYTES of payloads at most, or
one capture: pages are written by classes of their payload's length, each with its own number of records in a file (equal
payloads are equally long, so a revisit and its response are of one class). Reading takes whole files through the binaryFile
source (any store that Spark reads) and parses them by Content-Length. Assembly joins the records through WARC-Concurrent-To,
resolves revisits through WARC-Refers-To, and emits one nested row for each capture.

Of pages with the same payload digest the one with the smallest page_id (nulls last, then the first row) is the response;
its record id derives from the digest, so revisits can name it without a further join. A digest that very many pages
share stands in one aggregated row, and the join back splits its pages over tasks.

A null html is an empty payload; a null url is an empty target; a null page_id stays null. Repeated rows are captures of
their own. Payloads below `revisit_from` bytes are always responses. An empty table gives archives without records. A very long payload is
held whole by the task that writes or reads it, alone. Extra columns of pages are not read, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import hot_join, removed, scratch, stored, table

#: Bytes of the payloads of an archive file at most (a longer payload has a file to itself), the lengths at which classes of pages end,
#: and bytes of an archive that are inflated at once.
ARCHIVE_BYTES, CLASSES, PIECE = 1 << 27, (1 << 16, 1 << 21), 1 << 20
VERSION, END = "WARC/1.1", "\r\n\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_LAST = (1 << 63) - 1


def base32(digits: Column) -> Column:
    """Upper-case base32 of 40 hexadecimal digits: 5 of them make 4 characters."""

    def letter(i: Column) -> Column:
        five = F.conv(F.substr(digits, (5 * F.floor(i / 4) + 1).cast("int"), F.lit(5)), 16, 10).cast("int")
        value = F.call_function("shiftright", five, (15 - 5 * (i % 4)).cast("int")).bitwiseAND(F.lit(31))
        return F.substr(F.lit(_BASE32), value + 1, F.lit(1))

    return F.concat_ws("", F.transform(F.sequence(F.lit(0), F.lit(31)), letter))


def _uuid(text: Column) -> Column:
    h = F.md5(text)
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _record(kind: Column, fields: list[tuple[str, Column]], block: Column) -> Column:
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in fields]  # a null value leaves its line out
    return F.concat(F.concat_ws("\r\n", F.lit(VERSION), F.concat(F.lit("WARC-Type: "), kind), *lines, F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))), F.lit(END), block)


def _steady(pages: DataFrame) -> DataFrame:
    """The columns of captures. They number rows in two branches of the plan, so pages that don't come straight from a scan are
    stored first: a task that runs again numbers them alike."""
    pages = pages.select("page_id", "url", "html")
    return stored(pages) if "Exchange" in pages._jdf.queryExecution().executedPlan().toString() else pages


def captures(pages: DataFrame, date: str, revisit_from: int = 0) -> DataFrame:
    """page_id, url, payload, digest (hexadecimal), date, kind, capture (record id), original (record id; null for responses)."""
    pages = _steady(pages)
    url = F.regexp_replace(F.coalesce(F.col("url").cast("string"), F.lit("")), "[\r\n]", " ")
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"), url.alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"), F.monotonically_increasing_id().alias("row")
    ).withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    order = F.struct(F.coalesce("page_id", F.lit(_LAST)).alias("id"), "row")
    firsts = base.where(F.octet_length("payload") >= revisit_from).groupBy("digest").agg(F.min(order).alias("first"))
    joined = hot_join(base, firsts, "digest", "left")
    is_first = F.col("first").isNull() | ((F.coalesce("page_id", F.lit(_LAST)) == F.col("first.id")) & (F.col("row") == F.col("first.row")))
    named = F.when(F.col("first").isNull(), _uuid(F.concat(F.lit("response:"), F.col("digest"), F.lit(":"), F.col("row").cast("string")))).otherwise(_uuid(F.concat(F.lit("response:"), F.col("digest"))))
    return joined.select(
        "page_id", "url", "payload", "digest", F.lit(date).alias("date"),
        F.when(is_first, "response").otherwise("revisit").alias("kind"),
        F.when(is_first, named).otherwise(_uuid(F.concat(F.lit("revisit:"), F.col("digest"), F.lit(":"), F.col("row").cast("string")))).alias("capture"),
        F.when(~is_first, named).alias("original"),
    )


def write_warc(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", revisit_from: int = 0) -> None:
    """Three records for each row of (page_id, url, html), in a folder for each class of lengths; revisits have HTTP headers but no payload."""
    pages = _steady(pages)
    length = F.octet_length(F.coalesce(F.col("html").cast("string"), F.lit("")))
    for i, (low, high) in enumerate(zip((0, *CLASSES), (*CLASSES, None), strict=True)):
        own = pages.where(length >= low if high is None else (length >= low) & (length < high))
        _write_class(own, f"{path}/class{i}", 3 * max(1, ARCHIVE_BYTES // high) if high else 3, date, revisit_from)


def _write_class(pages: DataFrame, path: str, most: int, date: str, revisit_from: int) -> None:
    """Archives of at most `most` records."""
    c = captures(pages, date, revisit_from)
    at, to = ("WARC-Date", F.col("date")), ("WARC-Target-URI", F.col("url"))
    path_part = F.coalesce(F.nullif(F.regexp_extract("url", r"^[a-zA-Z]+://[^/?#]*([^#]*)", 1), F.lit("")), F.lit("/"))
    ask = F.concat(F.lit("GET "), path_part, F.lit(f" HTTP/1.1\r\nHost: "), F.regexp_extract("url", r"^[a-zA-Z]+://([^/?#]*)", 1), F.lit(END))
    size = F.octet_length("payload").cast("string")
    answer = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit(END), F.when(F.col("kind") == "response", F.col("payload")).otherwise(""))
    about = F.concat_ws("\r\n", F.concat(F.lit("page-id: "), F.col("page_id").cast("string")), F.lit("via: pages"))
    own = lambda kind: _uuid(F.concat(F.lit(f"{kind}:"), F.col("capture")))
    records = F.array(
        _record(F.col("kind"), [
            ("WARC-Record-ID", F.col("capture")), at, to, ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("digest")))),
            ("WARC-Profile", F.when(F.col("kind") == "revisit", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            ("WARC-Refers-To", F.col("original")), ("Content-Type", F.lit("application/http; msgtype=response")),
        ], answer),
        _record(F.lit("request"), [("WARC-Record-ID", own("request")), ("WARC-Concurrent-To", F.col("capture")), at, to, ("Content-Type", F.lit("application/http; msgtype=request"))], ask),
        _record(F.lit("metadata"), [("WARC-Record-ID", own("metadata")), ("WARC-Concurrent-To", F.col("capture")), at, to, ("Content-Type", F.lit("application/warc-fields"))], about),
    )
    c.select(F.explode(records).alias("value")).write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", most).text(path)


def _inflated(content: bytes) -> Iterator[bytes]:
    """Plain bytes of an archive, PIECE or so at a time: gzip with one or many members, or as it is."""
    if content[:2] != b"\x1f\x8b":
        yield from (content[i : i + PIECE] for i in range(0, len(content), PIECE))
        return
    at, view = 0, memoryview(content)
    while bytes(view[at : at + 2]) == b"\x1f\x8b":
        d = zlib.decompressobj(31)
        while not d.eof and at < len(content):
            yield d.decompress(view[at : at + PIECE])
            at += PIECE
        at = min(at, len(content)) - len(d.unused_data)


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in head.split(b"\r\n"))
    return {k.strip().lower().decode("utf-8", "replace"): v.strip().decode("utf-8", "replace") for k, colon, v in pairs if colon}


def records_in(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields, block) of every record of an archive file; no more than one record and a piece of the archive is held."""
    pieces, data = _inflated(content), b""
    for more in pieces:
        data += more
        at = 0
        while (start := data.find(b"WARC/", at)) >= 0 and (head := data.find(b"\r\n\r\n", start)) >= 0:
            fields = _fields(data[start:head])
            end = head + 4 + int(fields.get("content-length") or 0)
            if len(data) < end:  # the block goes on in the next pieces
                rest = [data]
                have = len(data)
                while have < end and (piece := next(pieces, None)) is not None:
                    rest.append(piece)
                    have += len(piece)
                data = b"".join(rest)
            yield fields, data[head + 4 : end]
            at = end
        data = data[max(at, 0) :]


_SCHEMA = (
    "record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, date string, payload_digest string,"
    " content_type string, block_bytes long, payload_bytes long, payload_sha1 string, fields map<string,string>, payload binary"
)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row for each record of the archives below `path`; without `payload` its bytes stay in the reading task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, {"long": pa.int64(), "binary": pa.binary()}.get(t, pa.string())) if t[:3] != "map" else (n, pa.map_(pa.string(), pa.string())) for n, t in (x.rsplit(" ", 1) for x in _SCHEMA.split(", "))])
        for batch in batches:
            rows, held = [], 0
            for content in batch.column(0):
                for f, block in records_in(content.as_py()):
                    http = f.get("content-type", "").startswith("application/http")
                    body = block.partition(b"\r\n\r\n")[2] if http else block
                    own = {k: v for k, v in _fields(block).items()} if f.get("content-type") == "application/warc-fields" else {}
                    digest = f.get("warc-payload-digest", "")
                    rows.append((
                        f.get("warc-record-id"), f.get("warc-type"), f.get("warc-concurrent-to"), f.get("warc-refers-to"), f.get("warc-target-uri"), f.get("warc-date"),
                        digest.removeprefix("sha1:") or None, f.get("content-type"), len(block), len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), list(own.items()), body if payload else None,
                    ))
                    held += len(body) if payload else 0
                    if len(rows) >= 5000 or held > 1 << 24:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content").mapInArrow(run, _SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row for each capture: capture_id, response, request, metadata, original.

    A capture is a response or a revisit. Its request and metadata are the records concurrent to it (null if there is none,
    the smallest record id if there are several). `original` is the response that a revisit refers to.
    """
    kept = [c for c in records.columns if c != "concurrent_to"]
    found = records.where("record_type in ('response', 'revisit')").select(F.col("record_id").alias("capture_id"), "refers_to", F.struct(*kept).alias("response"))
    for kind in ("request", "metadata"):
        own = records.where((F.col("record_type") == kind) & F.col("concurrent_to").isNotNull()).groupBy(F.col("concurrent_to").alias("capture_id")).agg(F.min_by(F.struct(*kept), "record_id").alias(kind))
        found = found.join(own, "capture_id", "left")
    named = found.where("response.record_type = 'response'").select(F.col("capture_id").alias("refers_to"), F.col("response").alias("original"), F.col("metadata.fields").alias("original_fields"))
    # very many revisits may refer to one response
    return hot_join(found, named, "refers_to", "left").select("capture_id", "response", "request", "metadata", "original", "original_fields")


def op1_warc_transactions(spark, sf_dir: str) -> DataFrame:
    """Writes all pages, reads the archives back, and returns page_id, payload_bytes, payload_digest, record_type, refers_to."""
    path = scratch(spark)
    write_warc(table(spark, sf_dir, "pages"), path)
    records = stored(read_warc(spark, path, payload=False))  # parsed once, and joined from there
    removed(spark, path)
    full = assemble(records)
    page = lambda fields: F.try_element_at(F.col(fields), F.lit("page-id")).cast("long")
    source = F.coalesce("original", "response")
    return full.select(
        page("metadata.fields").alias("page_id"),
        source["payload_bytes"].alias("payload_bytes"),
        source["payload_sha1"].alias("payload_digest"),
        F.col("response.record_type").alias("record_type"),
        F.when(F.col("response.record_type") == "revisit", page("original_fields")).alias("refers_to"),
        (F.col("request").isNotNull() & (source["payload_sha1"] == F.col("response.payload_digest"))).alias("complete"),
    )


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS x, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT page_id, octet_length(x) AS payload_bytes, array_to_string(list_transform(range(0, 32),
  lambda i: substr('{_BASE32}', ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)), '') AS payload_digest FROM p),
r AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM q)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, true AS complete FROM r
"""
