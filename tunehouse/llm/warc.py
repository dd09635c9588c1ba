"""Write captures as WARC records and assemble them again from request, response and metadata records."""

from __future__ import annotations

import gzip
import hashlib
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunehouse.llm.common import landed

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
PAGES_PER_FILE = 1_000  # bounds an archive, as one task reads an archive at once
BATCH_BYTES = 16 << 20
HEADERS = {  # columns of a read record, and their header fields
    "kind": "warc-type",
    "record_id": "warc-record-id",
    "concurrent_to": "warc-concurrent-to",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to_uri": "warc-refers-to-target-uri",
    "content_type": "content-type",
}
RECORD = ", ".join(f"{c} string" for c in HEADERS) + ", block string, payload_bytes bigint, payload_sha1 string, payload binary"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a text's UTF-8 or of a binary: 5 hex digits make 4 characters."""
    digits = F.sha1(data)
    chars = []
    for group in range(8):
        number = F.conv(F.substring(digits, 5 * group + 1, 5), 16, 10).cast("int")
        chars += [F.substring(F.lit(BASE32), F.shiftright(number, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*chars)


def _record(kind: str, record_id: Column, block: Column, *fields: tuple[str, Column]) -> Column:
    """The text of one record without its closing blank lines; fields that are NULL are left out."""
    lines = [F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\n"), F.concat(F.lit("WARC-Record-ID: "), record_id, F.lit("\r\n"))]
    for name, value in (*fields, ("WARC-Date", F.lit(DATE)), ("Content-Length", F.octet_length(block).cast("string"))):
        lines.append(F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit("")))
    return F.concat(*lines, F.lit("\r\n"), block)


def write_captures(pages: DataFrame, path: str, min_bytes: int = 0, pages_per_file: int = PAGES_PER_FILE) -> None:
    """Write a request, a response or revisit, and a metadata record for each row of ``pages`` (page_id, url, html).

    The payload is the html in UTF-8, empty for NULL. Of equal payloads of ``min_bytes`` or more, that of the
    largest page_id is written as response, the others as revisits of it; repeated rows of the largest page_id are
    all responses, as are equal payloads that all lack a page_id. A NULL page_id is the smallest. Control
    characters in a url become spaces; a NULL url leaves the field out.
    Records are written as they come, without Python: a record ends in two blank lines, which Spark's text writer
    puts between rows. Files are gzip and hold ``pages_per_file`` pages at most.
    """
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    url = F.trim(F.regexp_replace(F.col("url").cast("string"), r"[\x00-\x20\x7F]+", " "))
    slim = pages.select(F.col("page_id").cast("bigint").alias("page_id"), url.alias("url"), body.alias("body"))
    named = slim.withColumn("digest", base32_sha1(F.col("body")))
    sized = slim.select("page_id", "url", base32_sha1(F.col("body")).alias("digest"), F.octet_length("body").alias("bytes"))
    many = sized.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(
        F.count("*").alias("n"), F.max(F.struct("page_id", "url")).alias("first")
    )
    many = many.where("n > 1").select("digest", "first")
    # the identifiers of a page's records are drawn once, before its row becomes three
    drawn = named.join(many, "digest", "left").withColumn(
        "ids", F.array(*[F.format_string("<urn:uuid:%s>", F.expr("uuid()")) for _ in range(3)])
    )
    own, asked, told = (F.col("ids")[i] for i in range(3))
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.octet_length("body").cast("string"),
        F.lit("\r\n\r\n"),
    )
    target = ("WARC-Target-URI", F.col("url"))
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    http = ("Content-Type", F.lit("application/http;msgtype=response"))
    response = _record("response", own, F.concat(head, F.col("body")), target, digest, http)
    original = ("WARC-Refers-To-Target-URI", F.col("first.url")), ("WARC-Refers-To-Date", F.lit(DATE))
    revisit = _record("revisit", own, head, target, digest, http, ("WARC-Profile", F.lit(REVISIT_PROFILE)), *original)
    concurrent = ("WARC-Concurrent-To", own)
    # parse_url would fail the job on a malformed url
    host = F.coalesce(F.regexp_extract("url", r"^[A-Za-z]+://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit(""))
    get = F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit("\r\n\r\n"))
    request = _record("request", asked, get, target, concurrent, ("Content-Type", F.lit("application/http;msgtype=request")))
    note = F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit(""))
    metadata = _record("metadata", told, note, target, concurrent, ("Content-Type", F.lit("application/warc-fields")))
    records = drawn.select(F.explode(F.array(request, F.when(again, revisit).otherwise(response), metadata)).alias("value"))
    files = records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip")
    files.option("maxRecordsPerFile", 3 * pages_per_file).text(path)


def parse_records(data: bytes) -> Iterator[dict]:
    """The records of one archive, plain or gzip (one or many members), by their Content-Length.

    Payloads may hold blank lines. A cut record or a malformed header raises ValueError.
    """
    if data[:2] == b"\x1f\x8b":
        data = gzip.decompress(data)
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ValueError(f"no record header at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start = end + 4
        stop = start + int(fields["content-length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"the record at byte {at} does not end where its length says")
        block, at = data[start:stop], stop + 4
        row = {column: fields.get(name) for column, name in HEADERS.items()}
        if row["kind"] in ("response", "revisit") and (row["content_type"] or "").startswith("application/http"):
            head, _, payload = block.partition(b"\r\n\r\n")
        else:
            head, payload = block, b""
        row["block"] = head.decode("utf-8", "replace")
        if row["kind"] == "response":
            row["payload"] = payload
            row["payload_bytes"] = len(payload)
            row["payload_sha1"] = b32encode(hashlib.sha1(payload).digest()).decode("ascii")
        yield row


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Every record of the archives in a folder; ``payloads=False`` leaves the bytes out, not their length and digest."""
    schema = pa.schema(
        [(c, pa.string()) for c in [*HEADERS, "block"]] + [("payload_bytes", pa.int64()), ("payload_sha1", pa.string()), ("payload", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for content in batch.column(0):
                for row in parse_records(content.as_py()):
                    held += len(row.get("payload") or b"") + 500
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                    if held > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
            yield pa.RecordBatch.from_pylist(rows, schema)

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: capture_id, capture, request, metadata, page_id.

    Requests and metadata are joined to the response or revisit that their concurrent-to identifier names. Of
    several of one kind the one of the smallest record id is kept, and n_requests and n_metadata count them;
    records whose capture is missing make a row of their own with a NULL capture. Records without identifier are
    left out of the join.
    ``records`` should be stored, as it is read three times.
    """
    capture = records.where(F.col("kind").isin("response", "revisit")).select(
        F.col("record_id").alias("capture_id"),
        F.struct("kind", "target_uri", "date", "payload_digest", "refers_to_uri", F.col("block").alias("http_head"), "payload_bytes", "payload_sha1", "payload").alias("capture"),
    )

    def beside(kind: str, name: str, count: str) -> DataFrame:
        own = records.where((F.col("kind") == kind) & F.col("concurrent_to").isNotNull())
        row = F.struct("record_id", "target_uri", "date", "block")
        return own.groupBy(F.col("concurrent_to").alias("capture_id")).agg(F.min(row).alias(name), F.count("*").alias(count))

    joined = capture.join(beside("request", "request", "n_requests"), "capture_id", "full")
    joined = joined.join(beside("metadata", "metadata", "n_metadata"), "capture_id", "full")
    page = F.regexp_extract(F.col("metadata.block"), r"(?m)^page-id: (-?[0-9]+)", 1)
    return joined.withColumn("page_id", F.when(page != "", page).cast("bigint"))


def resolved(captures: DataFrame) -> DataFrame:
    """Per capture: page_id, payload_bytes, payload_digest, record_type, refers_to; revisits have the values of the
    response of the same digest (of several, that of the largest page_id)."""
    c = F.col("capture")
    flat = captures.where(c.isNotNull()).select(
        "page_id",
        c["kind"].alias("record_type"),
        F.coalesce(c["payload_sha1"], F.regexp_replace(c["payload_digest"], "^sha1:", "")).alias("payload_digest"),
        c["payload_bytes"].alias("own_bytes"),
    )
    flat = landed(flat, "captures")[0]
    first = flat.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("page_id").alias("first_page"), F.max("own_bytes").alias("bytes"))
    revisit = F.col("record_type") == "revisit"
    return flat.join(first, "payload_digest", "left").select(
        "page_id",
        F.coalesce("own_bytes", "bytes").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        F.when(revisit, F.col("first_page")).alias("refers_to"),
    )


#: DuckDB
CAPTURES_SQL = f"""
with p as (select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as h from pages),
b as (select *, max(page_id) over (partition by h) as first,
             array_to_string(list_transform(range(0, 32), lambda i: substr('{BASE32}', 1 +
                 (((('0x' || substr(h, (i // 4 * 5 + 1)::int, 5))::int >> (15 - i % 4 * 5)::int) & 31)), 1)), '') as payload_digest
      from p)
select page_id, payload_bytes, payload_digest,
       case when page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to
from b
"""
