"""Web archives: pages written as transactions, read back, and assembled to one row per capture.

A capture is a response or revisit record and the request and metadata records that name it as
concurrent. Of pages with equal payloads of at least `revisit_bytes` bytes, the one with the
largest id is stored whole, and the others revisit it. Archives are written by Spark's text
writer, whose line separator is the separator of records; each file holds a bounded number of
records, so that a reader holds one file. Records are joined by one grouping over the identifier they
share, which keeps the least record of each kind and counts all of them.

Cases: a null payload is empty; a null URL leaves the target out, and line breaks in one are
percent-encoded. Pages equal in id, URL and payload share their record ids: they are one capture
with `copies` above 1. Of pages that share the largest id all are responses. A null id is kept as
a null page id. Records that name no stored record form a capture without a response. An empty
table gives an empty archive and an empty result; other columns are ignored. A payload of any
length is written whole.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

END = "\r\n"
VERSION = "WARC/1.1"
# fixed value: the profile name of a revisit with the same payload
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_PER_FILE = 10_000
RECORD = (
    "record_id string, record_type string, target_uri string, concurrent_to string,"
    " refers_to string, payload binary, payload_bytes long, payload_digest string"
)


def _record(headers: list[Column | None], block: Column) -> Column:
    """Version, the headers that are not null, and the block; the writer adds the separator."""
    lines = F.concat_ws(END, F.lit(VERSION), *[h for h in headers if h is not None])
    size = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(lines, F.lit(END), size, F.lit(END * 2), block)


def _header(name: str, value: Column) -> Column:
    """Null, so left out, where the value is."""
    return F.concat(F.lit(f"{name}: "), value)


def _record_id(kind: str, page_id: Column, url: Column, key: Column) -> Column:
    name = F.sha2(F.concat_ws("\n", F.lit(kind), page_id.cast("string"), F.coalesce(url, F.lit("")), key), 256)
    parts = [F.substring(name, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    revisit_bytes: int = 1000,
    date: str = "2024-01-01T00:00:00Z",
) -> None:
    """A request, a response or revisit, and a metadata record for each page."""
    payload = F.coalesce(F.col(payload_column), F.lit(""))
    url = F.replace(F.replace(F.col(url_column), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    rows = pages.select(
        F.col(id_column).alias("page_id"),
        url.alias("url"),
        payload.alias("payload"),
        F.sha2(payload.cast("binary"), 256).alias("key"),
    )
    shared = (
        rows.filter(F.octet_length("payload") >= revisit_bytes)
        .groupBy("key")
        .agg(F.max(F.struct("page_id", "url")).alias("kept"), F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .select("key", "kept")
    )
    page_id, url, payload, key = (F.col(c) for c in ("page_id", "url", "payload", "key"))
    kept = F.col("kept")
    main_id = _record_id("main", page_id, url, key)
    revisit = kept["page_id"].isNotNull() & ~kept["page_id"].eqNullSafe(page_id)
    when, target = F.lit(f"WARC-Date: {date}"), _header("WARC-Target-URI", url)
    http = F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}{END}")
    digest = _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1(payload.cast("binary"))))
    http_type = F.lit("Content-Type: application/http; msgtype=response")
    response = _record(
        [F.lit("WARC-Type: response"), _header("WARC-Record-ID", main_id), when, target, digest, http_type],
        F.concat(http, payload),
    )
    repeat = _record(
        [
            F.lit("WARC-Type: revisit"), _header("WARC-Record-ID", main_id), when, target, digest,
            F.lit(f"WARC-Profile: {SAME_PAYLOAD}"),
            _header("WARC-Refers-To", _record_id("main", kept["page_id"], kept["url"], key)),
            _header("WARC-Refers-To-Target-URI", kept["url"]),
            http_type,
        ],
        http,
    )
    path = F.coalesce(F.regexp_extract(url, r"(?s)://[^/?#]*([^#]*)", 1), F.lit(""))
    host = F.coalesce(F.regexp_extract(url, r"(?s)://([^/?#]*)", 1), F.lit(""))
    concurrent = _header("WARC-Concurrent-To", main_id)
    request = _record(
        [
            F.lit("WARC-Type: request"), _header("WARC-Record-ID", _record_id("request", page_id, url, key)),
            when, target, concurrent, F.lit("Content-Type: application/http; msgtype=request"),
        ],
        F.concat(
            F.lit("GET "), F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)),
            F.lit(f" HTTP/1.1{END}Host: "), host, F.lit(END * 2),
        ),
    )
    metadata = _record(
        [
            F.lit("WARC-Type: metadata"), _header("WARC-Record-ID", _record_id("metadata", page_id, url, key)),
            when, target, concurrent, F.lit("Content-Type: application/warc-fields"),
        ],
        F.concat(F.lit("page_id: "), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(END)),
    )
    records = rows.join(shared, "key", "left").select(
        F.explode(F.array(request, F.when(revisit, repeat).otherwise(response), metadata)).alias("value")
    )
    (
        records.write.mode("errorifexists")
        .option("lineSep", END * 2)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(folder)
    )


def parse_records(stream: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, by lower-case name, and block of each record of one archive."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts here: {line[:80]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("the last record is cut off")
        yield headers, block


def _row(headers: dict[str, str], block: bytes) -> tuple:
    kind = headers.get("warc-type")
    payload = block.partition(b"\r\n\r\n")[2] if kind in ("response", "revisit") else block
    return (
        headers.get("warc-record-id"),
        kind,
        headers.get("warc-target-uri"),
        headers.get("warc-concurrent-to"),
        headers.get("warc-refers-to"),
        payload,
        len(payload),
        hashlib.sha1(payload).hexdigest(),
    )


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record, as RECORD: of responses the payload without HTTP headers."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in RECORD.split(",")]
        for batch in batches:
            for content in batch["content"]:
                stream = io.BytesIO(content)
                if content[:2] == b"\x1f\x8b":
                    stream = io.BufferedReader(gzip.GzipFile(fileobj=stream))
                rows, size = [], 0
                for headers, block in parse_records(stream):
                    rows.append(_row(headers, block))
                    size += len(block)
                    if size > 4 << 20:
                        yield pd.DataFrame(rows, columns=names)
                        rows, size = [], 0
                yield pd.DataFrame(rows, columns=names)

    files = spark.read.format("binaryFile").load(folder).select("content")
    return files.mapInPandas(read, RECORD)


def assemble(records: DataFrame, *, with_payload: bool = True) -> DataFrame:
    """One nested row per capture.

    Columns capture_id; response (the response or revisit record), request and metadata, each a
    struct or null; copies, n_requests and n_metadata, the numbers of records. Where a capture has
    several different records of a kind, the one with the least record id is shown.
    """
    main = F.col("record_type").isin("response", "revisit")
    fields = ["record_id", "record_type", "target_uri", "refers_to", "payload_bytes", "payload_digest"]
    shown = F.struct(*fields, *(["payload"] if with_payload else []))
    small = F.struct("record_id", "target_uri", F.col("payload").cast("string").alias("block"))
    request, metadata = F.col("record_type") == "request", F.col("record_type") == "metadata"
    return (
        records.withColumn(
            "capture_id", F.when(main, F.col("record_id")).otherwise(F.coalesce("concurrent_to", "record_id"))
        )
        .groupBy("capture_id")
        .agg(
            F.min(F.when(main, shown)).alias("response"),
            F.min(F.when(request, small)).alias("request"),
            F.min(F.when(metadata, small)).alias("metadata"),
            F.count_if(main).alias("copies"),
            F.count_if(request).alias("n_requests"),
            F.count_if(metadata).alias("n_metadata"),
        )
    )


def field(block: Column, name: str) -> Column:
    """Value of a field of a metadata block; null if it is absent or empty."""
    found = F.regexp_extract(block, rf"(?m)^{name}: *([^\r\n ][^\r\n]*)", 1)
    return F.nullif(found, F.lit(""))
