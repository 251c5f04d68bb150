import hashlib
import io

import pytest
from pyspark.sql import functions as F

from txscore.llm import queries, warc

LONG = "ü" * 500  # 1000 bytes
PAGES = [
    (1, "http://a.net/x?q=1#f", LONG),
    (2, "http://a.net/y", LONG),
    (3, None, LONG),
    (4, "http://b.net", "z" * 999),
    (5, "http://b.net/\r\nWARC-Type: request", "z" * 999),
    (6, "no scheme", None),
    (7, "http://c.net/", "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" * 60),
    (8, "http://c.net/", "x" * 300_000),
    (8, "http://c.net/", "x" * 300_000),
    (None, "http://d.net/", LONG + "!"),
]


def text(page_id):
    return None if page_id is None else str(page_id)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*p, "a", "b") for p in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, key string, payload string")


def test_archives_are_read_back(spark, pages, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_PER_FILE", 4)
    warc.write_archives(pages, f"{tmp_path}/a")
    records = warc.read_archives(spark, f"{tmp_path}/a")
    assert records.count() == 3 * len(PAGES)
    got = warc.assemble(records).select("*", warc.field(F.col("metadata.block"), "page_id").alias("page")).collect()
    assert len(got) == len(PAGES) - 1  # both rows of page 8 are one capture
    by_page = {r.page: r for r in got}
    for page_id, url, html in PAGES:
        r = by_page[text(page_id)]
        assert r.copies == r.n_requests == r.n_metadata == (2 if page_id == 8 else 1)
        assert r.response.target_uri == (None if url is None else url.replace("\r\n", "%0D%0A"))
        if page_id in (1, 2):
            assert r.response.record_type == "revisit" and r.response.payload == b""
            assert r.response.refers_to == by_page["3"].response.record_id
        else:
            payload = (html or "").encode()
            assert r.response.record_type == "response" and r.response.payload == payload
            assert r.response.payload_digest == hashlib.sha1(payload).hexdigest()
    assert by_page["1"].request.block == "GET /x?q=1 HTTP/1.1\r\nHost: a.net\r\n\r\n"


def test_query_gives_a_row_per_page(spark, tmp_path, pages):
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(map(tuple, queries.op9_warc_captures(spark, str(tmp_path)).collect()), key=repr)
    wanted = []
    for page_id, _, html in PAGES:
        payload = (html or "").encode()
        revisit = page_id in (1, 2)
        wanted.append((page_id, len(payload), hashlib.sha1(payload).hexdigest(),
                       "revisit" if revisit else "response", 3 if revisit else None))
    assert got == sorted(wanted, key=repr)


def test_records_without_their_capture(spark):
    rows = [
        ("<m>", "metadata", "<gone>"), ("<q>", "request", "<r>"), ("<r>", "response", None),
        ("<x>", "request", "<r>"), ("<i>", "warcinfo", None),
    ]
    records = spark.createDataFrame(
        [(a, k, "u", c, None, b"x", 1, "d") for a, k, c in rows], warc.RECORD
    )
    got = {r.capture_id: r for r in warc.assemble(records).collect()}
    assert set(got) == {"<gone>", "<r>", "<i>"}
    assert got["<gone>"].response is None and got["<gone>"].metadata.record_id == "<m>"
    assert (got["<r>"].request.record_id, got["<r>"].n_requests) == ("<q>", 2)


def test_broken_archives_are_refused():
    with pytest.raises(ValueError, match="no record"):
        list(warc.parse_records(io.BytesIO(b"plain text\n")))
    with pytest.raises(ValueError, match="cut off"):
        list(warc.parse_records(io.BytesIO(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc")))


def test_empty_table(spark, tmp_path, pages):
    pages.limit(0).write.parquet(f"{tmp_path}/pages.parquet")
    assert queries.op9_warc_captures(spark, str(tmp_path)).count() == 0
