import gzip
import hashlib

import pytest

from jobtide.llm import warc
from jobtide.llm.common import table, workspace

SCHEMA = "page_id long, url string, html string, key string"


def expected(rows):
    first = {}
    for page, _, html, _ in rows:
        if html and len(html.encode()) >= 100 and page is not None:
            first[html] = min(first.get(html, page), page)
    out = []
    for page, _, html, _ in rows:
        payload = (html or "").encode()
        to = first.get(html) if len(payload) >= 100 else None
        to = None if to == page else to
        digest = hashlib.sha256(payload).hexdigest()
        out.append((str(page), len(payload), digest, "revisit" if to is not None else "response", to))
    return sorted(out, key=str)


def found(result):
    return sorted(
        ((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in result.collect()),
        key=str,
    )


def test_round_trip(spark):
    long, even = "x" * 150, "y" * 100
    rows = [
        (5, "http://a.b/c", long), (3, "http://a.b/c", long), (3, "http://a.b/c", long),
        (None, None, long), (8, "u\r\nv", "short"), (9, None, "short"), (10, "http://é.com/ü?q#f", None),
        (11, "HTTP://A.B", "line\r\n\r\nline\n"), (12, "", ""), (13, "http://z", even), (14, "http://z", even),
        (15, "http://z", "y" * 99), (16, "http://z", "y" * 99), (17, "http://big", "é" * 3_000_000),
    ]
    rows = [(*row, "clash") for row in rows]
    rows += [(100 + i, f"http://h{i % 7}.com/{i}", long, "") for i in range(300)]  # a hot payload
    assert found(warc.archive(spark.createDataFrame(rows, SCHEMA))) == expected(rows)
    assert found(warc.archive(spark.createDataFrame([], SCHEMA))) == []


def test_small_blocks_and_archives(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    rows = [(i, f"http://s{i % 5}.example.org/{i}", f"page {i} " * 30, "") for i in range(200)]
    assert found(warc.archive(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_records_are_plain_warc():
    payload = b"<html>\r\n\r\nbody"
    raw = gzip.decompress(warc.pack_record(7, "http://a/b", payload, "d", None))
    head, _, rest = raw.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and rest.endswith(b"\r\n\r\n")
    fields, size, body = warc.unpack_record(warc.pack_record(7, "http://a/b", payload, "d", 3))
    assert (fields["WARC-Type"], fields["WARC-Refers-To"], size, body) == ("revisit", "<urn:page:3>", 14, None)


def test_index_finds_only_what_is_asked(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    folder = workspace(spark)
    rows = [(i, f"http://s{i % 9}.org/{i}", str(i)) for i in range(100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    files = warc.write_index(warc.write_archives(pages, folder), folder)
    asked = spark.createDataFrame([("org,s4)/13\t13",), ("org,s4)/1\t1",), ("", ), ("zz",), ("org,s4)/13\t13",)], "key string")
    places = warc.look_up(asked, files, folder)
    assert [r.page_id for r in warc.read_records(places, folder, "bigint").collect()] == [13]


@pytest.mark.parametrize("name", ["pages"])
def test_whole_table(spark, sf_dir, name):
    pages = table(spark, sf_dir, name)
    rows = [(r.page_id, r.url, r.html, "") for r in pages.collect()]
    assert found(warc.archive(pages)) == expected(rows)


def test_stores_by_the_names_that_pyarrow_knows():
    given = ("s3a://bucket/a", "s3n://bucket/a", "s3://bucket/a", "hdfs://host/a", "file:///a")
    assert list(map(warc.plain_uri, given)) == ["s3://bucket/a", "s3://bucket/a", "s3://bucket/a", "hdfs://host/a", "file:///a"]
