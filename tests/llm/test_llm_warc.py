import base64
import hashlib
from collections import defaultdict

import pytest

from ledgerline.llm import warc

PAGES = "page_id long, url string, html string"
ODD = [
    (1, "http://a.b/c?d", "x"),
    (2, "http://A.b:80/c", "x"),
    (None, "bad url\r\nx: y", "x"),
    (4, None, None),
    (5, "", ""),
    (1, "http://a.b/c?d", "x"),
    (7, "http://[bad", "é\U0001f600"),
    (8, "http://a.b/c?d", "y\r\n\r\nz"),
    (9, "https://long.example/", "w" * 300_000),
]


def expected(rows):
    ids = defaultdict(list)
    for i, _, html in rows:
        if i is not None:
            ids[html or ""].append(i)
    out = []
    for i, _, html in rows:
        payload = (html or "").encode()
        least = min(ids[html or ""], default=None)
        refers = least if least is not None and i != least else None
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((i, len(payload), digest, "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


def digests(rows):
    return sorted(
        (
            (r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
            for r in rows
        ),
        key=repr,
    )


@pytest.mark.parametrize("lines", [1, 3, 1000])
def test_round_trip(spark, monkeypatch, lines):
    monkeypatch.setattr(warc, "BLOCK_LINES", lines)
    pages = spark.createDataFrame(
        [(*r, "clash") for r in ODD], PAGES + ", payload_digest string"
    ).repartition(3)
    shards = warc.write_index(warc.write_archives(pages))
    assert digests(warc.read_all(shards).collect()) == expected(ODD)
    urls = spark.createDataFrame([("http://A.B/c?d",), (None,), ("http://none/",)], "url string")
    found = warc.look_up(shards, urls).collect()
    assert sorted(r["page_id"] for r in found) == [1, 1, 4, 5, 8]


def test_many_pages(spark):
    copies = spark.range(600).selectExpr(
        "id as page_id",
        "concat('http://h', id % 7, '.example/', id % 50) as url",
        "if(id % 3 = 0, 'the same page', concat('page ', id)) as html",
    )
    rows = [tuple(r) for r in copies.collect()]
    assert digests(warc.archived_pages(copies).collect()) == expected(rows)


def test_no_pages(spark):
    assert warc.archived_pages(spark.createDataFrame([], PAGES)).collect() == []


def test_url_keys():
    assert warc.url_key("HTTP://Www.Example.COM:8080/a?b=c") == "com,example,www:8080)/a?b=c"
    assert warc.url_key("http://a.b") == "b,a)/"
    assert warc.url_key("no url at all") == "nourlatall"
    assert warc.url_key(None) == ""


def test_members_are_records_of_their_own():
    record, digest = warc.page_record(3, "http://a/", "text", None)
    headers, payload = warc.parse_record(record)
    assert payload == b"text" and headers["WARC-Type"] == "response"
    assert headers["WARC-Payload-Digest"] == f"sha1:{digest}"
    headers, payload = warc.parse_record(warc.page_record(4, "http://a/", "text", 3)[0])
    assert payload == b"" and headers["Page-Refers-To"] == "3"


def test_pages_are_found_by_their_url(spark):
    """Every asking page, among many captures of a hot URL, over several shards and blocks."""
    rows = [(i, "http://hot.example/" if i % 3 else f"http://h{i % 7}.example/p{i}", f"x{i % 50}") for i in range(900)]
    rows += [(None, "http://hot.example/", "n"), (20, "http://hot.example/", "twice"), (40, None, None)]
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 as of", "2 as there").repartition(4)
    out = warc.archived_pages(pages)
    assert out.columns == [
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "found_by_url"
    ]
    found = out.collect()
    assert len(found) == len(rows)
    for r in found:
        asks = r["page_id"] is not None and r["page_id"] % 20 == 0
        assert r["found_by_url"] is (True if asks else None)


def test_a_hot_url_is_read_some_captures_at_a_time(spark):
    pages = spark.createDataFrame([(i, "http://hot.example/", f"x{i}") for i in range(700)], PAGES)
    shards = warc.write_index(warc.write_archives(pages))
    urls = spark.createDataFrame([("http://HOT.example",)], "url string")
    batches = warc.look_up(shards, urls)
    assert batches.count() == 700
    assert sorted(r["page_id"] for r in batches.select("page_id").collect()) == list(range(700))
