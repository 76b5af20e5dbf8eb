"""op10: archives written, read back whole and in part."""

from __future__ import annotations

import hashlib

import pytest
from corpus_cases import collected

from gaugeflow.llm import warc
from gaugeflow.session import fresh_dir

SAME = "<p>é</p>" * 40


def test_round_trip(spark):
    rows = [
        (5, "http://a/", SAME),
        (3, "http://b/", SAME),
        (3, "http://b/", SAME),
        (9, "http://c/\r\nX-Evil: 1", SAME),
        (4, None, "short"),
        (6, "http://d/", "short"),
        (7, "http://e/", None),
        (8, "http://f/", ""),
        (None, "http://g/", SAME),
        (10, "http://h/", "\r\n\r\n" + "x" * 300_000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.selectExpr("*", "1 as offset", "'x' as digest", "2 as refers_to")
    found = warc.archive_pages(pages).collect()
    wanted = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        revisit = html == SAME and page_id is not None and page_id > 3
        wanted.append(
            (
                page_id,
                len(data),
                hashlib.sha256(data).hexdigest(),
                "revisit" if revisit else "response",
                3 if revisit else None,
            )
        )
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    assert {r.url for r in found if r.page_id == 9} == {"http://c/%0D%0AX-Evil: 1"}
    assert warc.archive_pages(pages.limit(0)).count() == 0


def test_selected_records_alone(spark):
    rows = [(k, f"http://x/{k}", f"page {k} " * 100) for k in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = fresh_dir(spark, "warc")
    index = warc.write_archive(pages, folder, roll_bytes=3000)
    assert index.select("file").distinct().count() > 1
    some = warc.read_records(index.filter("page_id % 9 = 2"), folder).collect()
    assert {(r.page_id, bytes(r.payload).decode()) for r in some} == {
        (i, html) for i, _, html in rows if i % 9 == 2
    }
    assert len(collected(warc.read_records(index, folder))) == 60


def test_ranges():
    places = [(0, 10), (10, 5), (40, 5), (45, 5), (200, 9)]
    got = list(warc.coalesce_ranges(places, gap=25, most=45))
    assert [(a, b, len(p)) for a, b, p in got] == [(0, 45, 3), (45, 50, 1), (200, 209, 1)]


def test_damage_is_noticed():
    member = warc.record_bytes(1, "http://a/", b"abc", "0" * 64, None)
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(member)
