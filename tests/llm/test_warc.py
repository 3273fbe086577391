"""WARC archives: round trips against plain Python."""

from __future__ import annotations

import gzip
import hashlib

import pytest

from riskmill.llm import warc
from riskmill.llm.common import new_folder
from riskmill.llm.queries import QUERIES


def expected(pages: list[tuple]) -> list[tuple]:
    first = {}
    for page, _, html in sorted(pages, key=lambda p: p[0]):
        first.setdefault((html or "").encode(), page)
    rows = []
    for page, _, html in pages:
        raw = (html or "").encode()
        shared = len(raw) >= 100 and first[raw] != page
        rows.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if shared else "response",
                     first[raw] if shared else None))
    return sorted(rows, key=repr)


def test_query(spark, small):
    pages = [tuple(r) for r in spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url", "html").collect()]
    got = QUERIES["op7_warc_round_trip"](spark, small).collect()
    assert sorted(map(tuple, got), key=repr) == expected(pages)


@pytest.mark.parametrize("segment,chunk", [(64, 16), (100, 30), (1 << 20, 1 << 16)])
def test_odd_pages(spark, segment, chunk):
    evil = "x\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 5
    pages = [(5, "http://a/", evil), (3, None, evil), (9, "u\r\nX: y", evil), (4, "u", None), (6, "u", ""), (7, "u", "é" * 49),
             (8, "u", "é" * 49), (10, "u", "é" * 50), (11, "u", "é" * 50), (12, "u", "long " * 5000), (12, "u", "long " * 5000),
             (12, "u", "other" * 50), (13, "u", "other" * 50), (2, "u", "\n".join(map(str, range(3000))))]
    table = spark.createDataFrame([(*p, "d", 1) for p in pages], "page_id bigint, url string, html string, digest string, size int")
    got = warc.round_trip(table.repartition(3), segment, chunk).collect()
    assert sorted(map(tuple, got), key=repr) == expected(pages)
    assert warc.round_trip(table.limit(0)).count() == 0


def test_records_are_bounded_and_sound(spark):
    pages = spark.createDataFrame([(1, "http://x/", "a" * 1000), (2, "http://y/", "a" * 1000)], "page_id bigint, url string, html string")
    folder = new_folder(spark, "test-warc")
    warc.write_archive(pages.coalesce(1), folder, segment=256)
    raw = b"".join(r.content for r in warc.read_blobs(spark, folder).orderBy("path").collect())
    records = list(warc.parse_records(warc.inflated(memoryview(raw), 7)))
    assert records == list(warc.parse_records(warc.inflated(memoryview(gzip.decompress(raw)), 5)))
    kinds = sorted(f["warc-type"] for f, _ in records)
    assert kinds == ["continuation"] * 3 + ["response", "revisit"]
    assert max(len(block) for _, block in records) <= 256
    last = [f for f, _ in records if "warc-segment-total-length" in f]
    assert len(last) == 1 and last[0]["warc-segment-total-length"] == "1000" and last[0]["warc-segment-number"] == "4"
    chunks = warc.read_chunks(spark, folder, chunk=100, segment=256).orderBy("record_id", "chunk_no").collect()
    assert b"".join(c.raw for c in chunks) == b"a" * 1000 and max(len(c.raw) for c in chunks) <= 100


def test_damage_is_an_error():
    with pytest.raises(ValueError):
        list(warc.parse_records([b"WARC/1.1\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n"]))
    with pytest.raises(ValueError):
        list(warc.parse_records([b"HTTP/1.1\r\n\r\n"]))
