"""WARC records: exact round trip, roles, segments, awkward payloads."""

import base64
import hashlib
import itertools

import pytest

from patronscope.llm import queries, warc
from patronscope.operators.durable import fresh_path

DDL = "page_id long, url string, html string, extra string, record_type int"


def round_trip(spark, rows, chunk_bytes=1 << 20, **options):
    path = fresh_path(spark, "warc-test")
    warc.write_archives(spark.createDataFrame(rows, DDL), path, **options)
    return warc.read_chunks(spark, path, chunk_bytes)


def sha(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(rows, least=0):
    first = {}
    for page, _, html, *_ in rows:
        html = html or ""
        if page is not None and (html not in first or page < first[html]):
            first[html] = page
    out = []
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        smallest = first.get(html or "")
        again = page != smallest and len(data) >= least
        out.append((page, len(data), sha(data), "revisit" if again else "response", smallest if again else None))
    return sorted(out, key=repr)


def actual(chunks):
    rows = warc.record_digests(chunks).collect()
    return sorted(
        ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=repr
    )


ROWS = [
    (5, "http://a/1", "<p>same</p>", "x", 1),
    (3, "http://a/2", "<p>same</p>", "x", 1),
    (9, "http://a/3", "<p>same</p>", "x", 1),
    (1, None, None, "x", 1),
    (2, "http://a/5\r\nX: y", "", None, None),
    (4, "u", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nb\r\n\r\n", "x", 1),
    (6, "u", "\r\n\r\n", "x", 1),
    (7, "u", "\r\n\r\n\r\n\r\nx", "x", 1),
    (8, "ü", "é漢😀" * 500, "x", 1),
    (8, "ü", "é漢😀" * 500, "x", 1),
    (None, "u", "only", "x", 1),
    (None, "u", "<p>same</p>", "x", 1),
]


def test_round_trip_of_awkward_payloads(spark):
    assert actual(round_trip(spark, ROWS)) == expected(ROWS)


def test_segments_and_chunks(spark):
    chunks = round_trip(spark, ROWS, chunk_bytes=7, segment_bytes=10)
    assert actual(chunks) == expected(ROWS)
    parts = [r for r in chunks.collect() if r.page_id == 8 and r.record_type == "response"]
    one = sorted((r for r in parts if r.record_no == parts[0].record_no), key=lambda r: r.chunk_no)
    assert [r.chunk_no for r in one] == list(range(len(one)))
    assert max(len(r.data) for r in one) <= 7
    so_far = b""
    for r in one:
        so_far += bytes(r.data)
        assert (r.payload_bytes, r.payload_digest) == (len(so_far), sha(so_far))
    assert so_far.decode() == "é漢😀" * 500


def test_small_payloads_are_all_responses(spark):
    assert actual(round_trip(spark, ROWS, revisit_min_bytes=12)) == expected(ROWS, least=12)


def test_no_pages(spark):
    assert actual(round_trip(spark, [])) == []


def test_query_on_the_table(spark, sf):
    pages = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    rows = queries.op1_warc_chunks(spark, sf).collect()
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=repr)
    assert got == expected(pages)


@pytest.mark.parametrize("segment_bytes", [1, 2, 3, 5, 1 << 20])
def test_all_short_strings_of_line_ends(spark, tmp_path, segment_bytes):
    texts = ["".join(x) for n in range(8 if segment_bytes > 5 else 6) for x in itertools.product("a\r\n", repeat=n)]
    rows = [(i, f"http://x/{i}", t) for i, t in enumerate(texts)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    path = str(tmp_path / "warc")
    # payloads are unique, so that every one is written
    warc.write_archives(pages, path, segment_bytes=segment_bytes)
    for chunk_bytes in (2, 1 << 20):
        found = {}
        for r in warc.read_chunks(spark, path, chunk_bytes).orderBy("page_id", "chunk_no").collect():
            found[r.page_id] = found.get(r.page_id, b"") + r.data
            assert len(r.data) <= chunk_bytes
        assert found == {i: t.encode() for i, _, t in rows}


def test_urls_come_back_unchanged(spark, tmp_path):
    urls = ["http://x/a b", " lead", "trail ", "tab\there", "x\r\nX-Page-Id: 9", "\u3000wide\u3000", "\x85", "%20", "", None, "é"]
    pages = spark.createDataFrame([(i, u, f"p{i}") for i, u in enumerate(urls)], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "warc"))
    rows = warc.record_digests(warc.read_chunks(spark, str(tmp_path / "warc"))).collect()
    assert {r.page_id: r.url for r in rows} == dict(enumerate(urls))


def test_a_very_long_text_at_the_default_segment_size(spark, tmp_path):
    text = "é<p>line\r\n\r\n</p>\r\n" * 200_000
    pages = spark.createDataFrame([(1, "u", text), (2, "v", text + "\r\n")], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "warc"))
    chunks = warc.read_chunks(spark, str(tmp_path / "warc")).orderBy("page_id", "chunk_no").collect()
    for page_id, want in ((1, text), (2, text + "\r\n")):
        own = [c for c in chunks if c.page_id == page_id]
        assert b"".join(c.data for c in own) == want.encode() and len(own) > 3 and [c.last for c in own].count(True) == 1


def test_a_damaged_block_is_an_error(spark):
    head = b"WARC/1.1\r\nWARC-Type: resource\r\nContent-Length: 3"
    with pytest.raises(ValueError):
        list(warc._chunks(iter([head, b"abcd"]), 10, True))
    with pytest.raises(ValueError):
        list(warc._chunks(iter([head, b"a"]), 10, True))
