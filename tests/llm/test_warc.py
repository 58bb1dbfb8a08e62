"""Bundles: exact round trip, lookups, revisits."""

import base64
import hashlib
import io
from collections import Counter

import zstandard

from waymark.llm import warc_bundle as w
from waymark.llm.common import SharedFiles, shared_folder


def pages(spark):
    html = ["<p>one</p>", "<p>two</p>", "<p>one</p>", None, "", "x\r\n\r\ny", "WARC/1.1\r\n\r\n", "é" * 70_000, "<p>one</p>"]
    rows = [(i * 3, f"http://a.example/{i}?q=%20 \r\n é", h, i) for i, h in enumerate(html)] + [(None, None, "<p>two</p>", 0), (None, None, "alone", 0), (0, "http://again", "<p>one</p>", 1)]
    rows += [(1000 + i, "http://b.example/", "shared" if i % 3 else f"page {i}", 0) for i in range(300)]
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest long").repartition(3)


def test_pages_round_trip(spark):
    df = pages(spark)
    source = df.collect()
    first = {}
    for r in source:
        if r.page_id is not None:
            first[r.html or ""] = min(first.get(r.html or "", r.page_id), r.page_id)
    want = Counter()
    for r in source:
        payload = (r.html or "").encode()
        refers = first.get(r.html or "")
        refers = None if refers == r.page_id else refers
        want[(r.page_id, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "response" if refers is None else "revisit", refers, r.url)] += 1
    assert Counter(map(tuple, w.archive_pages(spark, df).collect())) == want
    assert w.archive_pages(spark, df.limit(0)).count() == 0


def test_small_payloads_stay_responses(spark):
    rows = w.archive_pages(spark, pages(spark), min_revisit=8).collect()
    assert {r.record_type for r in rows if r.payload_bytes < 8} == {"response"}
    assert any(r.record_type == "revisit" for r in rows)


def test_lookup_and_whole_stream(spark):
    folder = shared_folder(spark, "warc-test")
    names = w.write_bundles(spark, pages(spark), folder)
    found, plain = Counter(), b""
    for name in names:
        with SharedFiles(folder).open(name) as file:
            raw = file.read()
            reader = w.BundleReader(io.BytesIO(raw))
            assert len(reader.frames) >= 1
            for page_id in (0, 21, 1007, None, -5):
                for headers, _ in reader.get(page_id):
                    assert w.page_of(headers["WARC-Record-ID"]) == page_id
                    found[page_id] += 1
        plain += zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert found == {0: 2, 21: 1, 1007: 1, None: 2}
    assert plain.count(b"WARC/1.1\r\nWARC-Type") == 312  # any Zstandard reader can unpack the records
