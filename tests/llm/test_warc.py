from __future__ import annotations

import gzip
import hashlib
from pathlib import Path

from regionpulse.llm import warc


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, record_id string").repartition(3)


def brute(rows):
    first = {}
    for page, _, html, _ in rows:
        raw = (html or "").encode()
        if len(raw) >= 100:
            first[raw] = min(first.get(raw, page), page)
    out = []
    for page, _, html, _ in rows:
        raw = (html or "").encode()
        other = first.get(raw, page)
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "response" if other == page else "revisit", None if other == page else other))
    return sorted(out)


def test_round_trip(spark, tmp_path):
    body = "WARC/1.1\r\n\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\né" * 5
    rows = [(9 - i, f"http://x/{i}\r\nX: y", body, "z") for i in range(6)]
    rows += [(20, None, None, None), (21, "u", "", None), (22, "u", "short", None), (23, "v", "short", None), (24, "v", "b" * 300_000, None)]
    rows += [(25, "v", "é" * 50, None), (26, "v", "é" * 50, None), (27, "v", "a" * 99, None), (28, "v", "a" * 99, None)]
    pages(spark, rows).write.parquet(f"{tmp_path}/pages.parquet")
    out = warc.query(spark, str(tmp_path)).collect()
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out) == brute(rows)
    assert all(r.intact for r in out)


def test_archives_are_plain_warc(spark, tmp_path):
    rows = [(1, "http://x/ y", "p" * 200, None), (2, "http://z", "p" * 200, None)]
    path = f"{tmp_path}/out"
    warc.write_archives(warc.resolve(warc.captures(pages(spark, rows))), path, "2026-01-01T00:00:00Z")
    text = b"".join(gzip.decompress(p.read_bytes()) for p in sorted(Path(path).glob("*.gz"))).decode()
    assert text.count("WARC/1.1\r\n") == 2 and text.count("p" * 200) == 1 and text.endswith("\r\n\r\n")
    assert "WARC-Target-URI: http://x/%20y\r\n" in text and "WARC-Refers-To-Target-URI: http://x/ y\r\n".replace(" y", "%20y") in text


def test_nulls_ties_and_empty(spark, tmp_path):
    rows = [(None, "a", "n" * 150, None), (4, "b", "n" * 150, None), (4, "c", "n" * 150, None), (7, "d", "m" * 150, None), (7, "d", "m" * 150, None)]
    path = f"{tmp_path}/a"
    warc.write_archives(warc.resolve(warc.captures(pages(spark, rows))), path)
    got = warc.follow(warc.read_archives(spark, path)).collect()
    found = sorted((r.page_id or 0, r.url, r.record_type, r.refers_to) for r in got)
    assert found == [(0, "a", "revisit", 4), (4, "b", "response", None), (4, "c", "revisit", 4), (7, "d", "response", None), (7, "d", "response", None)]
    warc.write_archives(warc.resolve(warc.captures(pages(spark, []))), f"{tmp_path}/b")
    assert warc.follow(warc.read_archives(spark, f"{tmp_path}/b")).count() == 0
