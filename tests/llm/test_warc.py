"""ARC to WARC: round trip, header lines of both versions, revisits."""

import gzip
import hashlib
import io
from collections import defaultdict

from clickloom.llm import warc

SF = "/root/testdata/sf0.001"


def expected(rows):
    groups = defaultdict(list)
    for i, _, html in rows:
        data = (html or "").encode()
        groups[data if len(data) >= 1000 else (i, data)].append(i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        same = groups[data if len(data) >= 1000 else (i, data)]
        known = [s for s in same if s is not None]
        keep = max(known, default=None)
        revisit = keep is not None and i != keep
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", keep if revisit else None))
    return sorted(out, key=str)


def got(df):
    return sorted(
        ((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()), key=str
    )


def test_pages_come_back(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = [tuple(r) for r in pages.select("page_id", "url", "html").collect()]
    result = warc.page_archive(pages, str(tmp_path))
    assert got(result) == expected(rows)
    assert result.filter("not digest_ok or warc_date <> '2024-02-29T23:59:59Z'").count() == 0


def test_odd_rows(spark, tmp_path):
    big, trap = "x" * 1500, "WARC/1.1\r\nContent-Length: 5\r\n\r\nhello\r\n\r\nfiledesc://a 0 0 0 3\n"
    rows = [
        (1, "http://a/x y\n", big), (2, None, big), (3, "", None), (4, "http://ä/é", "é" * 700), (5, "u", "é" * 700),
        (6, "u", trap * 40), (7, "u", trap * 40), (8, "u", "x" * 999), (9, "u", "x" * 999), (9, "u", "x" * 999),
        (None, "u", big), (10, "u", "\x00\r\n\r\n"), (11, "u", ""), (12, "u", "y" * 3_000_000),
    ]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, payload string")
    result = warc.page_archive(pages, str(tmp_path / "a"))
    assert got(result) == expected(rows)
    urls = {r.page_id: r.target_uri for r in result.collect()}
    assert urls[1] == "http://a/x%20y%0A" and urls[2] == "urn:page" and urls[4] == "http://ä/é"
    assert warc.page_archive(pages.limit(0), str(tmp_path / "b")).collect() == []


def arc(version, records):
    block = f"{version} 0 org\n{warc.ARC_FIELDS[version]}\n"
    extra = " 200 - - 0 f" if version == 2 else ""
    out = f"filedesc://f 0.0.0.0 20010203040506 text/plain{extra} {len(block)}\n{block}\n".encode()
    for url, size, body in records:
        out += f"{url} 1.2.3.4 20010203040506 text/html{extra} {size}\n".encode() + body + b"\n"
    return out


def test_header_lines(spark, tmp_path):
    http = b"HTTP/1.0 200 OK\r\nX-Page-Id: 7\r\n\r\nbody"
    for version in (1, 2):
        (tmp_path / f"{version}.arc").write_bytes(
            arc(version, [("http://a b/c", len(http), http), ("ftp://x", 3, b"raw"), ("http://cut", 99, b"short")])
        )
    (tmp_path / "3.arc.gz").write_bytes(gzip.compress(arc(2, [("http://z", 2, b"\n\n")]) + b"no header line\nrest"))
    (tmp_path / "4.arc").write_bytes(b"")
    rows = warc.read_arc(spark, str(tmp_path)).collect()
    for version in (1, 2):
        found = [(r.url, r.page_id, r.payload, r.complete, r.status) for r in rows if r.version == version and "3.arc" not in r.file]
        status = 200 if version == 2 else None
        assert found == [("http://a b/c", 7, b"body", True, status), ("ftp://x", None, b"raw", True, status),
                         ("http://cut", None, b"short\n", False, status)]
    assert [r.payload for r in rows if "3.arc" in r.file] == [b"\n\n"]
    warc.convert(spark, str(tmp_path), str(tmp_path / "out"))
    types = sorted(r.record_type for r in warc.read_warc(spark, str(tmp_path / "out")).collect())
    assert types == ["resource"] * 5 + ["response"] * 2
    data = b"".join(gzip.decompress(f.read_bytes()) for f in (tmp_path / "out").glob("part*"))
    assert data.count(b"WARC-Truncated: unspecified") == 2 and b"WARC-Date: 2001-02-03T04:05:06Z\r\n" in data
    assert all(len(b) == int(f["content-length"]) for f, b in warc.warc_records(io.BufferedReader(io.BytesIO(data))))
