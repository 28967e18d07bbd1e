from __future__ import annotations

import base64
import gzip
import hashlib
import os

import pytest

from salesmart.llm import shared, warc
from tests.llm.helpers import table


def sha(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def arc(version: int, records: list[tuple[str, bytes]]) -> bytes:
    fields = warc.ARC_FIELDS[version]
    block = f"{version} 0 test\n{fields}\n".encode()
    between = " 200 - - 0 x.arc" if version == 2 else ""
    out = f"filedesc://x.arc 0.0.0.0 19990101 text/plain{between} {len(block)}\n".encode() + block + b"\n"
    for url, body in records:
        out += f"{url} 1.2.3.4 19990102030405 text/html{between} {len(body)}\n".encode() + body + b"\n"
    return out


@pytest.mark.parametrize("version", (1, 2))
@pytest.mark.parametrize("squeeze", (bytes, gzip.compress, lambda b: gzip.compress(b[:100]) + gzip.compress(b[100:])))
def test_arc_headers_and_lengths(version, squeeze):
    http = b"HTTP/1.0 200 OK\r\nA: b\r\n\r\n"
    bodies = [http + b"line\nhttp://fake 1 2 3 4\n\n", http, b"no header\xff\x00", b""]
    urls = ["http://a/", "http://b/with space", "dns:c", "http://d/"]
    found = list(warc.parse_arc("x.arc", squeeze(arc(version, list(zip(urls, bodies))))))
    assert [f["uri"] for f in found] == urls
    assert [f["head"] + f["payload"] for f in found] == bodies
    assert [f["type"] for f in found] == ["response", "response", "resource", "resource"]
    assert {f["date"] for f in found} == {"1999-01-02T03:04:05Z"} and {f["ip"] for f in found} == {"1.2.3.4"}
    assert [f["payload_digest"] for f in found] == [sha(f["payload"]) for f in found]
    assert len({f["record_id"] for f in found}) == 4


def test_truncated_record_is_an_error():
    with pytest.raises(ValueError):
        list(warc.parse_arc("x.arc", arc(1, [("http://a/", b"abc")])[:-3]))


def test_records_round_trip(spark):
    bodies = [os.urandom(3000), b"\r\n\r\nWARC/1.1\r\n", b"", b"same", b"same"]
    path, out = (shared.new_path(spark, x) for x in ("arc", "warc"))
    os.makedirs(path.removeprefix("file://"))
    with open(f"{path.removeprefix('file://')}/one.arc.gz", "wb") as file:
        file.write(gzip.compress(arc(2, [(f"http://{i}/", b"HTTP/1.1 200 OK\r\nX-Page-Id: %d\r\n\r\n" % i + b) for i, b in enumerate(bodies)])))
    warc.convert(spark, path, out)
    found = {r.page_id: r for r in warc.read_warc(spark, out).collect()}
    assert [bytes(found[i].payload) for i in range(5)] == [*bodies[:3], b"", b"same"]
    assert found[3].type == "revisit" and found[3].refers_to_id == found[4].record_id
    assert [found[i].payload_digest for i in range(5)] == [sha(b) for b in bodies]
    assert found[0].date == "1999-01-02T03:04:05Z"


def test_pages(spark):
    rows = [
        (1, "http://a", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://x y\n", None), (9, "u", ""),
        (5, "u", "<p>é</p>"), (None, "u", "alone\r\n\r\nWARC/1.1\r\n"), (6, "u", "x" * 200_000),
    ]
    pages = table(spark, rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in warc.archive_pages(pages).collect()}
    for page, _, html in rows:
        body = (html or "").encode()
        assert (found[page].payload_bytes, found[page].payload_digest) == (len(body), sha(body))
    assert {p: (r.record_type, r.refers_to) for p, r in found.items()} == {
        1: ("revisit", 5), 2: ("revisit", 5), 5: ("response", None), 3: ("revisit", 9), 9: ("response", None),
        None: ("response", None), 6: ("response", None),
    }


def test_small_payloads_stay_and_repeated_rows(spark):
    pages = table(spark, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (3, "u", "abc")], "page_id long, url string, html string")
    found = sorted((r.page_id, r.record_type, r.refers_to) for r in warc.archive_pages(pages, min_bytes=3).collect())
    assert found[:2] == [(1, "response", None), (2, "response", None)]
    assert sorted(f[1] for f in found[2:]) == ["response", "revisit"]


def test_no_pages(spark):
    assert warc.archive_pages(table(spark, [], "page_id long, url string, html string")).collect() == []
