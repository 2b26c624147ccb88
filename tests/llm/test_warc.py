"""WARC derivatives: records read back, links, digests and odd responses."""

import base64
import gzip
import hashlib
import json
import uuid
import zlib
from html.parser import HTMLParser

import pytest

import __spark_entry__ as contract
from farebox.llm.html_blocks import BLOCK
from farebox.llm.warc import build_record, decoded_body, derivatives, derive, digest, parse_http, parse_record, responses

PAGE = "<html><title>A &amp; B</title><body><p>Hi&nbsp;there<p>Ünï <a href='/x?a=1&amp;b=2'>link</a></body></html>"


@pytest.fixture(scope="module")
def made(spark):
    pages = spark.createDataFrame(
        [(1, "http://x.org/é", PAGE), (2, None, None), (None, "http://y.org/\r\nEvil: 1", ""), (1, "http://x.org/é", PAGE)],
        "page_id long, url string, html string",
    ).selectExpr("*", "'x' AS record", "1 AS record_type")
    source = responses(pages)
    return source.collect(), derivatives(source).collect()


def test_every_response_has_both_records(made):
    source, derived = made
    assert len(derived) == 2 * len(source)
    for r in derived:
        fields, block = parse_record(bytes(r.record))
        by_name = dict(fields)
        origin = next(s for s in source if s.page_id == r.page_id)
        source_fields, source_block = parse_record(bytes(origin.record))
        source_names = dict(source_fields)
        assert by_name["WARC-Type"] == r.record_type and by_name["WARC-Record-ID"] == r.record_id
        assert by_name["WARC-Refers-To"] == r.refers_to == source_names["WARC-Record-ID"]
        assert by_name["WARC-Target-URI"] == source_names["WARC-Target-URI"] and by_name["WARC-Date"] == source_names["WARC-Date"]
        assert by_name["WARC-Source-Payload-Digest"] == source_names["WARC-Payload-Digest"]
        assert by_name["WARC-Source-Block-Digest"] == digest(source_block) == source_names["WARC-Block-Digest"]
        assert by_name["WARC-Block-Digest"] == digest(block) == r.block_digest
        assert block.decode() == r.block and len(block) == r.content_length == int(by_name["Content-Length"])
    ids = {(r.page_id, r.record_type): r.record_id for r in derived}
    assert len(set(ids.values())) == len(ids)


def test_blocks(made):
    _, derived = made
    first = {r.record_type: r.block for r in derived if r.page_id == 1}
    assert first["conversion"] == "Hi there\nÜnï link"
    meta = json.loads(first["metadata"])
    assert meta["html"] == {"title": "A & B", "links": ["/x?a=1&b=2"]}
    assert meta["http"]["status"] == "HTTP/1.1 200 OK" and ["WARC-Type", "response"] in meta["source"]


def test_header_values_cannot_break_a_record(made):
    source, _ = made
    names = [k for k, _ in parse_record(bytes(next(s.record for s in source if s.page_id is None)))[0]]
    assert "Evil" not in names


def test_unreadable_records_and_other_types(spark):
    good = build_record([("WARC-Type", "request")], b"GET / HTTP/1.1\r\n\r\n")
    rows = [(1, None), (2, b""), (3, b"junk\r\n\r\nx"), (4, build_record([("WARC-Type", "response")], b"abc")[:-6]), (5, good)]
    got = derivatives(spark.createDataFrame([(i, bytearray(r) if r is not None else None) for i, r in rows], "page_id long, record binary")).collect()
    assert sorted((r.page_id, r.record_type) for r in got) == [(i, "unreadable") for i in (1, 2, 3, 4)]
    empty = spark.createDataFrame([], "page_id long, record binary")
    assert derivatives(empty).collect() == []


@pytest.mark.parametrize("coding, pack", [("gzip", gzip.compress), ("deflate", zlib.compress), ("deflate", lambda b: zlib.compress(b)[2:-4]),
                                          ("gzip", lambda b: b), ("gzip", lambda b: gzip.compress(b[:3]) + gzip.compress(b[3:])),
                                          ("gzip", lambda b: gzip.compress(b[:2]) + gzip.compress(b"") + gzip.compress(b[2:]) + bytes(9)),
                                          ("x-gzip", lambda b: gzip.compress(b) + b"junk")])
def test_encoded_and_chunked_bodies(coding, pack):
    body = pack("é text".encode("latin-1"))
    chunked = b"%x;e=1\r\n%b\r\n0\r\n\r\n" % (len(body), body)
    fields = [("Content-Type", "text/html; charset=ISO-8859-1"), ("Content-Encoding", coding), ("Transfer-Encoding", "chunked")]
    assert decoded_body(fields, chunked) == "é text"
    assert decoded_body([("Content-Type", "text/html; charset=nonsense")], "é".encode()) == "é"


class Plain(HTMLParser):
    """Visible text by the standard library's parser: a line for what stands between two block-level tags."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.lines, self.now, self.hidden, self.title, self.links = [], "", "", None, []
        self.feed(html)
        self.close()
        self.cut()

    def cut(self):
        line = " ".join(self.now.split())
        self.lines += [line] if line else []
        self.now = ""

    def handle_starttag(self, tag, attrs):
        self.links += [v or "" for k, v in attrs if tag == "a" and k == "href"]
        if tag in ("script", "style", "title", "textarea", "noscript", "iframe"):
            self.hidden, self.now = tag, self.now + " "
        elif tag in BLOCK:
            self.cut()
        elif tag == "br":
            self.now += " "

    def handle_endtag(self, tag):
        if tag == self.hidden:
            self.hidden = ""
        elif tag in BLOCK:
            self.cut()

    def handle_data(self, data):
        if not self.hidden:
            self.now += data
        elif self.hidden == "title" and self.title is None:
            self.title = " ".join(data.split())


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_the_query_against_records_built_apart(spark, sf):
    """Every record of the given pages, byte for byte, from the standard library's parser and plain formatting."""
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    got = {(r.page_id, r.record_type): r for r in contract.queries()["op3_warc_derivatives"](spark, sf).collect()}
    assert len(got) == 2 * len(pages)
    date = "2024-01-01T00:00:00Z"
    name = lambda *parts: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, chr(0).join(map(str, parts)))}>"

    def record(headers, block):
        headers = [*headers, ("WARC-Block-Digest", sha1(block)), ("Content-Length", len(block))]
        return "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in headers).encode() + b"\r\n" + block + b"\r\n\r\n"

    for page in pages:
        payload = (page.html or "").encode()
        http_fields = [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]
        block = "".join(["HTTP/1.1 200 OK\r\n", *(f"{k}: {v}\r\n" for k, v in http_fields), "\r\n"]).encode() + payload
        source = name("response", page.page_id, page.url, sha1(payload))
        fields = [("WARC-Type", "response"), ("WARC-Record-ID", source), ("WARC-Target-URI", page.url), ("WARC-Date", date),
                  ("WARC-Payload-Digest", sha1(payload)), ("Content-Type", "application/http; msgtype=response"),
                  ("WARC-Block-Digest", sha1(block)), ("Content-Length", str(len(block)))]
        plain = Plain(page.html or "")
        meta = {"source": [list(f) for f in fields], "http": {"status": "HTTP/1.1 200 OK", "headers": [list(f) for f in http_fields]},
                "html": {"title": plain.title, "links": plain.links}}
        for kind, mime, content in (("metadata", "application/json", json.dumps(meta, ensure_ascii=False)),
                                    ("conversion", "text/plain; charset=utf-8", "\n".join(plain.lines))):
            r, data = got[page.page_id, kind], content.encode()
            assert r.block == content
            want = record([("WARC-Type", kind), ("WARC-Record-ID", name(kind, source, sha1(payload))), ("WARC-Refers-To", source),
                           ("WARC-Target-URI", page.url), ("WARC-Date", date), ("WARC-Source-Payload-Digest", sha1(payload)),
                           ("WARC-Source-Block-Digest", sha1(block)), ("Content-Type", mime)], data)
            assert (r.record_length, r.record_sha1) == (len(want), hashlib.sha1(want).hexdigest())


def test_folded_headers_and_a_response_without_digest():
    record = build_record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>\tcontinued")], b"HTTP/1.0 404 No\r\nA: b\r\n c\r\n\r\n<p>x</p>")
    (kind, _, refers, _, payload, *_), _ = derive(record)
    assert kind == "metadata" and refers.startswith("<urn:x>") and payload == digest(b"<p>x</p>")
    assert parse_http(b"HTTP/1.0 200\r\nA: b\r\n c\r\n\r\nx")[1] == [("A", "b c")]
