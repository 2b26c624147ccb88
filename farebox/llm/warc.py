"""WARC derivatives: metadata and plain-text conversion records of HTTP responses."""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.bytes import row_slices
from farebox.llm.html_blocks import blocks, title_and_links
from farebox.llm.session import bound_batches

NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122: names that are URLs


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*names: object) -> str:
    """The same names give the same identifier, so a task that runs again writes the same record."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, chr(0).join(map(str, names)))}>"


def build_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A WARC/1.1 record with Content-Length and block digest added."""
    every = [*headers, ("WARC-Block-Digest", digest(block)), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in every)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _one_line(value: str) -> str:
    return re.sub(r"[\r\n]+", " ", value)


def _fields(head: bytes) -> list[tuple[str, str]]:
    """Header fields in order; a line that begins with white space continues the one before."""
    out: list[tuple[str, str]] = []
    for line in head.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], out[-1][1] + " " + line.strip())
        elif ":" in line:
            name, value = line.split(":", 1)
            out.append((name.strip(), value.strip()))
    return out


def parse_record(record: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """(header fields, block) of one record; ValueError if it is not whole."""
    head, found, rest = record.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/"):
        raise ValueError("no WARC header")
    fields = _fields(head.partition(b"\r\n")[2])
    length = dict((k.lower(), v) for k, v in fields).get("content-length", "")
    if not length.isdigit() or len(rest) < int(length):
        raise ValueError("block shorter than its Content-Length")
    return fields, rest[: int(length)]


def parse_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """(status line, header fields, body as sent)."""
    head, _, body = block.partition(b"\r\n\r\n")
    status, _, rest = head.partition(b"\r\n")
    return status.decode("utf-8", "replace"), _fields(rest), body


def decoded_body(fields: list[tuple[str, str]], body: bytes) -> str:
    """The body as text: chunks joined, gzip (all members) or deflate undone, decoded by the charset given or as
    UTF-8. What is left of a compressed body that breaks off, or that another coding follows, is what could be read."""
    by_name = {k.lower(): v.lower() for k, v in fields}
    if "chunked" in by_name.get("transfer-encoding", ""):
        parts, at = [], 0
        while (end := body.find(b"\r\n", at)) >= 0:
            size = body[at:end].split(b";")[0].strip()
            if not re.fullmatch(rb"[0-9a-fA-F]+", size) or int(size, 16) == 0:
                break
            parts.append(body[end + 2 : end + 2 + int(size, 16)])
            at = end + 4 + int(size, 16)
        body = b"".join(parts)
    coding = by_name.get("content-encoding", "")
    if coding in ("gzip", "x-gzip", "deflate"):
        window = 47 if "gzip" in coding or body[:1] == b"\x78" else -15
        parts, rest = [], body
        while rest:
            member = zlib.decompressobj(window)
            try:
                parts.append(member.decompress(rest))
            except zlib.error:
                break
            rest = member.unused_data.lstrip(b"\0") if window == 47 else b""
        if parts:
            body = b"".join(parts)  # some servers announce a coding they do not use: then the body is as sent
    charset = re.search(r"charset=[\"']?([-\w]+)", by_name.get("content-type", ""))
    try:
        return body.decode(charset[1] if charset else "utf-8", "replace")
    except LookupError:
        return body.decode("utf-8", "replace")


def _response(page_id: int | None, url: str | None, html: str | None, date: str) -> bytes:
    payload = (html or "").encode()
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
        + str(len(payload)).encode() + b"\r\n\r\n" + payload
    )
    return build_record(
        [
            ("WARC-Type", "response"),
            ("WARC-Record-ID", record_id("response", page_id, url, digest(payload))),
            ("WARC-Target-URI", url or ""),
            ("WARC-Date", date),
            ("WARC-Payload-Digest", digest(payload)),
            ("Content-Type", "application/http; msgtype=response"),
        ],
        http,
    )


def responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """``pages`` (page_id, url, html) as response records: page_id, record. Nulls count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chain.from_iterable(map(row_slices, batches)):
            columns = [c.to_pylist() for c in batch.columns]
            records = [_response(*row, date) for row in zip(*columns)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(records, pa.binary())], ["page_id", "record"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id long, record binary")


DERIVED = (
    "page_id long, record_type string, record_id string, refers_to string, target_uri string, "
    "source_payload_digest string, block_digest string, content_length long, block string, record binary"
)


def derive(record: bytes) -> list[tuple]:
    """The metadata and the conversion record of a response, in the columns of ``DERIVED`` after page_id.

    Records of other types have none.
    """
    fields, block = parse_record(record)
    source = {k.lower(): v for k, v in fields}
    if source.get("warc-type") != "response":
        return []
    status, http, body = parse_http(block)
    html = decoded_body(http, body)
    title, links = title_and_links(html)
    refers, uri = source.get("warc-record-id", ""), source.get("warc-target-uri", "")
    payload = source.get("warc-payload-digest") or digest(body)
    envelope = {
        "source": fields,
        "http": {"status": status, "headers": http},
        "html": {"title": title, "links": links},
    }
    text = "\n".join(b.text for b in blocks(html))
    out = []
    for kind, content_type, content in (
        ("metadata", "application/json", json.dumps(envelope, ensure_ascii=False)),
        ("conversion", "text/plain; charset=utf-8", text),
    ):
        data = content.encode("utf-8", "replace")
        headers = [
            ("WARC-Type", kind),
            ("WARC-Record-ID", record_id(kind, refers, payload)),
            ("WARC-Refers-To", refers),
            ("WARC-Target-URI", uri),
            ("WARC-Date", source.get("warc-date", "")),
            ("WARC-Source-Payload-Digest", payload),
            ("WARC-Source-Block-Digest", digest(block)),
            ("Content-Type", content_type),
        ]
        made = build_record(headers, data)
        out.append((kind, headers[1][1], refers, uri, payload, digest(data), len(data), content, made))
    return out


def _derivatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in DERIVED.split(", ")]
    kinds = [pa.int64(), *[pa.string()] * 6, pa.int64(), pa.string(), pa.binary()]
    for batch in chain.from_iterable(map(row_slices, batches)):
        rows: list[tuple] = []
        size = 0
        for page_id, record in zip(batch.column(0).to_pylist(), batch.column(1)):
            try:
                found = derive(record.as_py() or b"")
            except ValueError as error:
                found = [("unreadable", None, None, None, None, None, None, str(error), record.as_py())]
            rows += [(page_id, *r) for r in found]
            size += 3 * len(record.as_py() or b"")
            if size > 1 << 24:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)


def derivatives(records: DataFrame) -> DataFrame:
    """Two rows per response record of ``records`` (page_id, record): its metadata and conversion records.

    Columns: page_id, record_type, record_id, refers_to, target_uri, source_payload_digest,
    block_digest, content_length, block, and ``record``, the bytes to write to a file. Both records
    refer to the response by its identifier and repeat its date, target URI and digests; the
    metadata block (JSON) keeps all of the source's WARC and HTTP header fields in order, with the
    page's title and links; the conversion block is the visible text, one line per block. Records of
    other types give no row. A null, empty or broken record gives one of type ``unreadable`` with the
    reason as its block. Empty input: no rows. Repeated records give the same rows again. Each record
    is derived where it is read, so nothing is shuffled.
    """
    bound_batches(records.sparkSession)
    rows = records.select(F.col("page_id").cast("long").alias("page_id"), "record")
    return rows.mapInArrow(_derivatives, DERIVED)
