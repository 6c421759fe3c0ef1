"""Derived WARC records: metadata and plain-text conversions of responses.

A response record becomes two records that point back to it: a ``metadata``
record with what was learnt about the capture and all headers of the source, and
a ``conversion`` record with the text of the page. Both keep the source's id in
WARC-Refers-To, its address and date, and its payload digest. Records are
complete bytes, so those of a partition, one after the other, are a WARC file.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from skyledger.llm.inputs import pick

VERSION = "WARC/1.1"
END = b"\r\n\r\n"

SCHEMA = (
    "record_id string, record_type string, refers_to string, target_uri string, warc_date string, content_type string, "
    "source_payload_digest string, source_digest_matches boolean, block_digest string, content_length long, title string, text string, record binary"
)
NAMES = [part.split()[0] for part in SCHEMA.split(", ")]
TYPES = [{"string": pa.string(), "boolean": pa.bool_(), "long": pa.int64(), "binary": pa.binary()}[part.split()[1]] for part in SCHEMA.split(", ")]

HIDDEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|textarea|title)\b.*?(?:</\1\s*>|\Z)", re.S | re.I)
BREAKS = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|caption|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|html|li|main|nav|ol|option|p|pre|"
    r"section|select|summary|table|tbody|td|tfoot|th|thead|tr|ul)\b[^>]*(?:>|\Z)", re.I)
TAGS = re.compile(r"</?[a-zA-Z!?][^>]*(?:>|\Z)")
TITLE = re.compile(r"<title\b[^>]*>(.*?)(?:</title\s*>|\Z)", re.S | re.I)
EMPTY_LINE = re.compile(rb"\r?\n\r?\n")
CHUNK = re.compile(rb"\s*([0-9a-fA-F]+)[^\n]*\n")
CHARSET = re.compile(rb"""<meta\b[^>]*?charset\s*=\s*["']?\s*([\w.:-]+)""", re.I)


@dataclass
class Record:
    """One WARC record: header names and values in their order, and the block."""

    headers: list[tuple[str, str]]
    block: bytes

    def get(self, name: str) -> str | None:
        return next((v for k, v in self.headers if k.lower() == name.lower()), None)

    def data(self) -> bytes:
        lines = [VERSION, *(f"{k}: {v}" for k, v in self.headers)]
        return "\r\n".join(lines).encode() + END + self.block + END


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(kind: str, key: str) -> str:
    """The same id for the same kind and source, so a task that runs again makes the same records."""
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{kind} {key}'.encode()).digest(), version=4)}>"


def header_lines(data: bytes) -> list[tuple[str, str]]:
    """Header fields of a block of lines; folded lines belong to the field before."""
    fields: list[tuple[str, str]] = []
    for line in data.decode("utf-8", "replace").split("\n"):
        line = line.rstrip("\r")
        if line[:1] in (" ", "\t") and fields:
            fields[-1] = (fields[-1][0], f"{fields[-1][1]} {line.strip()}")
        elif ":" in line:
            name, value = line.split(":", 1)
            fields.append((name.strip(), value.strip()))
    return fields


def split_header(data: bytes) -> tuple[bytes, bytes]:
    """What stands before and behind the first empty line."""
    found = EMPTY_LINE.search(data)
    return (data[: found.start()], data[found.end() :]) if found else (data, b"")


def parse(data: bytes) -> Record:
    """The record that the bytes begin with; ValueError if there is none."""
    head, rest = split_header(data)
    first, _, lines = head.partition(b"\n")
    if not first.startswith(b"WARC/"):
        raise ValueError("no WARC record")
    record = Record(header_lines(lines), b"")
    length = record.get("Content-Length")
    if length is None or not length.isdigit() or int(length) > len(rest):
        raise ValueError("Content-Length does not fit")
    record.block = rest[: int(length)]
    return record


def read_records(data: bytes) -> Iterator[Record]:
    """All records of an uncompressed WARC file."""
    rest = memoryview(data)
    at = 0
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        found = EMPTY_LINE.search(data, at)
        if not found:
            raise ValueError("no WARC record")
        length = Record(header_lines(data[at : found.start()].partition(b"\n")[2]), b"").get("Content-Length")
        end = found.end() + (int(length) if length and length.isdigit() else 0)
        yield parse(bytes(rest[at:end]))
        at = end


def payload(block: bytes) -> tuple[str, list[tuple[str, str]], bytes, bytes]:
    """Status line, HTTP headers, body as sent (what payload digests are of), and the body without transfer and content codings."""
    head, body = split_header(block)
    status, _, lines = head.partition(b"\n")
    headers = header_lines(lines)
    value = {k.lower(): v.lower() for k, v in headers}
    plain = body
    if "chunked" in value.get("transfer-encoding", ""):
        parts, at = [], 0
        while (found := CHUNK.match(body, at)) and int(found[1], 16):
            at = found.end() + int(found[1], 16)
            parts.append(body[found.end() : at])
        plain = b"".join(parts)
    for coding in reversed(value.get("content-encoding", "").replace(" ", "").split(",")):
        try:
            if coding in ("gzip", "x-gzip"):
                plain = zlib.decompressobj(31).decompress(plain)
            elif coding == "deflate":
                plain = zlib.decompressobj(15).decompress(plain)
        except zlib.error:
            break
    return status.decode("latin-1").strip(), headers, body, plain


def decode(body: bytes, content_type: str) -> str:
    named = re.search(r"charset\s*=\s*[\"']?([\w.:-]+)", content_type or "", re.I)
    found = CHARSET.search(body[:4096])
    for name in (named[1] if named else None, found[1].decode("ascii", "ignore") if found else None, "utf-8"):
        try:
            return body.decode(name) if name else body.decode("utf-8")
        except (LookupError, UnicodeDecodeError):
            continue
    return body.decode("utf-8", "replace")


def plain_text(page: str) -> str:
    """All visible text of a page, a block a line."""
    text = TAGS.sub("", BREAKS.sub("\n", HIDDEN.sub("\n", page)))
    lines = (" ".join(line.split()) for line in html.unescape(text).split("\n"))
    return "\n".join(line for line in lines if line)


def capture_key(page_id: int | None, url: str | None, page: str | None) -> str:
    """What a capture's id is made of: its three columns, each null or text."""
    return json.dumps([page_id, url, None if page is None else hashlib.sha256(page.encode("utf-8", "surrogatepass")).hexdigest()])


def response(url: str | None, page: str | None, key: str, date: str) -> Record:
    """A response record of a page kept without its HTTP exchange."""
    body = (page or "").encode("utf-8", "surrogatepass")
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: " + str(len(body)).encode() + END + body
    headers = [("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", key)), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", " ".join(url.split())))
    headers += [("WARC-Payload-Digest", digest(body)), ("WARC-Block-Digest", digest(block)), ("Content-Type", "application/http; msgtype=response"),
                ("Content-Length", str(len(block)))]
    return Record(headers, block)


def derive(source: Record) -> list[tuple]:
    """The rows of SCHEMA for the records derived from one response."""
    status, http, body, plain = payload(source.block)
    http_type = next((v for k, v in http if k.lower() == "content-type"), "")
    own = digest(body)
    stated = source.get("WARC-Payload-Digest")
    textual = not http_type or http_type.lower().startswith("text/") or "html" in http_type.lower() or "xml" in http_type.lower()
    page = decode(plain, http_type) if textual else ""
    markup = "html" in http_type.lower() or "xml" in http_type.lower() or not http_type
    found = TITLE.search(page) if markup else None
    title = " ".join(html.unescape(TAGS.sub("", found[1])).split()) if found else None
    source_id = source.get("WARC-Record-ID") or ""
    rows = []

    def add(kind: str, content_type: str, block: bytes, text: str | None) -> None:
        headers = [("WARC-Type", kind), ("WARC-Record-ID", record_id(kind, source_id)), ("WARC-Date", source.get("WARC-Date") or ""), ("WARC-Refers-To", source_id)]
        for name in ("WARC-Target-URI", "WARC-Warcinfo-ID", "WARC-IP-Address"):
            if source.get(name) is not None:
                headers.append((name, source.get(name)))
        headers += [("WARC-Refers-To-Target-URI", source.get("WARC-Target-URI") or ""), ("WARC-Refers-To-Date", source.get("WARC-Date") or ""),
                    ("WARC-Source-Payload-Digest", stated or own), ("WARC-Block-Digest", digest(block)), ("Content-Type", content_type), ("Content-Length", str(len(block)))]
        made = Record([(k, v) for k, v in headers if v], block)
        rows.append((made.get("WARC-Record-ID"), kind, source_id or None, source.get("WARC-Target-URI"), source.get("WARC-Date"), content_type, stated or own,
                     own == (stated or own), made.get("WARC-Block-Digest"), len(block), title, text, made.data()))

    fields = [("http-status", status), ("http-content-type", http_type), ("payload-length", str(len(body))), ("payload-digest", own), ("title", title or "")]
    fields += [(f"source-{k}", v) for k, v in source.headers] + [(f"source-http-{k}", v) for k, v in http]
    add("metadata", "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields).encode(), None)
    if textual:
        text = plain_text(page) if markup else page
        add("conversion", "text/plain; charset=utf-8", text.encode("utf-8", "surrogatepass"), text)
    return rows


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in NAMES]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, TYPES, strict=True)], names=NAMES)


def derive_records(responses: DataFrame) -> DataFrame:
    """Metadata and conversion records (SCHEMA) of the response records in column ``record`` (binary).

    Records of other types, null records and bytes that are no WARC record have
    no derived records. A response whose payload is not text has metadata only;
    an empty payload has an empty text. Repeated records give repeated rows;
    other columns are left out; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for data in batch.column(0).to_pylist():
                try:
                    source = parse(data or b"")
                except ValueError:
                    continue
                if source.get("WARC-Type") == "response":
                    rows += derive(source)
                if len(rows) >= 1000:
                    yield _batch(rows)
                    rows = []
            yield _batch(rows)

    return pick(responses, record="binary").mapInArrow(run, SCHEMA)


def page_responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Response records (column ``record``) of pages that are kept as rows of page_id, url and html.

    A null page is an empty payload, a null url leaves the address out. The
    record id depends on page_id, url and payload, null apart from any text, so
    different captures have different ids; rows that repeat all three are the
    same capture and share one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([response(url, page, capture_key(key, url, page), date).data() for key, url, page in rows], pa.binary())], names=["record"])

    return pick(pages, page_id="long", url="string", html="string").mapInArrow(run, "record binary")
