"""WARC derivative builder: metadata and conversion records from response records.

A record travels as the bytes it has in a WARC file, one per row, so concatenating the `record` column gives
a valid file. Every response gives two records that name it in WARC-Refers-To: `metadata` (status, HTTP headers,
all headers of the source record, stated and computed digests, title, language and links as warc-fields) and
`conversion` (the page as plain text). Their ids are derived from the source's id, so a task that runs again
gives the same records.

A null, cut or otherwise unreadable record gives one row of kind `unreadable` without record; a record of
another type gives none. A response without HTML in it gives a conversion with an empty text. A body that cannot
be decoded (an encoding other than gzip and deflate, broken or cut data, chunks of no valid size, more than
`most_bytes` when decompressed) is `undecoded`: its metadata record tells all that is known without it, its
conversion is empty. `digest_ok` is false where a stated digest is wrong, and null where one is of an algorithm
other than md5, sha1, sha256 and sha512 and none is wrong. Markup is read in one pass, so the time a page
takes grows with its length alone, whatever tags it leaves open. Repeated records repeat their derivatives, an
empty table gives none. Only the named columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import html as entities
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tallyhouse.llm.work_tables import reach_workers

VERSION = "WARC/1.1"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the standard's one for urls
CRLF = b"\r\n"

#: Bytes that a body may have when it is decompressed, and bytes of derivatives in a batch.
MOST_BYTES, BATCH_BYTES = 1 << 28, 1 << 26

_HIDDEN = re.compile(r"<!--.*?(?:-->|$)|<(script|style|template|noscript)\b.*?(?:</\1\s*>|$)", re.S | re.I)
_BREAK = re.compile(
    r"</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|section|article|header|footer|nav|main|title|body|blockquote|pre|hr)\b",
    re.I,
)
_TAG_START = re.compile(r"<[!?/a-zA-Z]")
_SPACES, _LINES = re.compile(r"[^\S\n]+"), re.compile(r" ?\n[ \n]*")
_TITLE, _TITLE_END = re.compile(r"<title\b", re.I), re.compile(r"</title", re.I)
_HTML, _LANG = re.compile(r"<html\b", re.I), re.compile(r"\blang\s*=\s*[\"']?([A-Za-z0-9-]+)", re.I)
_ANCHOR = re.compile(r"<a\b", re.I)
_HREF = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)')", re.I)
_CHARSET = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9_-]+)", re.I)

DERIVED = (
    "kind string, record_id string, refers_to string, target_uri string, warc_date string, "
    "content_type string, http_status int, http_headers string, source_block_digest string, "
    "source_payload_digest string, digest_ok boolean, block_digest string, length long, "
    "block string, record binary, warc_headers string, payload_state string"
)


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def serialize(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {_one_line(v)}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + 2 * CRLF + block + 2 * CRLF


def _one_line(value: str) -> str:
    return value.replace("\r", " ").replace("\n", " ")


def _fields(head: bytes) -> list[tuple[str, str]]:
    """Header lines; a line that begins with a blank continues the one before."""
    out: list[tuple[str, str]] = []
    for line in head.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
        elif ":" in line:
            name, _, value = line.partition(":")
            out.append((name.strip(), value.strip()))
    return out


def _record(record: bytes) -> tuple[list[tuple[str, str]], bytes]:
    """Headers in their order, and the block. ValueError where the bytes are no whole record."""
    head, found, rest = record.partition(2 * CRLF)
    if not found or not head.startswith(b"WARC/"):
        raise ValueError("no WARC record")
    headers = _fields(head.partition(CRLF)[2])
    length = int(dict((k.lower(), v) for k, v in headers)["content-length"])
    if not 0 <= length <= len(rest):
        raise ValueError("cut record")
    return headers, rest[:length]


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by lower-case name, and the block."""
    headers, block = _record(record)
    return {k.lower(): v for k, v in headers}, block


def _dechunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.find(CRLF, at, at + 1024)
        size = re.fullmatch(rb"\s*([0-9A-Fa-f]{1,8})\s*(?:;.*)?", body[at:end], re.S) if end >= 0 else None
        if not size:
            raise ValueError("no chunk size")
        n = int(size[1], 16)
        if not n:
            return b"".join(out)
        if end + 2 + n > len(body):
            raise ValueError("cut chunk")
        out.append(body[end + 2 : end + 2 + n])
        at = end + 4 + n


def _inflated(data: bytes, window: int, most: int) -> bytes:
    """Decompressed data, members of a gzip file one after the other."""
    out, size = [], 0
    while data:
        stream = zlib.decompressobj(window)
        part = stream.decompress(data, most - size + 1)
        size += len(part)
        if size > most:
            raise ValueError("too long when decompressed")
        if not stream.eof:
            raise ValueError("cut compressed data")
        out.append(part)
        data = stream.unused_data if window > 15 else b""
        if data and not data.startswith(b"\x1f\x8b"):
            break  # padding behind the last member
    return b"".join(out)


def _decoded(body: bytes, encoding: str, most: int) -> bytes:
    if encoding in ("", "identity"):
        return body
    if encoding in ("gzip", "x-gzip"):
        return _inflated(body, 31, most)
    if encoding == "deflate":
        try:
            return _inflated(body, 15, most)
        except zlib.error:
            return _inflated(body, -15, most)
    raise ValueError(f"encoding {encoding}")


def _tags(html: str, start: re.Pattern) -> Iterator[tuple[int, int]]:
    """Places of the tags that begin so, one after the other: from `<` behind the last tag to the next `>`, or to
    the end where none comes."""
    at = 0
    while found := start.search(html, at):
        end = html.find(">", found.end())
        at = len(html) if end < 0 else end + 1
        yield found.start(), at


def html_language(html: str) -> str | None:
    """What the first html tag with a lang says."""
    for a, b in _tags(html, _HTML):
        if found := _LANG.search(html, a, b):
            return found[1]
    return None


def html_title(html: str) -> str | None:
    for _, inside in _tags(html, _TITLE):
        end = _TITLE_END.search(html, inside)
        return " ".join(page_text(html[inside : end.start()]).split()) if end else None
    return None


def html_links(html: str) -> list[str]:
    found = (_HREF.search(html, a, b) for a, b in _tags(html, _ANCHOR))
    return [entities.unescape(f[1] if f[1] is not None else f[2]) for f in found if f]


def page_text(html: str) -> str:
    """Visible text: no scripts, styles or comments; blocks and line breaks end lines. What is behind a tag that
    never ends is text."""
    html = _HIDDEN.sub("", html.replace("\r", "\n").replace("\n", " "))
    out, at = [], 0
    for a, b in _tags(html, _TAG_START):
        if html[b - 1] != ">":
            break
        out += [html[at:a], "\n" if _BREAK.match(html, a) else ""]
        at = b
    text = _SPACES.sub(" ", entities.unescape("".join(out) + html[at:]))
    return _LINES.sub("\n", text).strip(" \n")


class _Response:
    """Status, headers and payload of an HTTP response: as sent, without chunks, and as it reads."""

    def __init__(self, block: bytes, most: int) -> None:
        head, _, self.sent = block.partition(2 * CRLF)
        status, _, lines = head.partition(CRLF)
        code = re.match(rb"HTTP/\S+\s+(\d{3})", status)
        self.status = int(code[1]) if code else None
        self.headers = _fields(lines)
        named = {k.lower(): v.strip().lower() for k, v in self.headers}
        self.type = next((v for k, v in self.headers if k.lower() == "content-type"), "")
        self.entity, self.body, self.state = self.sent, b"", "whole"
        try:
            if "chunked" in named.get("transfer-encoding", ""):
                self.entity = _dechunked(self.sent)
            self.body = _decoded(self.entity, named.get("content-encoding", ""), most)
        except (ValueError, zlib.error):
            self.state = "undecoded"

    def text(self) -> str:
        charset = _CHARSET.search(self.type) or _CHARSET.search(self.body[:1024].decode("ascii", "replace"))
        try:
            return self.body.decode(charset[1] if charset else "utf-8", "replace")
        except (LookupError, UnicodeError):
            return self.body.decode("utf-8", "replace")


def _states(stated: str | None, *contents: bytes) -> bool | None:
    """Whether a stated digest is that of one of the contents; null for an algorithm that is not known."""
    if stated is None:
        return True
    name, _, value = stated.partition(":")
    name, value = name.strip().lower().replace("-", ""), value.strip().rstrip("=").lower()
    if name not in ("md5", "sha1", "sha256", "sha512"):
        return None
    for content in contents:
        own = hashlib.new(name, content)
        if value in (own.hexdigest(), base64.b32encode(own.digest()).decode().rstrip("=").lower()):
            return True
    return False


def derive_record(record: bytes, most_bytes: int = MOST_BYTES) -> list[tuple]:
    """The two derivatives of a response record, as rows of DERIVED; none for another type."""
    source_headers, block = _record(record)
    headers = {k.lower(): v for k, v in source_headers}
    if headers.get("warc-type", "").lower() != "response":
        return []
    source = headers["warc-record-id"]
    uri, date = headers.get("warc-target-uri", ""), headers.get("warc-date", "")
    response = _Response(block, most_bytes)
    payload_digest, block_digest = digest(response.sent), digest(block)
    stated = (
        _states(headers.get("warc-payload-digest"), response.sent, response.entity),
        _states(headers.get("warc-block-digest"), block),
    )
    sound = False if False in stated else None if None in stated else True
    html = response.text() if response.state == "whole" else ""
    markup = "html" in response.type.lower() or not response.type
    lines = [
        ("http-status", str(response.status or "")),
        *((f"http-{k.lower()}", v) for k, v in response.headers),
        *((f"source-{k.lower()}", v) for k, v in source_headers),
        ("computed-payload-digest", payload_digest),
        ("computed-block-digest", block_digest),
        ("digest-ok", "unchecked" if sound is None else str(sound).lower()),
        ("payload-state", response.state),
    ]
    if markup:
        title, language = html_title(html), html_language(html)
        lines += [(name, value) for name, value in (("title", title), ("language", language)) if value is not None]
        lines += [("outlink", link) for link in html_links(html)]
    fields = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in lines)
    text = page_text(html) if markup else html if response.type.lower().startswith("text/") else ""
    kept_headers, kept_source = ("\n".join(f"{k}: {v}" for k, v in h) for h in (response.headers, source_headers))
    out = []
    for kind, media, content in (
        ("metadata", "application/warc-fields", fields),
        ("conversion", "text/plain; charset=utf-8", text),
    ):
        data = content.encode("utf-8", "replace")
        own_id = f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{source} {kind}')}>"
        written = [
            ("WARC-Type", kind),
            ("WARC-Record-ID", own_id),
            ("WARC-Date", date),
            ("WARC-Target-URI", uri),
            ("WARC-Refers-To", source),
            ("WARC-Block-Digest", digest(data)),
            ("Content-Type", media),
        ]
        out.append(
            (kind, own_id, source, uri, date, media, response.status, kept_headers, block_digest,
             payload_digest, sound, digest(data), len(data), content, serialize(written, data),
             kept_source, response.state)
        )
    return out


def responses(
    pages: DataFrame, *, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
    date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Pages as response records: the id, and `record` bytes. A null page is one with an empty payload."""
    reach_workers(pages.sparkSession)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records = []
            for key, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = (html or "").encode("utf-8", "replace")
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}"
                block = head.encode() + 2 * CRLF + payload
                record_id = uuid.uuid5(NAMESPACE, f"{url} {key} {digest(payload)}")
                headers = [
                    ("WARC-Type", "response"),
                    ("WARC-Record-ID", f"<urn:uuid:{record_id}>"),
                    ("WARC-Date", date),
                    ("WARC-Target-URI", url or ""),
                    ("WARC-Payload-Digest", digest(payload)),
                    ("WARC-Block-Digest", digest(block)),
                    ("Content-Type", "application/http; msgtype=response"),
                ]
                records.append(serialize(headers, block))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(records, pa.binary())], names=[id_column, "record"]
            )

    kind = pages.schema[id_column].dataType.simpleString()
    chosen = pages.select(id_column, url_column, html_column)
    return chosen.mapInArrow(build, f"`{id_column}` {kind}, record binary")


def derivatives(
    records: DataFrame, *, id_column: str, record_column: str = "record", most_bytes: int = MOST_BYTES
) -> DataFrame:
    """Two rows for each response record, under its id: see DERIVED for the columns."""
    reach_workers(records.sparkSession)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows, size = [], [], 0

            def made() -> pa.RecordBatch:
                columns = list(zip(*rows, strict=True)) or [()] * len(_NAMES)
                arrays = [pa.array(c, k) for c, k in zip(columns, _ARROW, strict=True)]
                return pa.RecordBatch.from_arrays(
                    [pa.array(ids, batch.schema.field(0).type), *arrays], names=[id_column, *_NAMES]
                )

            for key, record in zip(batch.column(0).to_pylist(), batch.column(1)):
                try:
                    derived = derive_record(record.as_py() or b"", most_bytes)
                except (ValueError, KeyError):
                    derived = [("unreadable", *[None] * (len(_NAMES) - 1))]
                rows += derived
                ids += [key] * len(derived)
                size += sum(len(row[_RECORD] or b"") for row in derived)
                if size >= BATCH_BYTES:
                    yield made()
                    ids, rows, size = [], [], 0
            yield made()

    kind = records.schema[id_column].dataType.simpleString()
    chosen = records.select(id_column, record_column)
    return chosen.mapInArrow(build, f"`{id_column}` {kind}, {DERIVED}")


_NAMES = [c.split()[0] for c in DERIVED.split(", ")]
_RECORD = _NAMES.index("record")
_KINDS = {
    "string": pa.string(),
    "int": pa.int32(),
    "long": pa.int64(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
}
_ARROW = [_KINDS[c.split()[1]] for c in DERIVED.split(", ")]
