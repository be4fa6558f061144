from __future__ import annotations

import gzip
import random
import time
import zlib
from html.parser import HTMLParser

import pytest

from tallyhouse.llm.warc import _dechunked, html_language, html_links, html_title
from tallyhouse.llm.warc import derivatives, derive_record, digest, page_text, parse, responses, serialize


def response(block: bytes, **more) -> bytes:
    headers = {"WARC-Type": "response", "WARC-Record-ID": "<urn:uuid:1>", "WARC-Target-URI": "http://x/", **more}
    return serialize(list(headers.items()), block)


def test_page_text():
    html = "<title>A &amp; B</title><script>no()</script><p>one\n two<br>three</p><!-- c --><style>x"
    assert page_text(html) == "A & B\none two\nthree"
    assert page_text("1 < 2 and 3 > 2") == "1 < 2 and 3 > 2"


def test_round_trip_and_links(spark):
    html = '<html lang="fr"><title>T</title><a href="/a?x=1&amp;y=2">é</a></html>'
    rows = [(1, "http://x/é", html, "other"), (2, None, None, ""), (2, None, None, ""), (None, "u", "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record string")
    records = responses(pages)
    sources = {}
    for r in records.collect():
        headers, block = parse(bytes(r.record))
        assert headers["warc-block-digest"] == digest(block)
        sources[headers["warc-record-id"]] = headers
    got = derivatives(records, id_column="page_id").collect()
    assert sorted(r.kind for r in got) == ["conversion"] * 4 + ["metadata"] * 4
    for r in got:
        headers, block = parse(bytes(r.record))
        source = sources[r.refers_to]
        assert headers["warc-refers-to"] == r.refers_to and headers["warc-type"] == r.kind
        assert headers["warc-record-id"] == r.record_id and headers["warc-date"] == source["warc-date"]
        assert headers["warc-block-digest"] == r.block_digest == digest(block) and block.decode() == r.block
        assert r.source_payload_digest == source["warc-payload-digest"] and r.digest_ok
        assert r.length == len(block) and r.http_status == 200
    first = {r.kind: r for r in got if r.page_id == 1}
    assert first["conversion"].block == "T\né"
    assert "outlink: /a?x=1&y=2\r\n" in first["metadata"].block
    assert "language: fr\r\n" in first["metadata"].block and "http-content-type: text/html" in first["metadata"].block
    again = derivatives(records, id_column="page_id").collect()
    assert {r.record_id for r in got} == {r.record_id for r in again}


def test_encoded_bodies_and_false_digests():
    body = gzip.compress(b"<p>hi</p>")
    chunked = b"%x\r\n%s\r\n0\r\n\r\n" % (len(body), body)
    head = b"HTTP/1.1 404 No\r\nContent-Type: text/html\r\nContent-Encoding: gzip\r\nTransfer-Encoding: chunked\r\n\r\n"
    rows = derive_record(response(head + chunked, **{"WARC-Payload-Digest": "sha1:WRONG"}))
    assert rows[1][13] == "hi" and rows[1][6] == 404 and rows[1][10] is False
    image = derive_record(response(b"HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n\x89PNG"))
    assert image[1][13] == ""


def test_unreadable_and_other_records(spark):
    whole = response(b"HTTP/1.1 200 OK\r\n\r\nx")
    other = serialize([("WARC-Type", "request"), ("WARC-Record-ID", "<a>")], b"GET /")
    rows = [(1, None), (2, b""), (3, b"junk"), (4, whole[:-20]), (5, other), (6, whole)]
    records = spark.createDataFrame(rows, "page_id long, record binary")
    kinds = sorted((r.page_id, r.kind) for r in derivatives(records, id_column="page_id").collect())
    assert kinds == [(1, "unreadable"), (2, "unreadable"), (3, "unreadable"), (4, "unreadable"), (6, "conversion"), (6, "metadata")]
    assert derivatives(records.limit(0), id_column="page_id").count() == 0


def _derived(head: bytes, body: bytes, most_bytes: int = 1 << 20, **more):
    return derive_record(response(b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n" + head + b"\r\n" + body, **more), most_bytes)


def test_bodies_that_cannot_be_decoded_keep_their_metadata():
    good = gzip.compress(b"<p>hi</p>")
    bad = {
        b"Content-Encoding: br\r\n": b"\x0b\x02\x80hi",
        b"Content-Encoding: gzip\r\n": good[:-6],
        b"Content-Encoding: gzip \r\nX: y\r\n": b"no gzip at all",
        b"Transfer-Encoding: chunked\r\n": b"-6\r\nabcdef",
        b"Transfer-Encoding: chunked\r\nX: y\r\n": b"ff\r\nshort\r\n0\r\n\r\n",
    }
    for head, body in bad.items():
        metadata, conversion = _derived(head, body)
        assert metadata[-1] == conversion[-1] == "undecoded" and conversion[13] == ""
        assert "payload-state: undecoded\r\n" in metadata[13] and "http-content-type: text/html" in metadata[13]
    for size in (b"-6", b"0x6", b"+6", b"", b"6 6", b"fffffffffffffffff"):
        with pytest.raises(ValueError):
            _dechunked(size + b"\r\nabcdef\r\n0\r\n\r\n")
    bomb = gzip.compress(bytes(4 << 20))
    assert _derived(b"Content-Encoding: gzip\r\n", bomb)[0][-1] == "undecoded"
    assert _derived(b"Content-Encoding: gzip\r\n", bomb, 8 << 20)[0][-1] == "whole"
    assert _derived(b"Content-Encoding: gzip\r\n", good + good)[1][13] == "hi\nhi"
    raw = zlib.compressobj(wbits=-15)
    assert _derived(b"Content-Encoding: deflate\r\n", raw.compress(b"<p>hi") + raw.flush())[1][13] == "hi"


def test_source_headers_and_stated_digests_are_preserved():
    more = {"WARC-IP-Address": "10.0.0.1", "WARC-Payload-Digest": "sha256:" + "0" * 64, "WARC-Date": "2020-01-01T00:00:00Z"}
    metadata, _ = _derived(b"", b"x", **more)
    for name, value in more.items():
        assert f"source-{name.lower()}: {value}\r\n" in metadata[13] and f"{name}: {value}" in metadata[-2]
    assert metadata[10] is False
    import hashlib

    right = "sha256:" + hashlib.sha256(b"x").hexdigest()
    assert _derived(b"", b"x", **{"WARC-Payload-Digest": right})[0][10] is True
    assert _derived(b"", b"x", **{"WARC-Payload-Digest": "crc32:00000000"})[0][10] is None


@pytest.mark.parametrize("opened", ["<a ", "<title>", "<html ", "<p ", "<!-- ", "<script>", "<a href='", "</title", "href=\"", "<"])
def test_markup_that_never_ends_takes_linear_time(opened):
    page = opened * (10_000_000 // len(opened))
    for read in (html_title, html_language, html_links):
        began = time.monotonic()
        read(page)
        assert time.monotonic() - began < 1, read
    began = time.monotonic()
    page_text(page)
    assert time.monotonic() - began < 6


class Reader(HTMLParser):
    """An independent extractor."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.links, self.title, self.language, self.inside = [], [], None, None, None

    def handle_starttag(self, tag, attributes):
        named = dict(attributes)
        if tag == "a" and named.get("href") is not None:
            self.links.append(named["href"])
        if tag == "html" and self.language is None:
            self.language = named.get("lang")
        if tag in ("p", "div", "br", "li", "title", "h1", "td_"):
            self.out.append("\n")
        self.inside = tag if tag in ("title", "script", "style") else self.inside

    def handle_endtag(self, tag):
        if tag in ("p", "div", "li", "title", "h1"):
            self.out.append("\n")
        self.inside = None

    def handle_data(self, data):
        if self.inside == "title" and self.title is None:
            self.title = " ".join(data.split())
        if self.inside not in ("script", "style"):
            self.out.append(data.replace("\n", " "))


def test_against_an_independent_extractor():
    draw = random.Random(5)
    pieces = ["text ", "a &lt; b ", "<p>", "</p>", "<div class='x'>", "</div>", "<br>", "\n", "<b>", "</b>", "é&amp;", "<li>one</li>"]
    pieces += ['<a href="/x?a=1&amp;b=2">go</a>', "<a class=c href='u'>u</a>", "<a name=n>n</a>", "<script>if (1) no()</script>", "<!-- no -->"]
    for _ in range(200):
        page = f'<html lang="{draw.choice(["en", "de-AT"])}"><title>A &amp; B {draw.random()}</title>' + "".join(draw.choices(pieces, k=40))
        reader = Reader()
        reader.feed(page)
        reader.close()
        lines = [" ".join(line.split()) for line in "".join(reader.out).split("\n")]
        assert page_text(page).split("\n") == [line for line in lines if line]
        assert html_links(page) == reader.links
        assert (html_title(page), html_language(page)) == (reader.title, reader.language)
