import json
import random
import re
import time
from html.parser import HTMLParser

import pytest

from ringwatch.llm import warc as W
from tests.llm.fixtures import corner, docs, prose  # noqa: F401

SCHEMA = "page_id long, url string, html string, record string, name string"
PAGE = ('<!DOCTYPE html><html lang="fr"><head><title>A &amp; B</title><style>p{x}</style><script>var t="</p>";</script></head>'
        '<body><!-- ad --><h1>A &amp; B</h1><p>One  <b>two</b>.<br>3 &lt; 4 &eacute;</p><a href="/x">l</a><a href=\'y\'>m</a></body></html>')


def test_plain_text():
    assert W.plain_text(PAGE).split("\n") == ["A & B", "A & B", "One two.", "3 < 4 é", "lm"]
    assert W.plain_text("") == "" and W.plain_text("a < b and c > d") == "a < b and c > d"
    assert W.plain_text("<script>x") == "x"


class Reader(HTMLParser):
    """Independent reading of well-formed pages: text outside hidden elements, a line per block element, links."""
    BLOCK = {"p", "div", "br", "li", "ul", "h1", "h2", "title", "head", "body", "html"}

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.hidden, self.parts, self.links = 0, [], []
        self.feed(page)
        self.close()
        self.text = "\n".join(x for x in (re.sub(r"[ \t]+", " ", y).strip() for y in "".join(self.parts).split("\n")) if x)

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")
        self.parts += ["\n"] * (tag in self.BLOCK)
        self.links += [v for k, v in attrs if tag == "a" and k == "href"]

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.hidden -= 1
            self.parts.append(" ")  # what is not shown separates words
        self.parts += ["\n"] * (tag in self.BLOCK)

    def handle_comment(self, data):
        self.parts.append(" ")

    def handle_data(self, data):
        self.parts += [data] * (not self.hidden)


def test_text_and_links_as_an_html_parser_reads_them():
    r = random.Random(2)
    for _ in range(200):
        parts = []
        for _ in range(r.randint(1, 30)):
            t = r.choice(("p", "div", "li", "b", "i", "h1", "span"))
            parts.append(r.choice((f"<{t}>{prose(r.randint(0, 99), 4)}</{t}>", f"<{t.upper()} class='x y'> caf&eacute; &amp; 1 &lt; 2</{t}>\n", "<br/>",
                                   "<!-- a <b>c</b> -- d -->", "<script>if (a < b) { x = '<p>'; }</script>", "<STYLE>p > b {}</STYLE >", "plain ",
                                   f'<a class="k" href="/u{r.randint(0, 9)}">l</a>', "<a href=\'v w\'>m</a>", "<a href=bare>n</a>", "<a name=z>o</a>")))
        page = f"<html><head><title>T</title></head><body>{''.join(parts)}</body></html>"
        want = Reader(page)
        assert W.plain_text(page) == want.text
        assert W.links_of(page) == want.links


@pytest.mark.parametrize("broken", ["<!--", "<script>", "<script", "<a<a", "<title", "<html lang", "<a href=\"x", "<p", "<!--<script><style><svg>", "<a href='>"])
@pytest.mark.parametrize("end", ["", ">"])
def test_broken_pages_take_linear_time(broken, end):
    page = broken * (2_000_000 // len(broken)) + end
    start = time.process_time()
    W.plain_text(page), W.title_of(page), W.lang_of(page), W.links_of(page)
    assert time.process_time() - start < 8


def test_broken_pages():
    assert W.plain_text("a <!-- b") == "a <!-- b" and W.plain_text("a <!-- b> c") == "a c"
    assert W.plain_text("<style>x <script>y</script> z") == "x z"
    assert W.plain_text("one <b two") == "one <b two"
    assert W.links_of('<a href="a>b">x</a><a href="open>y') == ["a>b", '"open']
    assert W.title_of("<title>T") == "T" and W.title_of("<title") == ""


def test_repeated_headers_and_charsets():
    payload = "<p>café €</p>"
    for charset, codec in (("ISO-8859-15", "iso-8859-15"), ('"utf-8"', "utf-8"), ("windows-1252", "cp1252"), ("none-such", "utf-8"), ("hex", "utf-8")):
        block = (f"HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nContent-Type: text/html; charset={charset}\r\nSet-Cookie: b=2\r\n\r\n").encode() + payload.encode(codec)
        meta, conversion = (W.parse(x) for x in W.derive(W.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>")], block)))
        assert conversion[1].decode() == "café €"
        lines = json.loads(meta[1])["http-header-lines"]
        assert [v for k, v in lines if k == "Set-Cookie"] == ["a=1", "b=2"] and lines[1][0] == "Content-Type"


def test_records_parse_back():
    raw = W.record([("WARC-Type", "x"), ("A", "b: c\r\nd")], b"\r\n\r\nblock\x00\r\n\r\n")
    fields, block = W.parse(raw)
    assert fields["a"] == "b: c d" and block == b"\r\n\r\nblock\x00\r\n\r\n"
    with pytest.raises(ValueError):
        W.parse(raw[:-12])
    with pytest.raises(ValueError):
        W.parse(b"HTTP/1.1 200\r\n\r\n")


def test_derived_records_refer_to_their_response():
    response = W.response_record(3, "http://a/b?c", PAGE)
    source, block = W.parse(response)
    meta, conversion = (W.parse(r) for r in W.derive(response))
    for fields, own in (meta, conversion):
        assert fields["warc-refers-to"] == source["warc-record-id"] != fields["warc-record-id"]
        assert fields["warc-target-uri"] == "http://a/b?c" and fields["warc-date"] == source["warc-date"]
        assert fields["warc-source-payload-digest"] == source["warc-payload-digest"]
        assert fields["warc-block-digest"] == W.digest(own)
    assert source["warc-block-digest"] == W.digest(block)
    about = json.loads(meta[1])
    assert about["title"] == "A & B" and about["lang"] == "fr" and about["links"] == ["/x", "y"]
    assert about["http-headers"]["Content-Type"] == "text/html; charset=utf-8" and about["status"].endswith("200 OK")
    assert conversion[1].decode() == W.plain_text(PAGE)


def test_response_without_http_headers_or_digests():
    raw = W.record([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:x>")], b"<p>plain")
    meta, conversion = (W.parse(r) for r in W.derive(raw))
    assert conversion[1] == b"plain" and meta[0]["warc-source-payload-digest"] == W.digest(b"<p>plain")


def test_files_round_trip(spark, monkeypatch):
    monkeypatch.setattr(W, "FILE_BYTES", 2000)
    rows = [(i, f"http://h/{i}", PAGE + "<p>" + "w " * i, "r", "n") for i in range(40)]
    rows += [(100, None, None, None, None), (101, "", "", None, None), (None, "u\r\nX: y", "日本 <b>é", None, None), (1, "http://h/1", rows[1][2], "r", "n"),
             (102, "u", "x" * 400_000, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    out = W.derivatives(df).collect()
    assert len(out) == 2 * len(rows) and all(r.digests_hold for r in out)
    text = {}
    for r in out:
        if r.warc_type == "conversion":
            text.setdefault(r.page_id, set()).add(r.text)
            assert r.content_length == len(r.text.encode())
        else:
            assert json.loads(r.source_headers)["X-Page-Id"] == ("" if r.page_id is None else str(r.page_id))
    assert text == {i: {W.plain_text(h or "")} for i, _, h, _, _ in rows}
    ids = {(r.page_id, r.warc_type): r.record_id for r in out}
    assert len(set(ids.values())) == len(ids)


def test_empty_table(spark):
    assert W.derivatives(spark.createDataFrame([], SCHEMA)).count() == 0
