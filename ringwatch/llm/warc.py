"""WARC derivatives: metadata and plain-text conversion records from response records.

A response record gives two records that refer to it: a ``metadata`` record with
what its headers and page say (status, type, title, language, links), and a
``conversion`` record with its plain text. Both name the response in
WARC-Refers-To, keep its target URI and date, and carry their own block digest
beside the response's payload digest; the source's HTTP headers are preserved in
the metadata record. Record ids are name-based UUIDs of the response id and the
kind, so a repeated run gives the same records.

Records are gzip members, one each, gathered into files of ``FILE_RECORDS``
records' worth of one task; a file is a table row (name, content) that Spark
writes and reads, with an index of (offset, length) per record.
"""

from __future__ import annotations

import base64
import hashlib
import html as html_entities
import json
import re
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringwatch.llm.common import arrow, scratch, session
from ringwatch.llm.packing import ddl

FILE_BYTES = 4 << 20
GZIP_LEVEL = 2
VERSION = "WARC/1.1"
SPACE_ID = uuid.uuid5(uuid.NAMESPACE_URL, "urn:ringwatch:warc")
#: Date of responses whose source names none.
NO_DATE = "1970-01-01T00:00:00Z"

FILES = pa.schema([("name", pa.string()), ("content", pa.binary()), ("index", pa.string())])
RECORDS = pa.schema([("page_id", pa.int64()), ("warc_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()),
                     ("target_uri", pa.string()), ("warc_date", pa.string()), ("content_type", pa.string()),
                     ("content_length", pa.int64()), ("block_digest", pa.string()), ("payload_digest", pa.string()),
                     ("digests_hold", pa.bool_()), ("source_headers", pa.string()), ("text", pa.string())])


def digest(raw: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def record_id(*names: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE_ID, '|'.join(names))}>"


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record: version, named fields, block, two line ends. Line ends in a field's value become spaces."""
    head = "".join(f"{k}: {' '.join(v.splitlines())}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return f"{VERSION}\r\n{head}\r\n".encode("utf-8", "replace") + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(fields, block) of one record; field names in lower case."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    length = int(fields["content-length"])
    if len(rest) < length:
        raise ValueError("record cut short")
    return fields, rest[:length]


def response_record(page_id: int | None, url: str, page: str) -> bytes:
    """The response record of a stored page: HTTP headers and HTML, ids from address and content."""
    payload = page.encode("utf-8", "replace")
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
             f"X-Page-Id: {'' if page_id is None else page_id}\r\n\r\n").encode() + payload
    return record([("WARC-Type", "response"), ("WARC-Record-ID", record_id("response", str(page_id), url, digest(payload))),
                   ("WARC-Date", NO_DATE), ("WARC-Target-URI", url), ("Content-Type", "application/http; msgtype=response"),
                   ("WARC-Block-Digest", digest(block)), ("WARC-Payload-Digest", digest(payload))], block)


_HIDDEN = re.compile(r"<!--|<(script|style|noscript|template|svg)\b", re.I)
_CLOSER = {"": re.compile("-->"), **{k: re.compile(rf"</{k}\s*>", re.I) for k in ("script", "style", "noscript", "template", "svg")}}
_BREAK = re.compile(r"</?(?:p|div|br|li|ul|ol|h[1-6]|tr|table|section|article|header|footer|nav|main|aside|blockquote|pre|title|head|body|html)\b[^>]*>", re.I)
_TAG = re.compile(r"<[A-Za-z/!?][^>]*>")
_BLANK = re.compile(r"[ \t\r\x0b\x0c\xa0]{2,}|[\t\r\x0b\x0c\xa0]")  # single spaces stay as they are
_TITLE = re.compile(r"<title[^>]*>", re.I)
_HTML = re.compile(r"<html\b[^>]*>", re.I)
_LANG = re.compile(r"\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
_ANCHOR = re.compile(r"<a\b[^>]*>", re.I)
_HREF = re.compile(r"\bhref\s*=\s*", re.I)
_BARE = re.compile(r"[^\s>]+")


def visible(page: str) -> str:
    """``page`` with a space for every comment and every element whose content is not shown. One forward scan: an
    opener without a closer behind it is left as it stands, and so are all later ones of its kind."""
    out, at, look, unclosed = [], 0, 0, set()
    while m := _HIDDEN.search(page, look):
        kind, look = (m[1] or "").lower(), m.end()
        if kind in unclosed:
            continue
        inner = look if not kind else page.find(">", look) + 1
        closer = _CLOSER[kind].search(page, inner) if inner else None
        if closer is None:
            unclosed.add(kind)
            continue
        out += page[at:m.start()], " "
        at = look = closer.end()
    return "".join([*out, page[at:]])


def _tags_to(pattern: re.Pattern, new: str, page: str) -> str:
    """Every tag of ``pattern`` replaced. Beyond the last ``>`` no tag ends, so nothing there is tried."""
    cut = page.rfind(">") + 1
    return pattern.sub(new, page[:cut]) + page[cut:]


def plain_text(page: str) -> str:
    """Visible text: no scripts, styles or comments; a line per block element; entities resolved. Openers that nothing
    closes are taken as tags if a ``>`` follows and as text if none does; the time is linear in the page's length."""
    page = _tags_to(_TAG, "", _tags_to(_BREAK, "\n", visible(page)))
    if "&" in page:
        page = html_entities.unescape(page)
    return "\n".join(line for line in (_BLANK.sub(" ", x).strip() for x in page.split("\n")) if line)


def title_of(page: str) -> str:
    m = _TITLE.search(page, 0, page.rfind(">") + 1)
    if not m:
        return ""
    end = page.find("<", m.end())
    return html_entities.unescape(page[m.end():end if end >= 0 else len(page)]).strip()


def lang_of(page: str) -> str:
    for tag in _HTML.finditer(page, 0, page.rfind(">") + 1):
        if found := _LANG.findall(tag[0]):
            return found[-1]
    return ""


def links_of(page: str) -> list[str]:
    """The last href of every anchor tag; a quoted value may hold ``>``, one whose quote is not closed ends at a blank."""
    out, missing, free = [], set(), 0
    for tag in _ANCHOR.finditer(page, 0, page.rfind(">") + 1):
        found = [m.end() for m in _HREF.finditer(tag[0])] if tag.start() >= free else []
        if not found:
            continue
        at = tag.start() + found[-1]
        quote = page[at:at + 1]
        if quote in "\"'" and quote not in missing:
            end = page.find(quote, at + 1)
            if end >= 0:
                out.append(page[at + 1:end])
                free = end
                continue
            missing.add(quote)
        if m := _BARE.match(page, at):
            out.append(m[0])
    return out


def http_parts(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """(status line, headers in order, payload) of an HTTP response; without a header end all of it is payload."""
    head, found, payload = block.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"HTTP/"):
        return "", [], block
    lines = head.decode("utf-8", "replace").split("\r\n")
    return lines[0], [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines[1:])], payload


_CHARSET = re.compile(r"charset\s*=\s*[\"']?([A-Za-z0-9_.:-]+)", re.I)


def decoded(payload: bytes, headers: list[tuple[str, str]]) -> str:
    """The payload by the charset that its Content-Type names; UTF-8 if it names none or none that is known."""
    for name, value in headers:
        if name.lower() == "content-type" and (m := _CHARSET.search(value)):
            try:
                return payload.decode(m[1], "replace")
            except (LookupError, UnicodeError):  # unknown, or no charset of texts
                break
    return payload.decode("utf-8", "replace")


def derive(response: bytes) -> tuple[bytes, bytes]:
    """(metadata record, conversion record) of a response record."""
    fields, block = parse(response)
    status, headers, payload = http_parts(block)
    page = decoded(payload, headers)
    source, target = fields["warc-record-id"], fields.get("warc-target-uri", "")
    date, payload_digest = fields.get("warc-date", NO_DATE), fields.get("warc-payload-digest") or digest(payload)
    linked = [("WARC-Date", date), ("WARC-Target-URI", target), ("WARC-Refers-To", source),
              ("WARC-Source-Payload-Digest", payload_digest), ("WARC-Source-Block-Digest", fields.get("warc-block-digest") or digest(block))]
    # A name may come several times (Set-Cookie, Link): the object holds its last value, the lines hold all in order.
    about = json.dumps({"status": status, "http-headers": dict(headers), "http-header-lines": headers, "title": title_of(page),
                        "lang": lang_of(page), "links": links_of(page)}, ensure_ascii=False).encode("utf-8", "replace")
    text = plain_text(page).encode("utf-8", "replace")
    make = lambda kind, content, block: record(
        [("WARC-Type", kind), ("WARC-Record-ID", record_id(kind, source)), *linked, ("Content-Type", content),
         ("WARC-Block-Digest", digest(block))], block)
    return make("metadata", "application/json", about), make("conversion", "text/plain; charset=utf-8", text)


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, record): a response record per page; null addresses and pages count as empty."""
    session(pages.sparkSession)
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.coalesce(F.col(f"`{url_col}`"), F.lit("")).alias("url"),
                        F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"))
    schema = pa.schema([("page_id", pa.int64()), ("record", pa.binary())])

    def run(batches):
        for batch in batches:
            made = [response_record(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")))]
            yield arrow(schema, page_id=batch.column("page_id"), record=made)

    return rows.mapInArrow(run, "page_id long, record binary")


def write_derivatives(records: DataFrame, folder: str) -> str:
    """Derive from (page_id, record) rows and write the files' table to ``folder``."""

    def run(batches):
        task, count, content, index, at = TaskContext.get().partitionId(), 0, [], [], 0

        def close():
            return arrow(FILES, name=[f"derived-{task:06d}-{count:05d}.warc.gz"], content=[b"".join(content)], index=[json.dumps(index)])

        for batch in batches:
            for page_id, response in zip(batch.column("page_id").to_pylist(), batch.column("record").to_pylist()):
                for raw in derive(response):
                    packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
                    member = packer.compress(raw) + packer.flush()
                    content.append(member)
                    index.append([page_id, at, len(member)])
                    at += len(member)
                if at >= FILE_BYTES:
                    yield close()
                    count, content, index, at = count + 1, [], [], 0
        if content:
            yield close()

    records.mapInArrow(run, ddl(FILES)).write.option("compression", "uncompressed").parquet(folder)
    return folder


def read_derivatives(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the files, found by the index, parsed, its block digest recomputed."""

    def run(batches):
        for batch in batches:
            for content, index in zip(batch.column("content").to_pylist(), batch.column("index").to_pylist()):
                out = {n: [] for n in RECORDS.names}
                for page_id, at, length in json.loads(index):
                    fields, block = parse(zlib.decompress(content[at:at + length], 31))
                    about = json.loads(block) if fields["warc-type"] == "metadata" else None
                    row = (page_id, fields["warc-type"], fields["warc-record-id"], fields["warc-refers-to"], fields["warc-target-uri"],
                           fields["warc-date"], fields["content-type"], len(block), fields["warc-block-digest"],
                           fields["warc-source-payload-digest"], digest(block) == fields["warc-block-digest"],
                           json.dumps(about["http-headers"], sort_keys=True) if about else None,
                           None if about else block.decode("utf-8"))
                    for n, v in zip(RECORDS.names, row):
                        out[n].append(v)
                yield arrow(RECORDS, **out)

    return session(spark).read.schema(ddl(FILES)).parquet(folder).mapInArrow(run, ddl(RECORDS))


def derivatives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Two rows per page, read back from the written files: its metadata and its conversion record.

    A null or empty page gives records with empty text. Rows that repeat id,
    address and page give equal records; pages of a null id share only what
    their address and content share. Very long and broken pages take time in
    proportion to their length. Other columns are not read. An empty table gives
    an empty result.
    """
    spark = pages.sparkSession
    return read_derivatives(spark, write_derivatives(responses(pages, id_col, url_col, html_col), scratch(spark, "warc")))
