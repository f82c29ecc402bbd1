"""WARC derivatives (operator 3): from response records to linked metadata and
plain-text conversion records.

``responses`` reads a table of pages as WARC response records (HTTP head and
payload); ``derive`` makes two records of each: ``metadata``
(``application/warc-fields``: title, language, charset, the source's HTTP
headers, its digest, the links) and ``conversion`` (``text/plain``: the
visible text). Both refer to the response by its record id, keep its URI and
date, and carry SHA-1 block digests in base 32. Record ids are name-based
(UUID version 5), so a rerun after a lost executor gives the same records.
``write`` stores records as WARC/1.1 files by Spark's own text writer, so they
can go to any storage that Spark reaches.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL name space of RFC 4122
_SILENT = ("script", "style", "template", "noscript")  # elements whose content is not read
_BREAKS = frozenset("address article aside blockquote br dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr "
                    "li main nav ol p pre section table td th title tr ul".split())  # elements that end a line
_CLOSED = {name: re.compile(rf"</{name}\s*>", re.I) for name in _SILENT}
_NAME = re.compile(r"</?([A-Za-z][\w]*)")
_LANG = re.compile(r"\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
_CHARSET = re.compile(r"\bcharset\s*=\s*[\"']?([\w-]+)", re.I)
_HREF = re.compile(r"\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_BLANKS = re.compile(r"[ \t\r\f\v ]+")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, chr(0).join(parts))}>"


def one_line(text: str) -> str:
    return " ".join(text.split())


def scan(payload: str):
    """``(kind, name, start, end)`` of the pieces of a page, in order: ``text``,
    ``open`` and ``close`` tags by name, and ``silent`` pieces (comments, and
    scripts and the like with their content). Every character is visited a
    bounded number of times: the search for an end goes forward only, and a
    piece without an end takes the rest of the page."""
    at, size = 0, len(payload)
    while at < size:
        start = payload.find("<", at)
        if start < 0:
            yield "text", "", at, size
            return
        if start > at:
            yield "text", "", at, start
        if payload.startswith("<!--", start):
            end = payload.find("-->", start + 4)
            at = size if end < 0 else end + 3
            yield "silent", "", start, at
            continue
        mark = payload[start + 1:start + 2]
        if not (mark.isascii() and mark.isalpha() or mark in ("/", "!", "?")):
            yield "text", "", start, start + 1
            at = start + 1
            continue
        end = payload.find(">", start)
        at = size if end < 0 else end + 1
        found = _NAME.match(payload, start, at)
        name = found[1].lower() if found else ""
        if name in _CLOSED and mark != "/" and end >= 0:
            closed = _CLOSED[name].search(payload, at)
            at = closed.end() if closed else size
            yield "silent", name, start, at
        else:
            yield ("close" if mark == "/" else "open"), name, start, at


def visible_text(payload: str) -> str:
    """The text a reader sees: scripts, styles and comments go, block tags end
    lines, entities are resolved, blanks are collapsed, empty lines go."""
    out = []
    for kind, name, start, end in scan(payload):
        if kind == "text":
            out.append(payload[start:end])
        elif kind == "silent":
            out.append(" ")
        elif name in _BREAKS:
            out.append("\n")
    lines = (_BLANKS.sub(" ", x).strip() for x in html.unescape("".join(out)).split("\n"))
    return "\n".join(x for x in lines if x)


def page_fields(payload: str, uri: str) -> list[tuple[str, str]]:
    """Title, language, charset and links of a page, links in order, once
    each. The title is what stands between the first pair of title tags, tags
    included; language and charset are those of the first tag that has one."""
    found: dict[str, str] = {}
    links: dict[str, None] = {}
    title: list[str] | None = None
    for kind, name, start, end in scan(payload):
        if name == "title" and kind == "open" and title is None:
            title = []
        elif name == "title" and kind == "close" and title is not None:
            found.setdefault("title", "".join(title))
        elif title is not None and "title" not in found:
            title.append(" " if kind == "silent" else payload[start:end])
        if kind != "open" or name not in ("html", "meta", "a"):
            continue
        field, pattern = {"html": ("language", _LANG), "meta": ("charset", _CHARSET), "a": ("href", _HREF)}[name]
        got = pattern.search(payload, start, end) if field not in found else None
        if got is None:
            continue
        if field != "href":
            found[field] = got[1]
            continue
        href = one_line(html.unescape(got[1] or got[2] or got[3] or ""))
        try:
            links[urljoin(uri, href) if href else ""] = None
        except ValueError:  # not a URL
            links[href] = None
    out = [(name, one_line(html.unescape(found[name]))) for name in ("title", "language", "charset") if name in found]
    return [x for x in out if x[1]] + [("outlink", one_line(x)) for x in links if x]


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date: str = "2026-01-01T00:00:00Z", http_headers: tuple[tuple[str, str], ...] = (
                  ("Content-Type", "text/html; charset=utf-8"),)) -> DataFrame:
    """Pages as response records: ``(id_col, target_uri, date, http_head,
    payload)``. Null url or html count as empty; other columns are left out."""
    head = "HTTP/1.1 200 OK\r\n" + "".join(f"{k}: {v}\r\n" for k, v in http_headers)
    return pages.select(F.col(id_col), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("target_uri"),
                        F.lit(date).alias("date"), F.lit(head).alias("http_head"),
                        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("payload"))


def derive(source: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Two rows per response: ``(id_col, kind, record_id, refers_to,
    target_uri, date, content_type, source_payload_digest, block_digest,
    content_length, block)``.

    ``refers_to`` is the response's own record id, made of its id, URI, date
    and payload digest; rows equal in all of these are the same record and
    give the same (repeated) derivatives. An empty payload gives an empty
    conversion and metadata without page fields; an empty URI stays empty; a
    null id is the id "". Line breaks inside header values become blanks. An
    empty table gives no rows.
    """
    schema = StructType([source.schema[id_col]] + [StructField(c, StringType()) for c in (
        "kind", "record_id", "refers_to", "target_uri", "date", "content_type", "source_payload_digest",
        "block_digest")] + [StructField("content_length", LongType()), StructField("block", StringType())])
    names = schema.names

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows, keys = [], []
                for i, (key, uri, date, head, payload) in enumerate(zip(*(c.to_pylist() for c in part.columns), strict=True)):
                    payload, uri = payload or "", one_line(uri or "")
                    source_digest = digest(payload.encode())
                    refers = record_id("response", "" if key is None else str(key), uri, date or "", source_digest)
                    fields = [("source-status", (head or "").split("\r\n")[0])] if head else []
                    fields += [("source-header", one_line(x)) for x in (head or "").split("\r\n")[1:] if x.strip()]
                    fields += [("source-payload-digest", source_digest)] + page_fields(payload, uri)
                    for kind, content_type, block in (
                            ("metadata", "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields)),
                            ("conversion", "text/plain; charset=utf-8", visible_text(payload))):
                        data = block.encode()
                        rows.append((kind, record_id(kind, refers), refers, uri, date, content_type, source_digest,
                                     digest(data), len(data), block))
                        keys.append(i)
                columns = list(zip(*rows, strict=True)) if rows else [()] * (len(names) - 1)
                kinds = [pa.string()] * 8 + [pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(keys, pa.int64()))] + [
                    pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return source.select(id_col, "target_uri", "date", "http_head", "payload").mapInArrow(run, schema)


def record(records: DataFrame) -> Column:
    """The whole WARC/1.1 record as text, without the two empty lines behind it."""
    c = records

    def header(name, value):
        return F.when(value.isNull() | (value == ""), F.lit("")).otherwise(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")))

    return F.concat(F.lit("WARC/1.1\r\n"), header("WARC-Type", c["kind"]), header("WARC-Record-ID", c["record_id"]),
                    header("WARC-Refers-To", c["refers_to"]), header("WARC-Target-URI", c["target_uri"]),
                    header("WARC-Date", c["date"]), header("Content-Type", c["content_type"]),
                    header("WARC-Block-Digest", c["block_digest"]), header("Content-Length", c["content_length"].cast("string")),
                    F.lit("\r\n"), c["block"])


def write(records: DataFrame, path: str, compression: str = "none") -> None:
    """WARC files of the records, one file per task, in the folder ``path``."""
    (records.select(record(records).alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", compression)
     .text(path))
