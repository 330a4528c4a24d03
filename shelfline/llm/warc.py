"""WARC derivatives: from response records to linked metadata and plain-text conversion records.

Every response gives a metadata record (what its headers and markup say) and a conversion record (its
visible text). Both refer to the response by its record id, and carry its target, date and digests.
"""

from __future__ import annotations

import base64
import hashlib
import html as entities
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERSION = "WARC/1.1"
DATE = "2024-01-01T00:00:00Z"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of URLs
DERIVED = ("page_id bigint, warc_type string, record_id string, refers_to string, target_uri string, date string, "
           "content_type string, content_length bigint, block_digest string, source_block_digest string, "
           "source_payload_digest string, block binary")

_NAME = re.compile(r"/?([A-Za-z]\w*)")
_DROPPED = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "noscript", "template")}
_BREAKS = {"p", "div", "br", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "table", "section", "article", "aside",
           "header", "footer", "nav", "main", "blockquote", "pre", "hr", "title"}
_TITLE = re.compile(r"<title\b", re.I)
_TITLE_END = re.compile(r"</title\s*>", re.I)
#: a tag up to its end or that of the page: each search goes on where the last one stopped
_HTML, _META, _LINK = (re.compile(rf"<{n}\b[^>]*", re.I) for n in ("html", "meta", "a"))
_LANG = re.compile(r"\blang\s*=\s*[\"']?([A-Za-z-]+)", re.I)
_CHARSET = re.compile(r"\bcharset\s*=\s*[\"']?([\w-]+)", re.I)
_HREF = re.compile(r"\bhref\s*=", re.I)
#: bytes in which the markup has to name its charset
_PRESCAN = 1024


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def visible_text(page: str) -> str:
    """Text outside markup, one line per block, with single spaces.

    The page is read once from left to right. Scripts, styles and comments are left out, and one that is not
    closed runs to the end of the page; a tag without its closing bracket is text."""
    out, at = [], 0
    while True:
        here = page.find("<", at)
        if here < 0:
            out.append(page[at:])
            break
        out.append(page[at:here])
        if page.startswith("<!--", here):
            end = page.find("-->", here + 4)
            out.append(" ")
            if end < 0:
                break
            at = end + 3
            continue
        if page[here + 1:here + 2] not in "!/?" and not (page[here + 1:here + 2].isascii() and page[here + 1:here + 2].isalpha()):
            out.append("<")
            at = here + 1
            continue
        end = page.find(">", here)
        if end < 0:
            out.append(page[here:])
            break
        name = _NAME.match(page, here + 1)
        tag = name[1].lower() if name else ""
        if tag in _DROPPED and page[here + 1] != "/":
            closing = _DROPPED[tag].search(page, here)
            out.append(" ")
            if closing is None:
                break
            at = closing.end()
            continue
        out.append("\n" if tag in _BREAKS else "")
        at = end + 1
    lines = (" ".join(line.split()) for line in entities.unescape("".join(out)).split("\n"))
    return "\n".join(line for line in lines if line)


def _title(page: str) -> str | None:
    begun = _TITLE.search(page)
    start = page.find(">", begun.end()) if begun else -1
    closed = _TITLE_END.search(page, start) if start >= 0 else None
    return " ".join(entities.unescape(page[start + 1:closed.start()]).split()) if closed else None


def _attribute(tag: re.Pattern, value: re.Pattern, page: str) -> str | None:
    """The attribute of the first such tag that has it."""
    found = (value.search(each[0]) for each in tag.finditer(page))
    return next((m[1].lower() for m in found if m), None)


def decoded(headers: list[tuple[str, str]], payload: bytes) -> str:
    """The payload as text, by the charset its Content-Type names, else by its markup, else UTF-8. Charsets
    nobody knows are passed over, bytes that do not fit replaced."""
    said = next((_CHARSET.search(v) for k, v in headers if k.lower() == "content-type"), None)
    marked = _attribute(_META, _CHARSET, payload[:_PRESCAN].decode("ascii", "replace"))
    for label in (said and said[1], marked):
        try:
            if label:
                return payload.decode(label, "replace")
        except (LookupError, UnicodeError):
            continue
    return payload.decode("utf-8", "replace")


def described(status: str, headers: list[tuple[str, str]], page: str, length: int) -> list[tuple[str, str]]:
    """Fields of the metadata record: the source's headers, what the markup says of itself, and how many bytes
    the payload has."""
    fields = [("http-status", status), *((f"http-header-{k.lower()}", v) for k, v in headers)]
    named = {"title": _title(page), "language": _attribute(_HTML, _LANG, page), "charset": _attribute(_META, _CHARSET, page)}
    fields += [(k, v) for k, v in named.items() if v is not None]
    links = sum(1 for each in _LINK.finditer(page) if _HREF.search(each[0]))
    return [*fields, ("outlinks", str(links)), ("payload-length", str(length))]


def record_id(kind: str, *parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, ' '.join((kind, *parts)))}>"


def http_block(page: str) -> bytes:
    payload = page.encode()
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode() + payload


def parse_http(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """Status line, headers in order, payload. A block without an empty line is all header."""
    head, _, payload = block.partition(b"\r\n\r\n")
    status, *lines = head.decode("iso-8859-1").split("\r\n")
    return status, [(k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in lines) if k.strip()], payload


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records of a table of pages: page_id, record_id, target_uri, date, block.

    A null page is an empty payload, a null url an empty target; repeated rows give the same record again."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, pages_ = (batch.column(c).to_pylist() for c in ("page_id", "url", "html"))
            blocks = [http_block(x or "") for x in pages_]
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id"),
                pa.array([record_id("response", str(i), u or "", digest(b)) for i, u, b in zip(ids, urls, blocks)], pa.string()),
                pa.array([u or "" for u in urls], pa.string()), pa.array([date] * len(ids), pa.string()), pa.array(blocks, pa.binary())],
                names=["page_id", "record_id", "target_uri", "date", "block"])
    return pages.select(F.col("page_id").cast("bigint"), "url", "html").mapInArrow(
        run, "page_id bigint, record_id string, target_uri string, date string, block binary")


def derivatives(source: DataFrame) -> DataFrame:
    """Two records per response: its metadata and its text, with the columns of DERIVED.

    A null block is an empty one: its metadata has no status and its text is empty. The text is decoded by
    the charset the headers or the markup name; bytes that do not fit it are replaced in the text only, digests
    and lengths are those of the source bytes. Repeated records give their derivatives again, an empty table
    none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, source_id, uri, date, block in zip(*(batch.column(c).to_pylist() for c in (
                    "page_id", "record_id", "target_uri", "date", "block"))):
                block = block or b""
                status, headers, payload = parse_http(block)
                text = decoded(headers, payload)
                fields = described(status, headers, text, len(payload))
                made = (("metadata", "application/warc-fields", "".join(f"{k}: {v}\r\n" for k, v in fields).encode()),
                        ("conversion", "text/plain; charset=utf-8", visible_text(text).encode()))
                own, inner = digest(block), digest(payload)
                for kind, content, body in made:
                    out.append((page, kind, record_id(kind, source_id or "", own), source_id, uri, date, content, len(body), digest(body), own, inner, body))
            kinds = (pa.int64(), *[pa.string()] * 6, pa.int64(), *[pa.string()] * 3, pa.binary())
            names = [x.split()[0] for x in DERIVED.split(", ")]
            columns = list(zip(*out)) if out else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)
    return source.select("page_id", "record_id", "target_uri", "date", "block").mapInArrow(run, DERIVED)


def serialized(records: DataFrame) -> Column:
    """A derived record as it stands in a WARC file."""
    def line(name: str, value: Column) -> Column:
        return F.when(value.isNotNull() & (value != ""), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")
    head = F.concat(
        F.lit(f"{VERSION}\r\n"), line("WARC-Type", records["warc_type"]), line("WARC-Record-ID", records["record_id"]),
        line("WARC-Refers-To", records["refers_to"]), line("WARC-Target-URI", records["target_uri"]), line("WARC-Date", records["date"]),
        line("WARC-Block-Digest", records["block_digest"]), line("X-Source-Block-Digest", records["source_block_digest"]),
        line("X-Source-Payload-Digest", records["source_payload_digest"]), line("Content-Type", records["content_type"]),
        line("Content-Length", records["content_length"].cast("string")), F.lit("\r\n"))
    return F.concat(head.cast("binary"), records["block"], F.lit("\r\n\r\n").cast("binary"))


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one serialized record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = {k: v for k, _, v in (x.partition(": ") for x in lines)}
    if version != VERSION:
        raise ValueError(f"not a {VERSION} record: {version[:40]!r}")
    return headers, rest[:int(headers["Content-Length"])]


def report(pages: DataFrame) -> DataFrame:
    """The derived records of all pages, each with its serialized form's digest and its block as text.

    Null pages, null urls and repeated rows as in `responses`; an empty table gives none."""
    records = derivatives(responses(pages))
    return records.select("page_id", "warc_type", "record_id", "refers_to", "target_uri", "date", "content_type", "content_length",
                          "block_digest", "source_block_digest", "source_payload_digest", F.col("block").cast("string").alias("block"),
                          F.sha2(serialized(records), 256).alias("record_sha256"))
