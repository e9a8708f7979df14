"""WARC derivatives: metadata and plain-text conversion records from response records.

Each response record (its WARC header, the HTTP header and the payload, as bytes) gives a metadata record that describes it and, if it
carries text, a conversion record with that text. Both refer to the response by its record id, name its target and date, and keep its
digests and HTTP header; ids of new records follow from the response's id and the kind, so that a repeated run makes the same records.
"""

from __future__ import annotations

import base64
import hashlib
import html
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
ATTRIBUTES = r"(?:(?:[^>\"']|\"[^\"]*\"|'[^']*')*>|[^>]*>)"
#: A head ends at its end tag or before the first text or element that cannot stand in it.
UNSEEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<head\b{ATTRIBUTES}(?:\s|<!--.*?(?:-->|\Z)|<(script|style|noscript|template|noframes)\b{ATTRIBUTES}.*?(?:</\1\s*>|\Z)"
    rf"|<title\b{ATTRIBUTES}.*?(?:</title\s*>|(?=</head\b|<body\b)|\Z)|<(?:meta|link|base|basefont|bgsound)\b{ATTRIBUTES}|</(?!(?:head|body|html|br)\b)[^>]*>|<[!?][^>]*>)*+(?:</head\s*>)?"
    rf"|<(script|style|noscript|template|textarea|iframe|svg)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\2\s*>|\Z)", re.S | re.I
)
BREAKS = re.compile(
    r"</?(?:address|article|aside|blockquote|body|br|center|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|tr|ul)\b[^>]*>", re.I
)
TAGS = re.compile(r"<[!/?a-zA-Z][^>]*>")
CHARSET = re.compile(r"charset\s*=\s*[\"']?([-\w.:]+)", re.I)
#: A page states its charset in a meta element of its head, wherever in the head that is.
META_CHARSET = re.compile(rb"<meta\b[^>]*?charset\s*=\s*[\"']?([-\w.:]+)", re.I)
HEAD_END = re.compile(rb"</head\b|<body\b", re.I)


def page_charset(payload: bytes) -> str:
    """The charset that a page's head names, or nothing. Without an end of the head the whole page is searched."""
    end = HEAD_END.search(payload)
    found = META_CHARSET.search(payload, 0, end.start() if end else len(payload))
    return found[1].decode("ascii", "ignore") if found else ""


RECORD_FIELDS = (
    ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()), ("target_uri", pa.string()), ("date", pa.string()),
    ("content_type", pa.string()), ("content_length", pa.int64()), ("block_digest", pa.string()), ("payload_digest", pa.string()),
    ("source_headers", pa.string()), ("record", pa.binary()),
)


def digest(block: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()


def headers_of(raw: bytes) -> tuple[str, dict[str, str]]:
    """First line and fields of a header; names in lower case, the first of repeated fields, folded lines joined."""
    lines = raw.decode("utf-8", "replace").replace("\r\n", "\n").split("\n")
    fields: dict[str, str] = {}
    name = ""
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and name:
            fields[name] += " " + line.strip()
        elif ":" in line:
            key, _, value = line.partition(":")
            name = key.strip().lower()
            if name in fields:
                name = ""
            else:
                fields[name] = value.strip()
    return lines[0].strip(), fields


def split_header(raw: bytes) -> tuple[bytes, bytes]:
    """A header and what follows its empty line."""
    for mark in (b"\r\n\r\n", b"\n\n"):
        at = raw.find(mark)
        if at >= 0:
            return raw[:at], raw[at + len(mark) :]
    return raw, b""


def visible_text(page: str) -> str:
    """All text a page shows, a line per block."""
    text = TAGS.sub("", BREAKS.sub("\n", UNSEEN.sub(" ", page)))
    if "&" in text:
        text = html.unescape(text)
    return "\n".join(line for line in (" ".join(x.split()) for x in text.split("\n")) if line)


def new_record(kind: str, source: dict[str, str], record_id: str, content_type: str, block: bytes, source_headers: str, concurrent: str | None) -> dict:
    """A record that refers to its source, as columns and as bytes."""
    refers = source.get("warc-record-id", "")
    block_digest = digest(block)
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Refers-To: {refers}",
        f"WARC-Target-URI: {source.get('warc-target-uri', '')}", f"WARC-Date: {source.get('warc-date', '')}",
    ]
    if source.get("warc-target-uri") and kind == "conversion":
        lines += [f"WARC-Refers-To-Target-URI: {source['warc-target-uri']}", f"WARC-Refers-To-Date: {source.get('warc-date', '')}"]
    if concurrent:
        lines.append(f"WARC-Concurrent-To: {concurrent}")
    lines += [f"WARC-Block-Digest: {block_digest}", f"Content-Type: {content_type}", f"Content-Length: {len(block)}"]
    return {
        "record_type": kind, "record_id": record_id, "refers_to": refers, "target_uri": source.get("warc-target-uri", ""), "date": source.get("warc-date", ""),
        "content_type": content_type, "content_length": len(block), "block_digest": block_digest, "payload_digest": source["payload_digest"],
        "source_headers": source_headers, "record": "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n",
    }


def derive(raw: bytes) -> list[dict]:
    """The derivatives of a response record; none of a record of another type."""
    head, block = split_header(raw)
    _, source = headers_of(head)
    if source.get("warc-type", "").lower() != "response":
        return []
    length = source.get("content-length", "")
    if length.isdigit():
        block = block[: int(length)]
    http_head, payload = split_header(block)
    status, http = headers_of(http_head)
    found = digest(payload)
    stated = source.get("warc-payload-digest", "")
    source["payload_digest"] = stated or found
    identity = source.get("warc-record-id") or found + source.get("warc-target-uri", "")
    metadata_id, conversion_id = (f"<urn:uuid:{uuid.uuid5(SPACE, kind + ' ' + identity)}>" for kind in ("metadata", "conversion"))
    kind = http.get("content-type", "").partition(";")[0].strip().lower()
    charset = CHARSET.search(http.get("content-type", ""))
    name = (charset[1] if charset else page_charset(payload)).lower() or "utf-8"
    try:
        text = payload.decode(name, "replace")
    except LookupError:
        name, text = "utf-8", payload.decode("utf-8", "replace")
    textual = kind.startswith("text/") or kind in ("application/xhtml+xml", "")
    headers = http_head.decode("utf-8", "replace")
    about = [
        ("status", status), ("content-type", http.get("content-type", "")), ("charset", name), ("payload-length", str(len(payload))),
        ("payload-digest", source["payload_digest"]), ("payload-digest-valid", str(not stated or stated == found).lower()), ("source-block-digest", source.get("warc-block-digest", digest(block))),
    ]
    if textual:
        about.append(("conversion-record", conversion_id))
    fields = "".join(f"{k}: {v}\r\n" for k, v in about) + "".join(f"http-{k}: {v}\r\n" for k, v in http.items())
    made = [new_record("metadata", source, metadata_id, "application/warc-fields", fields.encode(), headers, None)]
    if textual:
        plain = text if kind == "text/plain" else visible_text(text)
        made.append(new_record("conversion", source, conversion_id, "text/plain; charset=utf-8", plain.encode("utf-8", "replace"), headers, metadata_id))
    return made


def build_derivatives(responses: DataFrame, record: str = "record", columns: tuple[str, ...] = ()) -> DataFrame:
    """One row for each derived record: ``columns`` of its response and the record's fields, ending in its bytes (``record``).

    Null, empty and malformed records, and records that are no responses, have no derivatives. A stated payload digest is kept even where it
    does not fit the payload; the metadata then says so. Repeated responses give repeated derivatives with equal ids. Responses are
    handled one by one, whatever their size or order; columns that are not named are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                rows, made = [], []
                for n, raw in enumerate(part.column("_record").to_pylist()):
                    new = derive(raw) if raw else []
                    rows.extend([n] * len(new))
                    made.extend(new)
                picked = part.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*[picked.column(c) for c in columns], *[pa.array([m[f] for m in made], kind) for f, kind in RECORD_FIELDS]],
                    [*columns, *[f for f, _ in RECORD_FIELDS]],
                )

    source = responses.select(*columns, F.col(record).cast("binary").alias("_record"))
    kinds = [f"`{c}` {source.schema[c].dataType.simpleString()}" for c in columns]
    kinds += [f"{f} {'long' if kind == pa.int64() else 'binary' if kind == pa.binary() else 'string'}" for f, kind in RECORD_FIELDS]
    return source.mapInArrow(run, ", ".join(kinds))


def page_responses(pages: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Pages as response records, the form in which a crawl would hold them: ``page_id, url, record``."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    block: Column = F.concat(http.cast("binary"), body)
    named = F.md5(F.concat_ws("\n", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.coalesce(F.col("url"), F.lit(""))).cast("binary"))
    identity = F.concat(F.lit("<urn:uuid:"), F.regexp_replace(named, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: "), identity, F.lit("\r\nWARC-Target-URI: "), F.coalesce(F.col("url"), F.lit("")),
        F.lit(f"\r\nWARC-Date: {date}\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"),
    )
    return pages.select("page_id", "url", F.concat(head.cast("binary"), block, F.lit("\r\n\r\n").cast("binary")).alias("record"))
