"""WARC derivatives: response records -> metadata and plain-text conversion records.

Every response record gives two records that refer to it: a ``metadata`` record
(JSON: source and HTTP headers, title, links, digests) and a ``conversion``
record (the plain text of the page). Both keep WARC-Refers-To (the response's
WARC-Record-ID), the target URI and date of the source, and carry the digests of
their own block and of the source's payload. All four kinds of ids are URIs in
angle brackets as in the WARC format; ids of derivatives are derived from the
source's id, so a repeated run, or a task that runs again, writes the same.

Records are worked on one by one beside the scan; nothing is shuffled.

* A null body is an empty payload; a null URL gives an empty target URI.
* A record that is not a response gives nothing; one that cannot be read gives a
  row of kind ``error`` with the reason, so nothing vanishes.
* Repeated rows give repeated records. Extra columns are not read.
* Pages of any length are converted whole.
"""

from __future__ import annotations

import base64
import hashlib
import html
import json
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trovelake.llm.common import query, rows_out, table

VERSION = b"WARC/1.1"
DATE = "2024-01-01T00:00:00Z"  # of responses made from pages, which have none
NAMESPACE = uuid.NAMESPACE_URL

# Elements whose content is no text; elements that end a line.
HIDDEN = r"(?is)<!--.*?-->|<(script|style|noscript|template)\b[^>]*>.*?</\1\s*>|<!doctype[^>]*>"
BLOCKS = (r"(?i)</?(?:address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]"
          r"|head|header|hr|html|li|main|nav|ol|p|pre|section|table|title|tr|ul)\b[^>]*>")


def digest(content: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(content).digest()).decode()


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record: version line, headers, blank line, block, two line ends."""
    lines = [VERSION] + [f"{name}: {value}".encode() for name, value in headers]
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_headers(content: bytes) -> tuple[bytes, list[tuple[str, str]], bytes]:
    """(first line, headers, rest) of a header block and what follows it."""
    head, mark, rest = content.partition(b"\r\n\r\n")
    if not mark:
        raise ValueError("no blank line after the headers")
    first, *lines = head.split(b"\r\n")
    headers: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in b" \t" and headers:  # a folded line goes on the one before
            headers[-1] = (headers[-1][0], headers[-1][1] + " " + line.strip().decode("utf-8", "replace"))
            continue
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("a header line has no colon")
        headers.append((name.decode("utf-8", "replace").strip(),
                        value.decode("utf-8", "replace").strip()))
    return first, headers, rest


def parse_record(content: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one WARC record."""
    first, headers, rest = parse_headers(content)
    if not first.startswith(b"WARC/"):
        raise ValueError("no WARC version line")
    named = {name.lower(): value for name, value in headers}
    length = int(named.get("content-length", "-1"))
    if not 0 <= length <= len(rest):
        raise ValueError("Content-Length does not fit the record")
    return named, rest[:length]


def response(key: str, url: str | None, body: str | None, date: str = DATE) -> bytes:
    """A response record of one page."""
    payload = (body or "").encode()
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             b"Content-Length: %d\r\n\r\n" % len(payload)) + payload
    # a line end in a URL would end its header
    target = re.sub(r"[\r\n]", lambda m: f"%{ord(m.group()):02X}", url or "")
    return record([
        ("WARC-Type", "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{key} {target}')}>"),
        ("WARC-Date", date), ("WARC-Target-URI", target),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Block-Digest", digest(block)), ("WARC-Payload-Digest", digest(payload)),
    ], block)


def plain_text(page: str) -> str:
    """Text of a page: no tags, scripts or comments; a line per block."""
    text = re.sub(HIDDEN, " ", page)
    text = re.sub(BLOCKS, "\n", text)
    text = html.unescape(re.sub(r"<[a-zA-Z/!?][^>]*>", "", text))
    text = re.sub(r"[^\S\n]+", " ", text)
    return re.sub(r" ?\n[ \n]*", "\n", text).strip()


def attribute(tag: str, name: str) -> str | None:
    found = re.search(rf"""(?is)\b{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", tag)
    return html.unescape(next(g for g in found.groups() if g is not None)) if found else None


def page_facts(page: str) -> dict:
    """Title, language and links of a page."""
    visible = re.sub(HIDDEN, " ", page)
    title = re.search(r"(?is)<title\b[^>]*>(.*?)</title\s*>", visible)
    root = re.search(r"(?is)<html\b[^>]*>", visible)
    links = []
    for tag in re.findall(r"(?is)<(?:a|link|img|iframe|area)\b[^>]*>", visible):
        target = attribute(tag, "href") or attribute(tag, "src")
        if target is not None:
            links.append({"tag": re.match(r"<(\w+)", tag).group(1).lower(), "url": target})
    return {"title": html.unescape(title.group(1)).strip() if title else None,
            "lang": attribute(root.group(), "lang") if root else None, "links": links}


def derived(content: bytes) -> list[dict]:
    """The metadata and the conversion record of one response record."""
    named, block = parse_record(content)
    if named.get("warc-type", "").lower() != "response":
        return []
    source = named.get("warc-record-id")
    if not source:
        raise ValueError("the record has no WARC-Record-ID")
    status, http, payload = parse_headers(block)
    charset = next((m.group(1) for n, v in http if n.lower() == "content-type"
                    and (m := re.search(r"charset=[\"']?([\w-]+)", v))), "utf-8")
    try:
        page = payload.decode(charset, "replace")
    except LookupError:
        page = payload.decode("utf-8", "replace")
    uri, date = named.get("warc-target-uri", ""), named.get("warc-date", "")
    payload_digest = digest(payload)
    facts = {
        "source": {k: named[k] for k in sorted(named)},
        "http": {"status": status.decode("utf-8", "replace"), "headers": http},
        "payload": {"digest": payload_digest, "bytes": len(payload),
                    "digest_agrees": named.get("warc-payload-digest") in (None, payload_digest)},
        "page": page_facts(page),
    }
    out = []
    for kind, content_type, own in (
            ("metadata", "application/json", json.dumps(facts, ensure_ascii=False).encode()),
            ("conversion", "text/plain; charset=utf-8", plain_text(page).encode())):
        record_id = f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{source} {kind}')}>"
        out.append({
            "kind": kind, "record_id": record_id, "refers_to": source, "target_uri": uri,
            "warc_date": date, "content_type": content_type, "block_digest": digest(own),
            "source_payload_digest": payload_digest, "content_length": len(own),
            "record": record([
                ("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Refers-To", source),
                ("WARC-Date", date), ("WARC-Target-URI", uri), ("Content-Type", content_type),
                ("WARC-Block-Digest", digest(own)),
                ("WARC-Source-Payload-Digest", payload_digest)], own),
            "error": None})
    return out


OUT = pa.schema([
    ("page_id", pa.int64()), ("kind", pa.string()), ("record_id", pa.string()),
    ("refers_to", pa.string()), ("target_uri", pa.string()), ("warc_date", pa.string()),
    ("content_type", pa.string()), ("content_length", pa.int64()), ("block_digest", pa.string()),
    ("source_payload_digest", pa.string()), ("record", pa.binary()), ("error", pa.string())])
DDL = ("page_id long, kind string, record_id string, refers_to string, target_uri string, "
       "warc_date string, content_type string, content_length long, block_digest string, "
       "source_payload_digest string, record binary, error string")


def responses(pages: DataFrame) -> DataFrame:
    """(page_id, record): a WARC response record of every page."""
    schema = pa.schema([("page_id", pa.int64()), ("record", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch["page_id"].to_pylist()
            made = [response(str(k), u, b) for k, u, b in zip(
                keys, batch["url"].to_pylist(), batch["html"].to_pylist())]
            yield rows_out(schema, {"page_id": keys, "record": made})

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, record binary")


def derivatives(records: DataFrame) -> DataFrame:
    """Derive from the ``record`` of every row; ``page_id`` is carried along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in OUT.names}
            for key, content in zip(batch["page_id"].to_pylist(), batch["record"].to_pylist()):
                try:
                    made = derived(content or b"")
                except ValueError as problem:
                    made = [{"kind": "error", "error": str(problem)}]
                for row in made:
                    out["page_id"].append(key)
                    for name in OUT.names[1:]:
                        out[name].append(row.get(name))
            yield rows_out(OUT, out)

    return records.select("page_id", "record").mapInArrow(run, DDL)


@query("op4_warc_derivatives")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = derivatives(responses(table(spark, sf_dir, "pages")))
    return made.withColumn("record_sha256", F.sha2("record", 256)).drop("record")
