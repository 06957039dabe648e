"""Legacy archives: ARC files to WARC files, and reading WARC files back.

ARC: a version block names the record layout (version 1: URL, IP, date, type,
length; version 2 adds result code, checksum, location, offset, file name
before the length). Each record is a header line and the declared number of
bytes. The converter parses those lines and lengths and writes for each record
the WARC one it stands for:

    WARC-Type        response for http records, or revisit if an equal payload is kept elsewhere;
                     resource for other schemes; warcinfo for the version block
    WARC-Record-ID   urn:uuid from a hash of URL, date, page and payload digest (equal on every run)
    WARC-Date        the 14-digit date as ISO 8601
    digests          sha1 in base32, of the payload and of the block

Equal payloads of at least ``MIN_REVISIT`` bytes: the record with the largest
page id is the response, the others are revisits of it, without payload. Shorter
ones are all responses. Payloads meet by digest, not by content.

Files are written by Spark's text writer, gzip-compressed (row separator: what
stands between records), so its commit protocol covers lost executors; they are
read by the binaryFile reader and hold about ``FILE_BYTES`` of payload each.

Null html is an empty payload, a null url an empty one. URLs are percent-encoded
where a header line could not hold them. Rows with a null page id are kept, and
come back null, but are nobody's reference. Rows that share a page id are records
of their own. Equal ids among equal payloads: one of them is the response's id,
and records of that id are responses.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored

MIN_REVISIT = 1000
FILE_BYTES = 32 << 20
CRAWL_START = datetime(2004, 1, 1, tzinfo=timezone.utc)  # the pages carry no date: one second a page id
ARC_FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
CRLF = b"\r\n"
PAGE = "X-Page-Id"


# --- ARC ----------------------------------------------------------------------

def http_block(page: int | None, payload: bytes) -> bytes:
    head = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n"
    return (head + (f"{PAGE}: {page}\r\n" if page is not None else "") + "\r\n").encode() + payload


def safe_url(url: str) -> str:
    """A URL without characters that would end a header field."""
    return re.sub(r"[\x00-\x20\x7f\x85\u2028\u2029]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "") or "about:blank"


def arc_version_block(name: str, version: str) -> bytes:
    body = f"{version} 0 crawler\n{ARC_FIELDS[version]}\n".encode()
    extra = "" if version == "1" else f" 200 - - 0 {name}"
    return f"filedesc://{name} 0.0.0.0 {CRAWL_START:%Y%m%d%H%M%S} text/plain{extra} {len(body)}\n".encode() + body


def arc_record(url: str, page: int | None, payload: bytes, version: str, name: str, offset: int) -> bytes:
    block = http_block(page, payload)
    date = CRAWL_START + timedelta(seconds=abs(page or 0) % (20 * 365 * 86400))
    extra = "" if version == "1" else f" 200 {zlib.crc32(block):08x} - {offset} {name}"
    return f"{safe_url(url)} 127.0.0.1 {date:%Y%m%d%H%M%S} text/html{extra} {len(block)}\n".encode() + block


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of an ARC file, the version block first; lengths are as declared, layouts by its version."""
    fields, at = None, 0
    while at < len(data):
        if data[at:at + 1] in (b"\n", b"\r"):  # between records
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            raise ValueError("header line without an end")
        parts = data[at:end].decode("utf-8").rstrip("\r").split(" ")
        length = int(parts[-1])
        block = data[end + 1:end + 1 + length]
        if len(block) < length:
            raise ValueError(f"record of {length} bytes is cut at {len(block)}")
        if fields is None:
            if not parts[0].startswith("filedesc:"):
                raise ValueError("no version block")
            version = block.split(b" ", 1)[0].decode()
            fields = ARC_FIELDS[version].split(" ")
        elif len(parts) != len(fields):
            raise ValueError(f"{len(parts)} fields in a header of {len(fields)}")
        record = dict(zip(fields, parts)) if len(parts) == len(fields) else {"URL": parts[0], "Archive-date": parts[2], "Content-type": parts[3]}
        yield record | {"block": block}
        at = end + 1 + length


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """(status line and headers with the blank line, payload)."""
    end = block.find(b"\r\n\r\n")
    return (block[:end + 4], block[end + 4:]) if end >= 0 else (b"", block)


def header(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head)
    return found[1].decode() if found else None


# --- WARC ---------------------------------------------------------------------

def digest32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(url: str, date: str, page: str | None, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ' '.join([url, date, page or '', payload_digest]))}>"


def to_warc(record: dict, refers_to: int | None = None) -> bytes:
    """The WARC record of an ARC record; ``refers_to``: the page id of the response it revisits."""
    url, date = record["URL"], datetime.strptime(record["Archive-date"], "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    head, payload = split_http(record["block"])
    page, whole = header(head, PAGE), digest32(payload)
    lines = [("WARC-Record-ID", record_id(url, date, page, whole)), ("WARC-Date", date)]
    if url.startswith("filedesc:"):
        kind, mime, block = "warcinfo", "application/warc-fields", b"converted-from: " + url.encode() + CRLF
    elif head.startswith(b"HTTP/"):
        kind, mime, block = "response", "application/http; msgtype=response", record["block"]
        lines += [("WARC-Target-URI", url), ("WARC-IP-Address", record.get("IP-address", "0.0.0.0")), ("WARC-Payload-Digest", whole)]
        lines += [(PAGE, page)] if page is not None else []
        if refers_to is not None:
            kind, block = "revisit", head
            lines += [("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"), ("X-Refers-To-Page-Id", str(refers_to))]
    else:
        kind, mime, block = "resource", record["Content-type"], record["block"]
        lines += [("WARC-Target-URI", url)]
    lines += [("WARC-Block-Digest", digest32(block)), ("Content-Type", mime), ("Content-Length", str(len(block)))]
    text = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *lines])
    return b"WARC/1.0\r\n" + text.encode() + CRLF + block


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of a WARC file, by declared lengths."""
    at = 0
    while at < len(data):
        if data[at:at + 2] == CRLF:
            at += 2
            continue
        end = data.find(b"\r\n\r\n", at)
        if not data.startswith(b"WARC/", at) or end < 0:
            raise ValueError(f"no record at byte {at}")
        headers = dict(line.split(": ", 1) for line in data[at:end].decode("utf-8").split("\r\n")[1:])
        length = int(headers["Content-Length"])
        block = data[end + 4:end + 4 + length]
        if len(block) < length:
            raise ValueError("cut record")
        yield headers, block
        at = end + 4 + length


# --- on Spark -------------------------------------------------------------------

def _binary(name: str, rows: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=[name])


def _write(df: DataFrame, path: str, separator: str) -> None:
    (df.select(F.col("data").cast("string").alias("value")).write
     .option("lineSep", separator).option("compression", "gzip").text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def _unzipped(column: pa.Array) -> Iterator[bytes]:
    for i in range(len(column)):
        yield zlib.decompress(column[i].as_buffer(), wbits=47)


def _arc_writer(batches):
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    version, name, offset = "12"[part % 2], f"pages-{part:05d}.arc", 0
    for batch in batches:
        rows = [] if offset else [arc_version_block(name, version)]
        offset += sum(map(len, rows))
        for page, url, html in zip(*(batch.column(i).to_pylist() for i in range(3))):
            rows.append(arc_record(url, page, (html or "").encode(), version, name, offset))
            offset += len(rows[-1]) + 1
        yield _binary("data", rows)


def write_arc(pages: DataFrame, path: str) -> None:
    """Pages (page_id, url, html) as ARC files, versions 1 and 2 in turn."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    size = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    _write(pages.repartition(size // FILE_BYTES + 1).mapInArrow(_arc_writer, "data binary"), path, "\n")


def _arc_digests(batches):
    for batch in batches:
        for data in _unzipped(batch.column(0)):
            rows = [(header(h, PAGE), hashlib.sha1(p).digest(), len(p)) for h, p in (split_http(r["block"]) for r in parse_arc(data)) if h]
            yield pa.RecordBatch.from_arrays(
                [pa.array([None if x[0] is None else int(x[0]) for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.binary()),
                 pa.array([x[2] for x in rows], pa.int64())], names=["page_id", "sha1", "n"])


def _arc_blocks(batches):
    """Records as rows: page id, payload digest, and the record's fields and block."""
    for batch in batches:
        for data in _unzipped(batch.column(0)):
            pages, digests, blocks = [], [], []
            for r in parse_arc(data):
                head, payload = split_http(r["block"])
                page = header(head, PAGE)
                digests.append(hashlib.sha1(payload).digest())
                pages.append(None if page is None else int(page))
                blocks.append(" ".join([r["URL"], r.get("IP-address", "-"), r["Archive-date"], r["Content-type"]]).encode() + b"\n" + r["block"])
            yield pa.RecordBatch.from_arrays([pa.array(pages, pa.int64()), pa.array(digests, pa.binary()), pa.array(blocks, pa.binary())],
                                             names=["page_id", "sha1", "record"])


def _warc_writer(batches):
    for batch in batches:
        rows = []
        for record, refers_to in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            line, block = record.split(b"\n", 1)
            fields = dict(zip(("URL", "IP-address", "Archive-date", "Content-type"), line.decode().split(" ")))
            rows.append(to_warc(fields | {"block": block}, refers_to))
        yield _binary("data", rows)


def convert(spark: SparkSession, arc_path: str, warc_path: str, min_revisit: int = MIN_REVISIT) -> None:
    """ARC files to WARC files. Records move once, to meet the decision on them."""
    seen = _files(spark, arc_path).mapInArrow(_arc_digests, "page_id long, sha1 binary, n long").where(f"page_id is not null and n >= {min_revisit}")
    seen = stored(seen, "arc-digests")
    kept = seen.groupBy("sha1").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("records")).where("records > 1")
    revisits = stored(seen.join(kept, "sha1").where("page_id <> refers_to").select("page_id", "sha1", "refers_to").distinct(), "revisits")
    records = _files(spark, arc_path).mapInArrow(_arc_blocks, "page_id long, sha1 binary, record binary")
    told = records.join(revisits, ["page_id", "sha1"], "left").select("record", "refers_to")
    _write(told.mapInArrow(_warc_writer, "data binary"), warc_path, "\r\n\r\n")


def _warc_reader(batches):
    for batch in batches:
        for data in _unzipped(batch.column(0)):
            out = {k: [] for k in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")}
            for headers, block in parse_warc(data):
                if headers["WARC-Type"] not in ("response", "revisit"):
                    continue
                head, payload = split_http(block)
                kind = headers["WARC-Type"]
                digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"payload digest of {headers['WARC-Record-ID']}")
                out["page_id"].append(int(headers[PAGE]) if PAGE in headers else None)
                out["payload_bytes"].append(int(header(head, "Content-Length")) if kind == "revisit" else len(payload))
                out["payload_digest"].append(digest)
                out["record_type"].append(kind)
                out["refers_to"].append(int(headers["X-Refers-To-Page-Id"]) if kind == "revisit" else None)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) per response or revisit; digests are verified."""
    return _files(spark, path).mapInArrow(_warc_reader, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


ORACLE = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
m AS (SELECT d, max(page_id) AS keep FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN page_id < keep THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < keep THEN keep END AS refers_to
FROM p LEFT JOIN m ON p.d = m.d AND p.n >= 1000
"""
