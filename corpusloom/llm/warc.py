"""Convert legacy ARC archives to WARC, and read WARC back.

ARC files start with a version block (`filedesc://`), whose second line names
the version: version 1 records have five header fields, version 2 ten. Each
record is a header line, the declared number of bytes, and a line end; the bytes
are an HTTP response, or else (a DNS answer) a `resource`. The converter parses
headers by the file's version, takes exactly the declared bytes, whatever they
encode, and makes the WARC fields an ARC lacks: a record id
from the place's content, an ISO 8601 date, the type, and SHA-1 digests. A version
block becomes a `warcinfo` record. Responses whose payload another record has too become `revisit` records of the one with
the largest key; these hold the HTTP header only, with the payload's length.

Archives are written by Spark's text writer, one record a row and the record
separator as the line end, gzipped, into files of a bounded number of records;
whole files are read back as binary rows and cut by declared lengths, never by
looking for a separator. Everything stays in folders that Spark reads and
writes. Which record is the response is decided on digests and keys alone, by a
map-side maximum; payloads move once, to meet that decision.

Defined results: a null payload is empty; null URLs become `unknown:`; white space
in a URL is percent-encoded for the header line; the last field of a header line is
the length, so a content type may hold spaces; HTTP headers may end their lines with
LF alone; a date that is none is 1970-01-01; null keys count as smallest, and
rows of equal key and payload are responses alike if theirs is the largest; an
empty table gives no archive rows; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import Workspace, shared_folder

RECORDS_PER_FILE = 1000
_STAMP = "20200101000000"
_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _url(url: str | None) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "") or "unknown:"


def _response(key: str | None, payload: bytes) -> bytes:
    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    head += f"Content-Length: {len(payload)}\r\n" + ("" if key is None else f"X-Record-Key: {key}\r\n")
    return head.encode() + b"\r\n" + payload


def _arc(version: int, name: str):
    """Rows of text for ARC files: a version block, then a record for each page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        body = f"{version} 0 corpus\n{_FIELDS[version]}\n"
        middle = "" if version == 1 else "200 - - 0 - "
        opening = f"filedesc://{name} 0.0.0.0 {_STAMP} text/plain {middle}{len(body.encode())}\n{body}"
        written = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                rows = []
                part = batch.slice(at, 100)
                for key, url, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if written % RECORDS_PER_FILE == 0:
                        rows.append(opening)
                    written += 1
                    block = _response(key, (text or "").encode())
                    head = f"{_url(url)} 0.0.0.0 {_STAMP} text/html {middle}{len(block)}\n"
                    rows.append(head + block.decode())
                yield pa.RecordBatch.from_pydict({"value": pa.array(rows, pa.string())})

    return run


def write_arc(pages: DataFrame, key: str, url: str, text: str, path: str, version: int = 1) -> None:
    """ARC files below `path`, each a version block and at most `RECORDS_PER_FILE` records."""
    rows = pages.select(F.col(key).cast("string"), F.col(url).cast("string"), F.col(text).cast("string"))
    _write_text(rows.mapInArrow(_arc(version, "pages.arc"), "value string"), "\n", RECORDS_PER_FILE + 1, path)


def arc_records(data: bytes) -> Iterator[tuple[str, str, str, bytes]]:
    """(URL, date, content type, declared bytes) of each record of an ARC file; a version
    block has a URL of `filedesc://`."""
    at, behind = 0, 1
    while at < len(data):
        end = data.find(b"\n", at)
        line = data[at : end if end >= 0 else len(data)].decode("latin-1").strip("\r")
        at = end + 1 if end >= 0 else len(data)
        if not line.strip():
            continue
        values = line.split(" ")
        length = int(values[-1])
        block = data[at : at + length]
        if line.startswith("filedesc://"):
            version = int(block.split(b" ", 1)[0])
            # How many fields follow the content type.
            behind = len(_FIELDS[version].split()) - 4
            yield values[0], values[2], "text/plain", block
        else:
            yield values[0], values[2], " ".join(values[3 : len(values) - behind]), block
        at += length


_HEAD_END = re.compile(rb"\r?\n\r?\n")


def split_http(block: bytes) -> tuple[dict[str, str], bytes, bytes] | None:
    """Header fields by lower-case name, the header's bytes, the payload; None for what is
    no HTTP response."""
    if not block.startswith(b"HTTP/"):
        return None
    found = _HEAD_END.search(block)
    end = found.end() if found else len(block)
    lines = block[:end].decode("utf-8", "replace").splitlines()[1:]
    fields = dict(line.split(":", 1) for line in lines if ":" in line)
    return {k.strip().lower(): v.strip() for k, v in fields.items()}, block[:end], block[end:]


def _unzipped(content: bytes) -> bytes:
    return gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content


def _iso(date: str) -> str:
    try:
        return datetime.strptime(date, "%Y%m%d%H%M%S").replace(tzinfo=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return "1970-01-01T00:00:00Z"


def _files(spark, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("content")


_ARC_ROWS = pa.schema(
    [(n, pa.string()) for n in ("form", "key", "url", "date", "kind")]
    + [("head", pa.binary()), ("payload", pa.binary()), ("digest", pa.string())]
)


def _parse_arc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            rows = []
            for url, date, kind, block in arc_records(_unzipped(content.as_py())):
                http = split_http(block)
                form = "warcinfo" if url.startswith("filedesc://") else "response" if http else "resource"
                fields, head, payload = http or ({}, b"", block)
                key = fields.get("x-record-key")
                rows.append(dict(zip(_ARC_ROWS.names, (form, key, url, _iso(date), kind, head, payload, digest(payload)), strict=True)))
                if len(rows) == RECORDS_PER_FILE:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARC_ROWS)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, schema=_ARC_ROWS)


def read_arc(spark, path: str) -> DataFrame:
    """Records of the ARC files below `path` (a `form` of response, resource or warcinfo),
    with the payload's digest."""
    return _files(spark, path).mapInArrow(
        _parse_arc,
        "form string, key string, url string, date string, kind string, head binary, payload binary, digest string",
    )


def _record_id(key: str | None, own_digest: str, kind: str) -> str:
    """An id made of a record's key and payload, so that others can name it."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key} {own_digest} {kind}')}>"


def _warc_record(r: dict) -> bytes:
    """One record, of a row of `read_arc` with `first_key` and `is_response`."""
    kind = "revisit" if r["form"] == "response" and not r["is_response"] else r["form"]
    block = r["head"] + (b"" if kind == "revisit" else r["payload"])
    if kind == "warcinfo":
        written = r["payload"].decode("latin-1").replace("\r", " ").replace("\n", " ").strip()
        block = f"format: WARC File Format 1.0\r\ndescription: ARC {written}\r\n".encode()
    content_type = {"warcinfo": "application/warc-fields", "resource": r["kind"]}.get(kind, "application/http; msgtype=response")
    lines = [
        "WARC/1.0",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_record_id(r['key'], r['digest'], kind)}",
        f"WARC-Date: {r['date']}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        f"Content-Type: {content_type}",
    ]
    if kind != "warcinfo":
        lines += [f"WARC-Target-URI: {r['url']}", f"WARC-Payload-Digest: sha1:{r['digest']}"]
    if kind == "revisit":
        referred = _record_id(r["first_key"], r["digest"], "response")
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {referred}"]
        # Not of the standard: the key that the referred record's HTTP header has, and
        # the length that the header may not tell.
        lines += [f"X-Refers-To-Key: {r['first_key']}"] if r["first_key"] is not None else []
        lines += [f"X-Payload-Length: {len(r['payload'])}"]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block


def _to_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, RECORDS_PER_FILE):
            rows = [_warc_record(r) for r in batch.slice(at, RECORDS_PER_FILE).to_pylist()]
            yield pa.RecordBatch.from_pydict({"value": pa.array(rows, pa.binary())})


def _write_text(rows: DataFrame, separator: str, records: int, path: str) -> None:
    """Rows of bytes as gzipped files. A light compression: archives are written once
    and read once, and most of the time of writing was the compression's."""
    (
        rows.select(F.col("value").cast("string"))
        .write.option("lineSep", separator)
        .option("compression", "gzip")
        .option("zlib.compress.level", "BEST_SPEED")
        .option("maxRecordsPerFile", records)
        .text(path)
    )


def convert(spark, arc: str, warc: str, key_type: str = "long", least_bytes: int = 0) -> None:
    """WARC files below `warc` from the ARC files below `arc`.

    Of records with equal payloads of at least `least_bytes` bytes the one with
    the largest key is the response. A work table holds the parsed records, so
    the archives are parsed once.
    """
    work = Workspace(spark)
    records = work.save(read_arc(spark, arc), "arc")
    # Maximum per digest: one row per digest and task is shuffled. Single ones need no join.
    groups = (
        records.where("form = 'response'")
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.max(F.col("key").cast(key_type)).alias("first"))
        .where("n > 1")
        .select(F.col("digest").alias("same"), F.col("first").alias("first_key"))
    )
    groups = work.save(groups, "copies")
    own = F.col("key").cast(key_type)
    shared = F.col("same").isNotNull() & (F.octet_length("payload") >= least_bytes)
    is_response = ~shared | own.eqNullSafe(F.col("first_key"))
    rows = records.join(groups, F.col("digest") == F.col("same"), "left").select(
        *records.columns, F.col("first_key").cast("string").alias("first_key"), is_response.alias("is_response")
    )
    _write_text(rows.mapInArrow(_to_warc, "value binary"), "\r\n\r\n", RECORDS_PER_FILE, warc)
    work.clear()


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields by lower-case name and the block of each record of a WARC file."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        fields = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines[1:])}
        at = end + 4
        length = int(fields["content-length"])
        yield fields, data[at : at + length]
        at += length + 4


_WARC_COLUMNS = (
    "record_type string, record_id string, url string, date string, key string, refers_to string, "
    "payload_bytes long, payload_digest string, block_digest_ok boolean"
)


def _parse_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    text = ("record_type", "record_id", "url", "date", "key", "refers_to", "payload_digest")
    schema = pa.schema(
        [(n, pa.string()) for n in text[:6]]
        + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("block_digest_ok", pa.bool_())]
    )
    for batch in batches:
        for content in batch.column(0):
            rows = []
            for fields, block in warc_records(_unzipped(content.as_py())):
                http, _, payload = split_http(block) or ({}, b"", block)
                revisit = fields["warc-type"] == "revisit"
                rows.append(
                    {
                        "record_type": fields["warc-type"],
                        "record_id": fields["warc-record-id"],
                        "url": fields.get("warc-target-uri"),
                        "date": fields["warc-date"],
                        "key": http.get("x-record-key"),
                        "refers_to": fields.get("x-refers-to-key"),
                        "payload_bytes": int(fields["x-payload-length"]) if revisit else len(payload),
                        "payload_digest": fields["warc-payload-digest"][5:] if revisit else digest(payload),
                        "block_digest_ok": fields["warc-block-digest"] == f"sha1:{digest(block)}",
                    }
                )
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def read_warc(spark, path: str) -> DataFrame:
    """A row for each record of the WARC files below `path`; lengths and digests
    of responses are taken anew from the payload read."""
    return _files(spark, path).mapInArrow(_parse_warc, _WARC_COLUMNS)


def archive_folder(spark) -> str:
    """A new folder for one conversion, below the shared folder."""
    return f"{shared_folder(spark)}/archive-{uuid.uuid4().hex}"
