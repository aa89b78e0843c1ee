r"""Legacy ARC archives to WARC, and WARC archives as files.

An ARC archive starts with a version block, whose second line names the version; every record is a header line,
of 5 fields in version 1 and 10 in version 2, and as many bytes as its last field declares. ``convert`` turns each
record into the fields of the equivalent WARC record: an identifier derived from the content, an ISO time stamp, a type, and
SHA-1 digests of block and payload. Archives are rows of bytes of a bounded size; WARC archives are written by Spark's own
writer, one file each, every record a gzip member, and read back by declared lengths.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .common import table

ARCHIVE_BYTES = 4_000_000
#: Field names of a record's header line by version (fixed by the ARC format).
FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "status", "checksum", "location", "offset", "filename", "length"),
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
RECORD = "key bigint, url string, date string, type string, record_id string, head binary, payload binary, n bigint, digest string"


def base32_sha1(data) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{key}|{digest}')}>"


def iso_date(stamp: str) -> str:
    """ARC time stamp (14 digits, or 12 without seconds) in ISO form; the epoch if it is neither."""
    stamp = stamp + "00" if len(stamp) == 12 else stamp
    if len(stamp) != 14 or not stamp.isdigit():
        return "1970-01-01T00:00:00Z"
    return f"{stamp[:4]}-{stamp[4:6]}-{stamp[6:8]}T{stamp[8:10]}:{stamp[10:12]}:{stamp[12:]}Z"


def header_uri(url: str | None) -> str:
    """A URL for a header line: blanks and control characters percent-encoded, ``about:blank`` for none."""
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "") or "about:blank"


# -- ARC ---------------------------------------------------------------------------------------

def arc_record(version: int, url: str, block: bytes, date: str, kind: str = "text/html") -> bytes:
    if version == 1:
        line = f"{url} 0.0.0.0 {date} {kind} {len(block)}\n"
    else:
        line = f"{url} 0.0.0.0 {date} {kind} 200 {hashlib.md5(block).hexdigest()} - 0 - {len(block)}\n"
    return line.encode() + block


def arc_start(version: int, date: str) -> bytes:
    names = "URL IP-address Archive-date Content-type "
    names += "Archive-length" if version == 1 else "Result-code Checksum Location Offset Filename Archive-length"
    block = f"{version} 0 archive\n{names}\n".encode()
    return f"filedesc://archive 0.0.0.0 {date} text/plain {len(block)}\n".encode() + block


def _arc_writer(date: str):
    schema = pa.schema([("content", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, parts, size = 0, [], 0

        def archive():
            version = 1 + made % 2
            start = arc_start(version, date)
            body = b"\n".join([start, *(arc_record(version, *p, date) for p in parts)])
            return pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], schema=schema)

        for batch in batches:
            for key, url, payload in zip(*(batch.column(i).to_pylist() for i in range(3))):
                payload = payload or b""
                mark = "" if key is None else key
                head = (
                    f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-ID: {mark}\r\n"
                    f"Content-Length: {len(payload)}\r\n\r\n"
                ).encode()
                parts.append((header_uri(url), head + payload))
                size += len(payload) + 512
                if size >= ARCHIVE_BYTES:
                    yield archive()
                    made, parts, size = made + 1, [], 0
        if parts:
            yield archive()

    return run


def pages_to_arc(
    pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", date: str = "20240101000000"
) -> DataFrame:
    """Archives (column ``content``) of all pages, versions 1 and 2 in turn; a null page is empty."""
    rows = pages.select(F.col(key).cast("bigint"), F.col(url), F.col(html).cast("binary"))
    return rows.mapInArrow(_arc_writer(date), "content binary")


def parse_arc(content: bytes) -> Iterator[tuple[dict, memoryview]]:
    """Header fields and block of each record, by the declared lengths; the version block is left out.

    Raises ValueError on a header that does not fit the version and on a record cut short.
    """
    view, at, version = memoryview(content), 0, 0
    while at < len(content):
        end = content.find(b"\n", at)
        line = content[at : end if end >= 0 else len(content)]
        if not line.strip():
            at += len(line) + 1
            continue
        names = FIELDS[version or 1]
        values = line.decode("utf-8", "surrogateescape").rsplit(" ", len(names) - 1)
        if len(values) != len(names) or not values[-1].strip().isdigit():
            raise ValueError(f"not an ARC header line at byte {at}")
        fields = dict(zip(names, values))
        start, stop = end + 1, end + 1 + int(fields["length"])
        if stop > len(content):
            raise ValueError(f"ARC record at byte {at} is cut short")
        if not version:
            if not fields["url"].startswith("filedesc:"):
                raise ValueError("an ARC archive starts with a version block")
            version = int(content[start : start + 1])
            if version not in FIELDS:
                raise ValueError(f"ARC version {version} is not known")
        else:
            yield fields, view[start:stop]
        at = stop


def http_parts(block: memoryview) -> tuple[bytes, memoryview]:
    """Head (with its empty line) and body of an HTTP message; all is body if there is no head."""
    if bytes(block[:5]) != b"HTTP/":
        return b"", block
    window = bytes(block[:65536])
    end = window.find(b"\r\n\r\n")
    if end < 0:
        window = bytes(block)
        end = window.find(b"\r\n\r\n")
    return (b"", block) if end < 0 else (window[: end + 4], block[end + 4 :])


def header_values(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; the first line is skipped."""
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if k}


def _converter(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = []
                for fields, block in parse_arc(batch.column(0)[i].as_py()):
                    head, payload = http_parts(block)
                    mark = header_values(head).get("x-page-id", "")
                    digest = base32_sha1(payload)
                    key = int(mark) if mark.lstrip("-").isdigit() else None
                    rows.append((
                        key, fields["url"], iso_date(fields["date"]), "response" if head else "resource",
                        record_id(fields["url"] if key is None else key, digest), head, bytes(payload), len(payload), digest,
                    ))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                    )

    return run


def convert(archives: DataFrame, content: str = "content") -> DataFrame:
    """The WARC fields (``RECORD``) of every record of ARC archives; see ``parse_arc`` for damaged ones."""
    schema = pa.schema([
        ("key", pa.int64()), ("url", pa.string()), ("date", pa.string()), ("type", pa.string()), ("record_id", pa.string()),
        ("head", pa.binary()), ("payload", pa.binary()), ("n", pa.int64()), ("digest", pa.string()),
    ])
    return archives.select(content).mapInArrow(_converter(schema), RECORD)


def with_revisits(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Add ``refers_to``: the smallest key among records of equal payload, where that is not the record's own.

    Payloads are equal if digest and length are. Only keys and digests are grouped; a digest that many records
    share is combined before the shuffle. A record without a key revisits one with a key. Payloads under
    ``least_bytes`` refer to nothing.
    """
    firsts = materialize(
        records.where(F.col("n") >= least_bytes).groupBy("digest", "n")
        .agg(F.min("key").alias("first"), F.count("*").alias("same"))
        .where("same > 1 AND first IS NOT NULL").select("digest", "n", "first"),
        "firsts",
    )
    refers = F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first"))
    return records.join(firsts, ["digest", "n"], "left").withColumn("refers_to", refers).drop("first")


# -- WARC --------------------------------------------------------------------------------------

def warc_record(key, url, date, kind, identifier, head, payload, n, digest, refers_to) -> bytes:
    """A record without its closing blank lines; a revisit keeps the HTTP head and drops the payload."""
    block = head if refers_to is not None else head + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else kind}", f"WARC-Record-ID: {identifier}",
        f"WARC-Date: {date}", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{base32_sha1(block)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}",
                  f"X-Refers-To-Page-ID: {refers_to}"]
    if key is not None:
        lines.append(f"X-Page-ID: {key}")
    content = "application/http; msgtype=response" if head else "application/octet-stream"
    lines += [f"Content-Type: {content}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def _warc_writer():
    schema = pa.schema([("content", pa.binary())])

    def member(data: bytes) -> bytes:
        squeeze = zlib.compressobj(1, wbits=31)
        return squeeze.compress(data + b"\r\n\r\n") + squeeze.flush()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
                parts.append(member(warc_record(*row)))
                size += len(row[6] or b"") + 512
                if size >= ARCHIVE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], schema=schema)
                    parts, size = [], 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(parts)], pa.binary())], schema=schema)

    return run


def write_warc(records: DataFrame, path: str) -> None:
    """Write records (``RECORD`` and ``refers_to``) as archives under ``path``, one gzip member each.

    The text writer puts its separator behind the one row of a file; the separator here is an empty gzip
    member, so that a file is members and nothing else.
    """
    names = [c.split()[0] for c in RECORD.split(", ")] + ["refers_to"]
    blobs = records.select(*names).mapInArrow(_warc_writer(), "content binary")
    (
        blobs.select(F.col("content").cast("string")).write.option("encoding", "ISO-8859-1")
        .option("lineSep", EMPTY_MEMBER.decode("ISO-8859-1")).option("maxRecordsPerFile", 1).text(path)
    )


def parse_warc(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an archive of gzip members, by the declared lengths."""
    data = gzip.GzipFile(fileobj=io.BytesIO(content)).read()
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        fields = header_values(data[at:end])
        stop = end + 4 + int(fields["content-length"])
        if data[at : at + 5] != b"WARC/" or data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"not a WARC record at byte {at}")
        yield fields, data[end + 4 : stop]
        at = stop + 4


def _reader(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = []
                for fields, block in parse_warc(batch.column(0)[i].as_py()):
                    head, payload = http_parts(memoryview(block))
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    size = len(payload)
                    if fields["warc-type"] == "revisit":
                        size = int(header_values(head)["content-length"])
                    elif base32_sha1(payload) != digest:
                        raise ValueError(f"payload of {fields['warc-record-id']} is damaged")
                    number = [int(fields[k]) if k in fields else None for k in ("x-page-id", "x-refers-to-page-id")]
                    rows.append((number[0], fields["warc-target-uri"], size, digest, fields["warc-type"], number[1]))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                    )

    return run


def read_warc(spark, path: str) -> DataFrame:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to`` of every record under ``path``.

    Payload digests are verified. A revisit states length and digest of the payload it stands for.
    """
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()),
    ])
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(
        _reader(schema), "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    )


def pages_to_warc(pages: DataFrame, path: str, least_bytes: int = 0, **names) -> DataFrame:
    """Write all pages through ARC and the converter as WARC under ``path`` and read them back.

    Null pages have the empty payload, null URLs are ``about:blank``; repeated rows are records of their own, and
    those of one key and payload are no revisits of each other. An empty table writes no record.
    """
    write_warc(with_revisits(convert(pages_to_arc(pages, **names)), least_bytes), path)
    return read_warc(pages.sparkSession, path)


def op5_warc(spark, sf_dir):
    """All pages as WARC files, read back."""
    found = pages_to_warc(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH h AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), parts AS (
  SELECT *, [('0x' || substr(hex, i, 10))::UBIGINT for i in [1, 11, 21, 31]] AS v FROM h
), named AS (
  SELECT page_id, payload_bytes,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v[1 + k // 8] >> (5 * (7 - k % 8))) & 31)::INT + 1, 1)
                     for k in range(32)], '') AS payload_digest
  FROM parts
), firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS f FROM named
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN f = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN f <> page_id THEN f END AS refers_to
FROM firsts
"""
