"""WARC records in ZIP-packaged archives, written and range-read through any file system that pyarrow reaches.

An archive is a ZIP file with stored members: archive/data.warc.gz (each record a gzip member of its own) and
indexes/index.cdx (a line for each record: offset, length). The reader parses the end-of-directory record, the ZIP64
locator and directory, finds the stored members, and reads each record by its range; nothing is extracted.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.common import cut, lean_batches, salted_join, shared_dir

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
#: An archive is closed once its records take this much.
ARCHIVE_BYTES = 24 << 20
#: Tasks that read archives at most.
READERS = 20_000
_MAX32, _MAX16 = 0xFFFFFFFF, 0xFFFF


def zip_stored(members: list[tuple[str, bytes]]) -> bytes:
    """A ZIP file of stored members, with ZIP64 sizes and directory throughout."""
    out, central = io.BytesIO(), io.BytesIO()
    for name, body in members:
        raw, at, crc = name.encode(), out.tell(), zlib.crc32(body)
        extra = struct.pack("<HHQQ", 1, 16, len(body), len(body))
        out.write(struct.pack("<4sHHHHHIIIHH", b"PK\3\4", 45, 0x800, 0, 0, 33, crc, _MAX32, _MAX32, len(raw), len(extra)) + raw + extra + body)
        extra = struct.pack("<HHQQQ", 1, 24, len(body), len(body), at)
        central.write(struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\1\2", 45, 45, 0x800, 0, 0, 33, crc, _MAX32, _MAX32, len(raw), len(extra), 0, 0, 0, 0, _MAX32) + raw + extra)
    at, body = out.tell(), central.getvalue()
    out.write(body)
    end = out.tell()
    out.write(struct.pack("<4sQHHIIQQQQ", b"PK\6\6", 44, 45, 45, 0, 0, len(members), len(members), len(body), at))
    out.write(struct.pack("<4sIQI", b"PK\6\7", 0, end, 1))
    out.write(struct.pack("<4sHHHHIIH", b"PK\5\6", 0, 0, _MAX16, _MAX16, _MAX32, _MAX32, 0))
    return out.getvalue()


def zip_members(read, size: int) -> dict[str, tuple[int, int, int]]:
    """{name: (where its local header is, stored size, method)} from the central directory; read(at, n) gives bytes."""
    tail_at = max(0, size - 22 - _MAX16)
    tail = read(tail_at, size - tail_at)
    at = tail.rfind(b"PK\5\6")
    if at < 0:
        raise ValueError("not a ZIP file: no end of central directory")
    n, length, start = struct.unpack("<HII", tail[at + 10 : at + 20])
    if n == _MAX16 or length == _MAX32 or start == _MAX32:
        sign, _, end64, _ = struct.unpack("<4sIQI", read(tail_at + at - 20, 20))
        if sign != b"PK\6\7":
            raise ValueError("ZIP64 sizes without a ZIP64 locator")
        head = read(end64, 56)
        if head[:4] != b"PK\6\6":
            raise ValueError("the ZIP64 locator points elsewhere")
        n, length, start = struct.unpack("<QQQ", head[32:56])
    body, p, out = read(start, length), 0, {}
    for _ in range(n):
        sign, _, _, _, method, _, _, _, packed, plain, ln, le, lc, _, _, _, off = struct.unpack("<4sHHHHHHIIIHHHHHII", body[p : p + 46])
        if sign != b"PK\1\2":
            raise ValueError("broken central directory")
        name = body[p + 46 : p + 46 + ln].decode()
        extra, p = body[p + 46 + ln : p + 46 + ln + le], p + 46 + ln + le + lc
        while len(extra) >= 4:
            kind, size_ = struct.unpack("<HH", extra[:4])
            if kind == 1:
                wide = list(struct.unpack(f"<{size_ // 8}Q", extra[4 : 4 + size_ // 8 * 8]))
                plain = wide.pop(0) if plain == _MAX32 else plain
                packed = wide.pop(0) if packed == _MAX32 else packed
                off = wide.pop(0) if off == _MAX32 else off
            extra = extra[4 + size_ :]
        out[name] = off, packed, method
    return out


def member_start(read, header_at: int) -> int:
    """Where the bytes of a member begin."""
    head = read(header_at, 30)
    if head[:4] != b"PK\3\4":
        raise ValueError("the directory points at no local header")
    return header_at + 30 + sum(struct.unpack("<HH", head[26:30]))


def record(page: str, url: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC/1.1 record; a revisit's block is the HTTP head alone, whose Content-Length is the payload's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Target-URI: {url}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """(WARC fields, HTTP fields, payload) of one record."""

    def fields(x: bytes) -> dict[str, str]:
        return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in x.decode().split("\r\n")[1:])}

    head, _, rest = raw.partition(b"\r\n\r\n")
    warc = fields(head)
    n = int(warc["content-length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("a record's length and its end differ")
    http, _, payload = rest[:n].partition(b"\r\n\r\n")
    return warc, fields(http), payload


def _write(folder: str, limit: int):
    def close(fs, base, parts, lines) -> pa.RecordBatch:
        name = f"{base}/{uuid.uuid4().hex}.zip"
        with fs.open_output_stream(name) as f:
            f.write(zip_stored([(DATA, b"".join(parts)), (INDEX, "".join(lines).encode())]))
        return pa.RecordBatch.from_pydict({"path": [name], "records": [len(lines)]})

    def run(batches):
        fs, base = pafs.FileSystem.from_uri(folder)
        parts, lines, at = [], [], 0
        for batch in batches:
            for page, url, html, sha, ref in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "sha1", "ref")), strict=True):
                digest = base64.b32encode(bytes.fromhex(sha)).decode()
                url = (url or "").replace("\r", "%0D").replace("\n", "%0A")
                to = None if ref is None or ref == page else str(ref)
                body = gzip.compress(record("null" if page is None else str(page), url, (html or "").encode(), digest, to), 1, mtime=0)
                parts.append(body)
                lines.append(f"{at} {len(body)}\n")
                at += len(body)
                if at >= limit:
                    yield close(fs, base, parts, lines)
                    parts, lines, at = [], [], 0
        if parts:
            yield close(fs, base, parts, lines)

    return run


def read_archive(fs: pafs.FileSystem, path: str) -> Iterator[tuple[dict[str, str], dict[str, str], bytes]]:
    """The records of one archive, each by a range read."""
    with fs.open_input_file(path) as f:

        def read(at: int, n: int) -> bytes:
            return f.read_at(n, at)

        members = zip_members(read, f.size())
        for name in (DATA, INDEX):
            if members[name][2]:
                raise ValueError(f"{name} is packed; only stored members can be read by range")
        data = member_start(read, members[DATA][0])
        index = read(member_start(read, members[INDEX][0]), members[INDEX][1]).decode()
        for line in index.splitlines():
            at, n = map(int, line.split())
            yield parse_record(gzip.decompress(read(data + at, n)))


def _read(folder: str):
    def number(x: str) -> int | None:
        x = x.removeprefix("<urn:page:").removesuffix(">")
        return None if x == "null" else int(x)

    def run(batches):
        fs, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, n in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
                rows = []
                for warc, http, payload in read_archive(fs, path):
                    digest, size = warc["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"])
                    if warc["warc-type"] == "response" and (size != len(payload) or digest != base64.b32encode(hashlib.sha1(payload).digest()).decode()):
                        raise ValueError(f"payload and digest differ in {path}")
                    ref = warc.get("warc-refers-to")
                    rows.append((number(warc["warc-record-id"]), warc["warc-target-uri"], size, digest, warc["warc-type"], number(ref) if ref else None))
                if len(rows) != n:
                    raise ValueError(f"{path} holds {len(rows)} records, not {n}")
                types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
                names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return run


def write_warc_zip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", revisit_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for each row and return the manifest (path, records), itself a written table.

    Of rows with equal payloads of at least revisit_bytes bytes, that with the largest id is the response and the
    others revisit it; rows that repeat that id are responses too. Payloads are equal if SHA-1, length and a second hash
    are, so that a collision of SHA-1 alone makes no revisit. Null html is an empty payload, null ids sort first
    and give 'null'. A record is held whole; an archive is closed at archive_bytes, so that one long page makes an
    archive of its own. Archives have names of their own, so that a task that runs again leaves no half archive behind
    in the manifest. Extra columns are not read. No rows give no archive.
    """
    lean_batches(pages.sparkSession)
    folder = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    fs, base = pafs.FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("sha1"))
    rows = rows.withColumn("same", F.struct("sha1", F.octet_length("html").alias("bytes"), F.xxhash64("html").alias("second")))
    same = rows.filter(F.octet_length("html") >= revisit_bytes).groupBy("same").agg(F.max("page_id").alias("ref"), F.count("*").alias("n")).filter("n > 1")
    marked = salted_join(rows, same, "same", "n", max(1, pages.count()), "page_id").select("page_id", "url", "html", "sha1", "ref")
    return cut(marked.mapInArrow(_write(folder, archive_bytes), "path string, records long"), "manifest")


def read_warc_zip(manifest: DataFrame, folder: str | None = None) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of all records in a manifest's archives.

    Archives are dealt over READERS tasks at most, and one is read a record at a time.
    """
    spark = manifest.sparkSession
    n = min(READERS, max(1, manifest.count()))
    return manifest.repartition(n).mapInArrow(_read(folder or shared_dir(spark)), "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long")


def op2_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_warc_zip(write_warc_zip(spark.read.parquet(f"{sf_dir}/pages.parquet"))).drop("url")


OP2_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
     d AS (SELECT page_id, strlen(h) AS b, sha1(h) AS x, max(page_id) OVER (PARTITION BY h) AS r FROM p)
SELECT page_id, CAST(b AS BIGINT) AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST((CAST('0x' || substr(x, CAST(1 + 5 * (i // 4) AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER), 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = r THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = r THEN NULL ELSE r END AS refers_to
FROM d
"""
