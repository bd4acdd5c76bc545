"""WARC archives: a deduplicating writer and a salvaging reader.

The writer makes one WARC/1.1 record per page, each a gzip member of its own.  Of equal
payloads the first page is a ``response``; the others are ``revisit`` records without the
payload.  Archives are written by Spark's file writer, so they go to any file system that
Spark reaches and an attempt of a lost executor leaves nothing behind.

The reader takes an archive member by member (or, uncompressed, record by record) and
checks each: the CRC and length of the member, the version line, the header, the block's
length and end, the digests of block and payload.  (Only a gzip member's CRC covers the
header of a record: in an uncompressed archive a changed header value goes unseen.)  After a failed check it searches for the next member
or version line that passes all checks, goes on there, and reports the bytes between as a
quarantined gap.
A member with several records is taken record by record: those that pass their own checks
stay, also of a member that is cut short or fails its CRC, and the gaps between are reported.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: An empty gzip member; Spark's writer puts it behind every record's member.  Readers skip it.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")
_MAGIC, _VERSION, _END = b"\x1f\x8b\x08", b"WARC/1.", b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Header fields without which a record is damaged.
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
#: Stands for a null page id; it orders after all others.
_LAST = (1 << 63) - 1
#: Compressed bytes fed to the decompressor at once.
_FEED = 1 << 16


def _record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"



def _uri(url: str) -> str:
    """A URL as a header value: control characters and spaces percent-encoded."""
    return "".join(f"%{b:02X}" if b < 0x21 or b == 0x7F else chr(b) for b in url.encode()) if not url.isascii() or any(c <= " " or c == "\x7f" for c in url) else url


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One record, uncompressed.  A revisit keeps the HTTP head, which has the payload's length."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(block)}"]
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_record_id(refers_to)}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("latin-1") + _END + block + _END


def gzip_member(data: bytes, level: int = 3) -> bytes:
    tool = zlib.compressobj(level, zlib.DEFLATED, 31)
    return tool.compress(data) + tool.flush()


def write_archives(df: DataFrame, path: str, least_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", records_per_file: int = 1000,
                   id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write one record per row of ``df`` to gzip archives under ``path``.

    The payload is the text in UTF-8 (null: empty).  Of equal payloads of at least ``least_bytes`` bytes the row with the smallest id is the
    response and the others revisit it; shorter ones are all responses.  A null id orders last; rows that repeat the first id are
    responses too; a null URL leaves its header out; other columns are ignored."""
    rows = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("key"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    light = rows.select("key", "sha")
    first = light.groupBy("sha").agg(F.min("key").alias("first"))
    roles = light.distinct().join(first, "sha").select("key", "sha", "first")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, size = [], 0
            for row in zip(*(batch.column(i) for i in range(4))):
                key, url, payload, first_key = (x.as_py() for x in row)
                revisit = first_key != key and len(payload) >= least_bytes
                record = build_record(None if key == _LAST else key, url, payload, base32_sha1(payload), first_key, revisit, date)
                out.append(gzip_member(record))
                size += len(out[-1])
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    members = rows.join(roles, ["key", "sha"]).select("key", "url", "payload", "first").mapInArrow(build, "member binary")
    # The text writer copies the bytes of a row and then those of the separator; the charset makes the separator bytes.
    members.select(F.col("member").cast("string").alias("value")).write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option(
        "encoding", "ISO-8859-1").option("maxRecordsPerFile", records_per_file).option("compression", "none").text(path)


class Damaged(Exception):
    """A check of a member or record failed."""


def read_member(data: bytes, at: int) -> tuple[bytes, int, str | None]:
    """Content and end of the gzip member that starts at ``at``, and why it is damaged (then the content up to the damage)."""
    tool, parts, pos = zlib.decompressobj(31), [], at
    view = memoryview(data)
    try:
        while not tool.eof:
            chunk = view[pos:pos + _FEED]
            if not len(chunk):
                return b"".join(parts), pos, "member cut short"
            parts.append(tool.decompress(chunk))
            pos += len(chunk)
    except zlib.error as e:
        return *_before_damage(view, at, pos), f"member: {str(e)[:80]}"
    return b"".join(parts), pos - len(tool.unused_data), None


def _before_damage(view: memoryview, at: int, bad: int) -> tuple[bytes, int]:
    """Content of a member up to the byte that fails, which lies in the feed from ``bad`` on, and that byte's place: a feed that
    fails gives nothing, so it is fed again byte by byte."""
    tool, parts = zlib.decompressobj(31), []
    for pos in range(at, bad, _FEED):
        parts.append(tool.decompress(view[pos:pos + _FEED]))
    for pos in range(bad, min(bad + _FEED, len(view))):
        try:
            parts.append(tool.decompress(view[pos:pos + 1]))
        except zlib.error:
            return b"".join(parts), pos + 1
    return b"".join(parts), min(bad + _FEED, len(view))


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Header fields, block and end of the record whose version line is at ``at``; every check must pass."""
    if data[at:at + len(_VERSION)] != _VERSION:
        raise Damaged("no version line")
    stop = data.find(_END, at)
    if stop < 0:
        raise Damaged("header without an end")
    fields: dict[str, str] = {}
    for line in data[at:stop].decode("latin-1").split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("header line without a colon")
        fields[name.strip().lower()] = value.strip()
    if missing := [f for f in REQUIRED if f not in fields]:
        raise Damaged(f"no {missing[0]}")
    length = fields["content-length"]
    if not length.isascii() or not length.isdigit():
        raise Damaged("content length is no number")
    begin = stop + len(_END)
    end = begin + int(length)
    if data[end:end + len(_END)] != _END:
        raise Damaged("block of another length")
    block = data[begin:end]
    if fields.get("warc-block-digest", "").startswith("sha1:") and base32_sha1(block) != fields["warc-block-digest"][5:]:
        raise Damaged("block digest differs")
    if fields.get("warc-type") == "response" and fields.get("warc-payload-digest", "").startswith("sha1:"):
        if base32_sha1(http_payload(block)[1]) != fields["warc-payload-digest"][5:]:
            raise Damaged("payload digest differs")
    return fields, block, end + len(_END)


def http_payload(block: bytes) -> tuple[int | None, bytes]:
    """Length given in the HTTP head, and the body."""
    stop = block.find(_END)
    if stop < 0:
        return None, block
    for line in block[:stop].split(b"\r\n"):
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return int(value), block[stop + len(_END):]
    return None, block[stop + len(_END):]


def _records(content: bytes) -> Iterator[tuple]:
    """(start, end, reason or None, header fields, block) of the records of a member's content: those that pass their checks, and
    the gaps between; after a failed check the next version line is tried."""
    at, gap, reason = 0, None, ""
    while at < len(content):
        try:
            fields, block, end = parse_record(content, at)
        except Damaged as e:
            if gap is None:
                gap, reason = at, str(e)
            at = content.find(_VERSION, at + 1)
            if at < 0:
                break
            continue
        if gap is not None:
            yield gap, at, reason, {}, b""
            gap = None
        yield at, end, None, fields, block
        at = end
    if gap is not None:
        yield gap, len(content), reason, {}, b""


def _take(data: bytes, at: int) -> tuple[list[tuple], int, str | None]:
    """Checked records and inner gaps (as rows of :func:`salvage`) of the unit at ``at`` (none in an empty member), its end, and
    why it is damaged.  The CRC of a member that holds one record is a check of that record; of a damaged member with several
    records those that pass their own checks stay."""
    if data[at:at + 3] != _MAGIC:
        fields, block, end = parse_record(data, at)
        return [(at, end, None, fields, block)], end, None
    content, end, damage = read_member(data, at)
    found = list(_records(content))
    if damage and sum(reason is None or content.startswith(_VERSION, a) for a, _, reason, *_ in found) < 2:
        return [], end, damage
    return [(at, end, reason and f"{reason} (bytes {a} to {b} of the member's content)", fields, block) for a, b, reason, fields, block in found], end, damage


def _next_start(data: bytes, at: int) -> int:
    """The next place that looks like a member or a version line (not only at the start of a line: what went before
    may be cut off)."""
    return min((x for x in (data.find(_MAGIC, at), data.find(_VERSION, at)) if x >= 0), default=len(data))


def salvage(data: bytes) -> Iterator[tuple]:
    """(start, end, reason or None, header fields, block): records that pass all checks, and gaps with the first failed check.
    Records and gaps inside a gzip member have the member's bytes (up to the damage) as start and end."""
    at, gap, reason = 0, None, ""
    while at < len(data):
        try:
            found, end, damage = _take(data, at)
        except Damaged as e:
            found, end, damage = [], at, str(e)
        if gap is not None and (found or not damage):
            yield gap, at, reason, {}, b""
            gap = None
        yield from found
        if damage:
            if gap is None:
                gap, reason = at, damage
            at = _next_start(data, at + 1)
        else:
            at = end
    if gap is not None:
        yield gap, len(data), reason, {}, b""


_READ = ("file string, begin long, end long, gap string, warc_type string, record_id string, target_uri string, refers_to string, "
         "payload_bytes long, payload_digest string, payload binary")


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Every record and every quarantined gap of the archives under ``path``, one row each.

    ``gap`` is null for a record and the failed check for a gap; ``begin`` and ``end`` are bytes of the file.  ``payload_bytes`` and
    ``payload_digest`` are those of the full payload: of the stored one for responses, from the header for revisits.  A file
    is read by one task; the writer's ``records_per_file`` bounds it.  An empty folder gives an empty result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "begin", "end", "gap", "warc_type", "record_id", "target_uri", "refers_to", "payload_bytes", "payload_digest", "payload"]
        types = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.binary()]

        def pack(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1)):
                rows, size = [], 0
                for begin, end, reason, fields, block in salvage(content.as_py()):
                    length, payload = http_payload(block)
                    kind = fields.get("warc-type")
                    if kind == "response":
                        length, digest = len(payload), base32_sha1(payload)
                    else:
                        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    rows.append((file.as_py(), begin, end, reason, kind, fields.get("warc-record-id"), fields.get("warc-target-uri"),
                                 fields.get("warc-refers-to"), length, digest, payload if with_payload else None))
                    size += len(payload) if with_payload else 0
                    if size > 4 << 20 or len(rows) >= 2000:
                        yield pack(rows)
                        rows, size = [], 0
                if rows:
                    yield pack(rows)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, _READ)


def page_records(archives: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of the records (gaps left out)."""
    page = lambda c: F.regexp_extract(c, "^<urn:x-page:(-?[0-9]+)>$", 1).try_cast("long")
    return archives.filter(F.col("gap").isNull()).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"), page("refers_to").alias("refers_to"))


def op4_warc_round_trip(spark, sf_dir: str) -> DataFrame:
    """Every page to archives in the shared checkpoint folder and back through the salvaging reader."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return page_records(read_archives(spark, path, with_payload=False))


OP4_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + (((('0x' || substr(p.h, (1 + 10 * (i // 8))::INT, 10))::BIGINT >> (35 - 5 * (i % 8))::INT) & 31))::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f ON p.h = f.h
"""
