"""WARC archives: a writer that records repeated payloads once, and a salvage reader.

The writer makes one record per page. Of records with equal payloads of at least
``least`` bytes the one with the smallest id is a response and the others revisit it. A
record is one gzip member; Spark's text writer puts members into files through its
commit protocol (its line separator is an empty member), so the archives land on any
Hadoop file system and a lost executor leaves no partial file.

The reader takes whole files and checks every member (checksum and length), version
line, header block and block length, and block and payload digests (sha1, sha256 and others, in
hex or base32; a payload is the body of an HTTP message, else the block). After a failed
check it searches for the next place from which a whole record can be read, goes on
there, and logs the bytes between as a quarantined gap. The same holds inside a member that
holds several records, and for the content of a member up to its cut or failure.

Defined results: a null payload is empty; null ids are never revisited unless all ids of
a payload are null, and rows that share the smallest id are all responses; an empty table
gives an archive without records; headers are percent-encoded where a value would break
the line.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import prepared

VERSION = b"WARC/1.1\r\n"
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r?\n")
MEMBER = b"\x1f\x8b\x08"
#: A gzip member without content.
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff\x03\x00" + b"\x00" * 8
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URN = "urn:page:"
LEAST_BYTES = 100
#: Digest algorithms that the reader checks; others are passed on unchecked.
DIGESTS = ("md5", "sha1", "sha256", "sha512")
#: No archive date is known, so a fixed one keeps archives reproducible.
DATE = "1970-01-01T00:00:00Z"


def gzip_member(data: bytes, level: int = 1) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def record_bytes(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", str(len(block)))]]
    return VERSION + "".join(lines).encode() + b"\r\n" + block + b"\r\n\r\n"


def _page_record(page: object, url: str | None, payload: bytes, digest: str, first: object, size: int) -> bytes:
    headers = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", f"<{PAGE_URN}{'' if page is None else page}>"), ("WARC-Date", DATE),
        ("WARC-Target-URI", quote(url or "", safe=":/?#[]@!$&'()*+,;=%-._~")),
        ("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Payload-Length", str(size)),
    ]
    if first is None:
        return record_bytes([*headers, ("Content-Type", "text/html; charset=utf-8")], payload)
    return record_bytes([*headers, ("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{PAGE_URN}{first}>")], b"")


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
    least: int = LEAST_BYTES, records_per_file: int = 4096,
) -> None:
    """Write the pages below ``folder`` as gzip members, at most ``records_per_file`` a file."""
    prepared(pages.sparkSession)
    rows = pages.select(
        F.col(f"`{page_id}`").alias("page"), F.col(f"`{url}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{payload}`").cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.octet_length("payload").cast("long"))
    repeated = (
        rows.filter(F.col("size") >= least).groupBy("digest", "size")
        .agg(F.count("*").alias("n"), F.min("page").alias("first")).filter("n > 1 and first is not null")
        .drop("n")
    )
    marked = rows.join(repeated, ["digest", "size"], "left").select(
        "page", "url", "payload", "digest", "size",
        F.when(~F.col("page").eqNullSafe(F.col("first")), F.col("first")).alias("first"),
    )

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("page", "url", "payload", "digest", "first", "size")]
            made = [gzip_member(_page_record(*row)) for row in zip(*columns)]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["member"])

    (
        marked.mapInArrow(members, "member binary").select(F.col("member").cast("string").alias("value"))
        .write.mode("overwrite").option("lineSep", EMPTY_MEMBER.decode("latin-1"))
        .option("encoding", "ISO-8859-1").option("maxRecordsPerFile", records_per_file).text(folder)
    )


@dataclass
class Record:
    offset: int
    headers: dict[str, str]
    block: bytes


@dataclass
class Salvage:
    """Records of one archive and the byte gaps that were given up."""

    records: list[Record] = field(default_factory=list)
    gaps: list[tuple[int, int]] = field(default_factory=list)
    #: Gaps inside members that gave records: the member's place, start and end in its content.
    inner: list[tuple[int, int, int]] = field(default_factory=list)

    def quarantine(self, start: int, end: int) -> None:
        if start < end:
            if self.gaps and self.gaps[-1][1] == start:
                start = self.gaps.pop()[0]
            self.gaps.append((start, end))


def _unchunked(body: bytes) -> bytes | None:
    """A body in HTTP chunks without their framing; None if it is not whole."""
    parts, at = [], 0
    while size := re.compile(rb"([0-9A-Fa-f]+)[^\r\n]*\r?\n").match(body, at):
        n = int(size[1], 16)
        if not n:
            return b"".join(parts)
        parts.append(body[size.end() : size.end() + n])
        after = re.compile(rb"\r?\n").match(body, size.end() + n)
        if not after:
            return None
        at = after.end()
    return None


def payloads(headers: dict[str, str], block: bytes) -> list[bytes]:
    """What a payload digest may cover: the body of an HTTP message, as sent and without its chunks, or the block."""
    if not headers.get("content-type", "").lower().startswith("application/http"):
        return [block]
    head = re.compile(rb"\r?\n\r?\n").search(block)
    body = block[head.end() :] if head else b""
    if not head or not re.search(rb"(?im)^transfer-encoding:.*chunked", block[: head.start()]):
        return [body]
    whole = _unchunked(body)
    return [body] if whole is None else [body, whole]


def _has_digest(stated: str, contents: list[bytes]) -> bool | None:
    """Has one of ``contents`` the digest ``algorithm:value``, in hex or base32? None: it cannot be told."""
    name, _, value = (x.strip() for x in stated.partition(":"))
    name = name.lower().replace("-", "")
    if name not in DIGESTS or not value:
        return None
    made = [hashlib.new(name, c).digest() for c in contents]
    base32 = value.upper().rstrip("=")
    return any(m.hex() == value.lower() or base64.b32encode(m).decode().rstrip("=") == base32 for m in made)


def digests_hold(headers: dict[str, str], block: bytes) -> bool | None:
    """Do a record's block and payload digests hold? None: it has none that can be checked.

    A revisit's payload is another record's, and a segment's is a part of the whole, so
    their payload digests say nothing about the block.
    """
    verdicts = [_has_digest(headers.get("warc-block-digest", ""), [block])]
    if headers.get("warc-type") not in ("revisit", "continuation") and "warc-segment-number" not in headers:
        stated = headers.get("warc-payload-digest", "")
        verdicts.append(_has_digest(stated, payloads(headers, block)) if stated else None)
    known = [v for v in verdicts if v is not None]
    return all(known) if known else None


def parse_record(data: bytes, at: int) -> tuple[Record, int] | None:
    """The record whose version line begins at ``at`` and the place after it, if it is whole."""
    version = VERSION_LINE.match(data, at)
    head_end = re.compile(rb"\r?\n\r?\n").search(data, version.end() - 2) if version else None
    if not head_end:
        return None
    headers = {}
    for line in re.split(rb"\r?\n", data[version.end() : head_end.start()]):
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        headers[name.decode("latin-1").strip().lower()] = value.decode("utf-8", "replace").strip()
    length = headers.get("content-length", "")
    if not length.isdigit() or not headers.get("warc-type") or not headers.get("warc-record-id"):
        return None
    start, end = head_end.end(), head_end.end() + int(length)
    tail = re.compile(rb"\r?\n\r?\n").match(data, end)
    block = data[start:end]
    if not tail or len(block) != int(length):
        return None
    if digests_hold(headers, block) is False:
        return None
    return Record(at, headers, block), tail.end()


def inflate(data: bytes, at: int) -> tuple[bytes, int | None, bool]:
    """Content of the gzip member at ``at`` up to its end or first failure, the place after it
    (None if it is cut off or a check fails), and whether nothing but its end is missing."""
    view, parts = memoryview(data), []
    unpacker, position, step = zlib.decompressobj(31), at, 1 << 16
    while not unpacker.eof and position < len(data):
        try:
            parts.append(unpacker.decompress(view[position : position + step]))
        except zlib.error:
            # once more, the failing piece byte by byte
            unpacker, parts = zlib.decompressobj(31), []
            try:
                for p in range(at, position, step):
                    parts.append(unpacker.decompress(view[p : p + step]))
                for p in range(position, len(data)):
                    parts.append(unpacker.decompress(view[p : p + 1]))
            except zlib.error:
                pass
            return b"".join(parts), None, False
        position += step
    end = min(position, len(data)) - len(unpacker.unused_data) if unpacker.eof else None
    return b"".join(parts), end, True


def salvage(data: bytes) -> Salvage:
    """All whole records of an archive, plain or in gzip members, whatever is damaged.

    Inside a member the search goes on as in a plain file; what a member gives before it
    fails counts too, but after a failed check only records with a matching digest.
    """
    found, at = Salvage(), 0
    start_of = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r?\n")
    while at < len(data):
        if data.startswith(MEMBER, at):
            content, end, sound = inflate(data, at)
            records, gaps = _inside(content, at, not sound)
            found.records += records
            if records:
                found.inner += [(at, *gap) for gap in gaps]
            if end is not None and (records or not gaps):
                at = end
                continue
        else:
            plain = parse_record(data, at)
            if plain is not None:
                found.records.append(plain[0])
                at = plain[1]
                continue
        later = start_of.search(data, at + 1)
        end = later.start() if later else len(data)
        found.quarantine(at, end)
        at = end
    return found


def _inside(content: bytes, offset: int, doubtful: bool) -> tuple[list[Record], list[tuple[int, int]]]:
    """Whole records of a member's content, and the gaps between them."""
    found, at = Salvage(), 0
    while at < len(content):
        parsed = parse_record(content, at)
        if parsed is not None:
            headers, block = parsed[0].headers, parsed[0].block
            if not doubtful or digests_hold(headers, block):
                found.records.append(Record(offset, headers, block))
                at = parsed[1]
                continue
        later = VERSION_LINE.search(content, at + 1)
        end = later.start() if later else len(content)
        found.quarantine(at, end)
        at = end
    return found.records, found.gaps


READ_SCHEMA = (
    "path string, record_offset long, gap_end long, record_id string, record_type string, target_uri string, "
    "payload_digest string, payload_length long, refers_to string, block binary, inner_start long, inner_end long"
)


def read_archives(spark, folder: str, with_block: bool = True) -> DataFrame:
    """Rows of ``READ_SCHEMA``: one per record, and one with ``gap_end`` per quarantined gap.

    A gap inside a member has the member's place and ``inner_start``, ``inner_end`` in its
    content; its ``gap_end`` is that place too.

    A file is one task's row, so archives should stay well below 1 GB each.
    """
    prepared(spark)
    files = spark.read.format("binaryFile").load(folder).select("path", "content")

    def rows(path: str, data: bytes) -> Iterator[tuple]:
        found = salvage(data)
        for r in found.records:
            h, block = r.headers, r.block
            digest = h.get("warc-payload-digest", "").removeprefix("sha256:")
            size, payload = h.get("warc-payload-length", ""), payloads(h, block)[-1]
            yield (
                path, r.offset, None, h.get("warc-record-id", "").strip("<>"), h.get("warc-type"),
                unquote(h.get("warc-target-uri", "")), digest or hashlib.sha256(payload).hexdigest(),
                int(size) if size.isdigit() else len(payload),
                h["warc-refers-to"].strip("<>") if "warc-refers-to" in h else None,
                block if with_block else None, None, None,
            )
        for start, end in found.gaps:
            yield (path, start, end, *[None] * 9)
        for member, start, end in found.inner:
            yield (path, member, member, *[None] * 7, start, end)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("path", pa.string()), ("record_offset", pa.int64()), ("gap_end", pa.int64()),
            ("record_id", pa.string()), ("record_type", pa.string()), ("target_uri", pa.string()),
            ("payload_digest", pa.string()), ("payload_length", pa.int64()), ("refers_to", pa.string()),
            ("block", pa.binary()), ("inner_start", pa.int64()), ("inner_end", pa.int64()),
        ])
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                made = list(rows(path, data.as_py()))
                for at in range(0, len(made), 512):
                    part = list(zip(*made[at : at + 512]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(part, schema)], schema=schema
                    )

    return files.mapInArrow(read, READ_SCHEMA)
