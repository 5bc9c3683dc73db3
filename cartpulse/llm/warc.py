"""WARC archives: a writer with revisit records, and a reader that salvages.

Archives hold one gzip member per record. The reader checks every record. Where a
check fails, it searches for the next gzip member or version line that does begin a
valid record, goes on from there, and reports the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.llm.frames import written
from cartpulse.session import work_dir

#: Payloads below this many bytes are always written in full.
REVISIT_FROM = 1000
#: An archive is closed when it holds this many bytes; a longer record is never cut.
ARCHIVE_BYTES = 16_000_000
CAPTURED = "1970-01-01T00:00:00Z"
LEVEL = 4
_MEMBER, _VERSION, _END = b"\x1f\x8b\x08", b"WARC/1.", b"\r\n\r\n"
_STEP = 1 << 18


class Record(NamedTuple):
    """A valid record: its headers, with lower-case names, and its block."""

    headers: dict[str, str]
    block: bytes


class Gap(NamedTuple):
    """Bytes that belong to no valid record."""

    start: int
    length: int
    reason: str


class Damaged(ValueError):
    """The bytes at a place do not begin a valid record."""


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record(kind: str, name: str, block: bytes, more: list[tuple[str, str]]) -> bytes:
    lines = [("WARC-Type", kind), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", CAPTURED), *more,
             ("WARC-Block-Digest", _sha1(block)), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in lines)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + _END


def page_record(page_id: int | None, url: str | None, payload: bytes,
                refers_to: int | None) -> bytes:
    """A response, or with ``refers_to`` a revisit that names the response's page."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    more = [("WARC-Payload-Digest", _sha1(payload)),
            ("Content-Type", "application/http; msgtype=response")]
    if url is not None:
        more.append(("WARC-Target-URI", " ".join(url.split())))
    name = f"urn:page:{'' if page_id is None else page_id}"
    if refers_to is None:
        return _record("response", name, http + payload, more)
    more += [("WARC-Refers-To", f"<urn:page:{refers_to}>"),
             ("WARC-Profile",
              "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    return _record("revisit", name, http, more)


def compressed(record: bytes) -> bytes:
    """The record as one gzip member."""
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def parse_record(data: bytes, at: int = 0) -> tuple[Record, int]:
    """The record that begins at ``at`` and where it ends; Damaged if a check fails."""
    stop = data.find(_END, at)
    if not data.startswith(_VERSION, at) or stop < 0:
        raise Damaged("no header")
    try:
        lines = data[at:stop].decode("utf-8").split("\r\n")[1:]
    except UnicodeDecodeError:
        raise Damaged("header is no UTF-8") from None
    pairs = [line.partition(":") for line in lines]
    if not all(colon for _, colon, _ in pairs):
        raise Damaged("bad header line")
    headers = {name.strip().lower(): value.strip() for name, _, value in pairs}
    length = headers.get("content-length", "")
    if not length.isdigit() or "warc-type" not in headers or "warc-record-id" not in headers:
        raise Damaged("missing header")
    begin = stop + len(_END)
    end = begin + int(length)
    if data[end:end + len(_END)] != _END:
        raise Damaged("wrong length")
    block = bytes(data[begin:end])
    if headers.get("warc-block-digest", _sha1(block)) != _sha1(block):
        raise Damaged("wrong block digest")
    if headers["warc-type"] == "response" and "warc-payload-digest" in headers \
            and headers["warc-payload-digest"] != _sha1(payload(block)):
        raise Damaged("wrong payload digest")
    return Record(headers, block), end + len(_END)


def payload(block: bytes) -> bytes:
    """The body of an HTTP message."""
    return block.partition(b"\r\n\r\n")[2]


def _member(data: bytes, at: int) -> tuple[bytes, int]:
    """The content of the gzip member at ``at`` and where it ends."""
    unpacker, parts, view, place = zlib.decompressobj(31), [], memoryview(data), at
    try:
        while not unpacker.eof:
            if place >= len(data):
                raise Damaged("member ends early")
            parts.append(unpacker.decompress(view[place:place + _STEP]))
            place += _STEP
    except zlib.error as error:
        raise Damaged(str(error)) from None
    return b"".join(parts), min(place, len(data)) - len(unpacker.unused_data)


def _begins(data: bytes, at: int) -> int:
    """The next place from ``at`` on that looks like a member or a version line."""
    found = [p for p in (data.find(_MEMBER, at), data.find(_VERSION, at)) if p >= 0]
    return min(found, default=len(data))


def _at(data: bytes, at: int) -> tuple[Record, int]:
    if data.startswith(_MEMBER, at):
        content, end = _member(data, at)
        record, used = parse_record(content)
        if used != len(content):
            raise Damaged("more than one record in a member")
        return record, end
    return parse_record(data, at)


def salvage(data: bytes) -> Iterator[tuple[int, Record | Gap]]:
    """Every valid record of an archive with its place, and the gaps between."""
    at, gap, reason = 0, None, ""
    while at < len(data):
        try:
            record, end = _at(data, at)
        except Damaged as error:
            if gap is None:
                gap, reason = at, str(error)
            at = _begins(data, at + 1)
            continue
        if gap is not None:
            yield gap, Gap(gap, at - gap, reason)
            gap = None
        yield at, record
        at = end
    if gap is not None:
        yield gap, Gap(gap, len(data) - gap, reason)


def _folder(path: str) -> tuple[arrow_fs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return arrow_fs.FileSystem.from_uri(path.replace("file:///", "file:/")
                                            .replace("file:/", "file:///"))
    return arrow_fs.LocalFileSystem(), path


def write_archives(pages: DataFrame, folder: str,
                   archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes (page_id, url, payload, refers_to) as archives below ``folder``.

    Returns one row per archive: name, bytes and records. Each attempt of a task writes
    names of its own and only those of the attempt that counted are returned, so what a
    lost executor has begun is never read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _folder(folder)
        system.create_dir(base, recursive=True)
        held, size, count = [], 0, 0

        def close() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.warc.gz"
            with system.open_output_stream(posixpath.join(base, name), compression=None) as out:
                for part in held:
                    out.write(part)
            made = pa.RecordBatch.from_pydict(
                {"archive": [name], "archive_bytes": [size], "records": [count]})
            held.clear()
            return made

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "refers_to")]
            for row in zip(*columns):
                if not held:
                    info = _record("warcinfo", f"urn:uuid:{uuid.uuid4()}", b"format: WARC/1.1\r\n",
                                   [("Content-Type", "application/warc-fields")])
                    held.append(compressed(info))
                    size, count = len(held[0]), 0
                held.append(compressed(page_record(*(v.as_py() for v in row))))
                size += len(held[-1])
                count += 1
                if size >= archive_bytes:
                    yield close()
        if held:
            yield close()

    return written(pages.select("page_id", "url", "payload", "refers_to").mapInArrow(
        run, "archive string, archive_bytes long, records long"), "warc-archives")


_READ = [("archive", pa.string()), ("start", pa.int64()), ("kind", pa.string()),
         ("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()),
         ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
         ("refers_to", pa.int64()), ("gap_bytes", pa.int64()), ("reason", pa.string())]


def _page(name: str | None) -> int | None:
    number = (name or "").strip("<>").removeprefix("urn:page:")
    return int(number) if number.lstrip("-").isdigit() else None


def _row(archive: str, start: int, found: Record | Gap) -> tuple:
    if isinstance(found, Gap):
        return (archive, start, "gap", *[None] * 6, found.length, found.reason)
    headers, kind = found.headers, found.headers["warc-type"]
    if kind not in ("response", "revisit"):
        return (archive, start, kind, *[None] * 8)
    body = payload(found.block) if kind == "response" else None
    if body is not None:
        size, digest = len(body), hashlib.sha1(body).hexdigest()
    else:
        http = [line.partition(b":") for line in found.block.split(b"\r\n")]
        size = next((int(v) for k, _, v in http if k.strip().lower() == b"content-length"), None)
        digest = base64.b32decode(headers["warc-payload-digest"].partition(":")[2]).hex()
    return (archive, start, kind, _page(headers["warc-record-id"]),
            headers.get("warc-target-uri"), body, size, digest,
            _page(headers.get("warc-refers-to")), None, None)


def read_archives(spark: SparkSession, archives: DataFrame, folder: str) -> DataFrame:
    """Every record and every quarantined gap of the ``archives`` (archive) in ``folder``.

    ``kind`` is the record's type or ``gap``. A gap has its place, bytes and the first
    check that failed; a response has its payload, and size and digest taken from it;
    a revisit has those of the payload it stands for. One archive is read at a time.
    """
    schema = pa.schema(_READ)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _folder(folder)
        for batch in batches:
            for archive in batch.column("archive").to_pylist():
                with system.open_input_stream(posixpath.join(base, archive),
                                              compression=None) as file:
                    data = file.read()
                rows, held = [], 0
                for start, found in salvage(data):
                    rows.append(_row(archive, start, found))
                    held += len(rows[-1][5] or b"")
                    if held > 8_000_000:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)],
                            schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    # one archive per row: deal the names evenly, there are few of them
    parts = spark.sparkContext.defaultParallelism * 4
    return archives.select("archive").repartition(parts, "archive").mapInArrow(
        run, "archive string, start long, kind string, page_id long, url string, "
             "payload binary, payload_bytes long, payload_digest string, refers_to long, "
             "gap_bytes long, reason string")


def with_revisits(pages: DataFrame, least: int = REVISIT_FROM) -> DataFrame:
    """(page_id, url, payload, refers_to): of records with equal payloads of at least
    ``least`` bytes all but that with the largest page_id refer to it.

    A null html is an empty payload. A row without a page_id refers to the response
    of its payload, if a row with a page_id has it; rows that share the largest
    page_id are responses all.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    digest, size = F.sha1("payload"), F.octet_length("payload")
    known = rows.where(size >= least).groupBy(digest.alias("digest")).agg(
        F.max("page_id").alias("holder"), F.count("*").alias("copies"))
    known = written(known.where("copies > 1 and holder is not null")
                    .select("digest", "holder"), "warc-copies")
    mine = F.when(size >= least, digest)
    return rows.withColumn("_digest", mine).join(
        known.withColumnRenamed("digest", "_digest"), "_digest", "left").select(
        "page_id", "url", "payload",
        F.when(~F.col("page_id").eqNullSafe(F.col("holder")), F.col("holder")).alias("refers_to"))


def archive_roundtrip(pages: DataFrame, least: int = REVISIT_FROM) -> DataFrame:
    """Writes a record per page, reads the archives back, and returns per page what the
    archives say: page_id, payload_bytes, payload_digest, record_type and refers_to.

    Repeated rows give repeated records; other columns play no part; an empty table
    gives no archive and no rows.
    """
    folder = f"{work_dir(pages.sparkSession, 'warc')}"
    archives = write_archives(with_revisits(pages, least), folder)
    found = read_archives(pages.sparkSession, archives, folder)
    return found.where(F.col("kind").isin("response", "revisit")).select(
        "page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"),
        "refers_to")
