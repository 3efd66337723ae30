"""WARC archives: writing with revisit records, and a reader that salvages damaged files.

Writing: every page becomes one record, each record one gzip member, so a
damaged record does not take its neighbours with it.  Pages with equal payloads
share one ``response`` record (the largest ``page_id``); the others are
``revisit`` records that refer to it.  Members are gathered up to a number of
bytes, and Spark's text writer makes an archive file of each such run: its
members, then an empty member whose last byte is the writer's line end, so the
files are plain multi-member gzip.

Reading: archives come in through Spark's binary reader, so any store that
Spark reads will do.  When a record fails a check (gzip checksum, version
line, lengths, end marks, block digest), the reader looks for the next gzip
member or version line that parses in full, goes on from there, and logs the
bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicatormart.llm._tables import BROADCAST_ROWS, new_folder, written

GZIP_MAGIC = b"\x1f\x8b\x08"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_END = b"\r\n\r\n"
#: An empty gzip member without its last byte, which is zero and comes as the writer's line end.
_FILLER = zlib.compressobj(9, zlib.DEFLATED, 31)
_FILLER = (_FILLER.compress(b"") + _FILLER.flush())[:-1]
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: Bytes at which an archive file is closed; it holds one record more at most.
FILE_BYTES = 1 << 24
#: A limit that no record reaches: Spark holds no value of 2 GB, so whatever was written is read back.
UNLIMITED = 1 << 62
_PIECE = 1 << 16


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class Record(NamedTuple):
    offset: int
    end: int
    headers: dict[str, str]
    block: bytes


class Gap(NamedTuple):
    offset: int
    end: int
    reason: str


# -- writing -----------------------------------------------------------------------------------

def _clean(value: str) -> str:
    """A header value on one line."""
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in value)


def record(kind: str, uri: str | None, record_id: str, date: str, block: bytes, content_type: str,
           payload_digest: str | None = None, refers_to: str | None = None) -> bytes:
    """The bytes of one WARC record."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}"]
    if uri is not None:
        lines.append(f"WARC-Target-URI: {_clean(uri)}")
    if payload_digest:
        lines.append(f"WARC-Payload-Digest: sha1:{payload_digest}")
    if refers_to:
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Block-Digest: sha1:{digest_of(block)}", f"Content-Type: {content_type}",
              f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + _END + block + _END


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool,
                date: str = "2024-01-01T00:00:00Z") -> bytes:
    head = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}"
            "\r\n\r\n").encode()
    return record("revisit" if revisit else "response", url, f"urn:page:{'' if page_id is None else page_id}", date,
                  head if revisit else head + payload, "application/http;msgtype=response", digest_of(payload),
                  f"urn:page:{refers_to}" if revisit else None)


def member(data: bytes, level: int = 6) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _with_response(rows: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``rows`` (page_id, url, payload) with ``response``, the page whose record holds a shared payload.

    Shared payloads that fit are broadcast.  Of more, only those in over
    1/``broadcast_rows`` of all rows are: there are fewer than
    ``broadcast_rows`` such payloads, and no key of the shuffle join that
    finds the others has more rows than that.
    """
    keyed = rows.withColumn("sha", F.sha1("payload"))
    groups = keyed.select("page_id", "sha").groupBy("sha").agg(F.max("page_id").alias("response"),
                                                               F.count("*").alias("n"))
    shared = written(groups.where("n > 1 and response is not null"), "responses")
    if shared.count() <= broadcast_rows:
        return keyed.join(F.broadcast(shared.drop("n")), "sha", "left")
    often = F.col("n") * broadcast_rows > rows.count()
    hot = shared.where(often).select("sha", F.col("response").alias("first"))
    rest = shared.where(~often).select(F.col("sha").alias("rare"), F.col("response").alias("second"))
    spread = F.when(F.col("first").isNull(), F.col("sha")).otherwise(F.concat_ws("-", F.lit("page"), "page_id"))
    return keyed.join(F.broadcast(hot), "sha", "left").withColumn("key", spread).join(
        rest, F.col("key") == F.col("rare"), "left").withColumn("response", F.coalesce("first", "second"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", file_bytes: int = FILE_BYTES,
                   date: str = "2024-01-01T00:00:00Z", broadcast_rows: int = BROADCAST_ROWS) -> None:
    """Write one record per row of ``pages`` to gzip archives below ``path``.

    A file is closed once it has ``file_bytes``; a very long payload is one
    record of any size that Spark can hold, and one task's memory holds it.  A
    null payload counts as empty; a null or odd url is left out or escaped.
    Rows of a null id never serve as the response unless all rows of that
    payload have a null id (then all are responses); repeated ids of one
    payload that has no larger id are all responses.  Columns of other names
    are ignored.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload"))
    ready = _with_response(rows, broadcast_rows).select("page_id", "url", "payload", "response")

    def pack(batches: Iterator[pa.RecordBatch]):
        held, size = [], 0

        def closed() -> pa.RecordBatch:
            return pa.record_batch({"value": pa.array([b"".join([*held, _FILLER])], pa.binary())})

        for batch in batches:
            for k in range(batch.num_rows):
                page_id, url, content, response = (batch.column(c)[k].as_py() for c in range(4))
                again = response is not None and response != page_id
                held.append(member(page_record(page_id, url, content, response, again, date)))
                size += len(held[-1])
                if size >= file_bytes:
                    yield closed()
                    held, size = [], 0
        if held:
            yield closed()

    ready.mapInArrow(pack, "value binary").select(F.col("value").cast("string").alias("value")) \
        .write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)


# -- reading -----------------------------------------------------------------------------------

def parse_record(data: bytes, at: int) -> Record:
    """The record whose version line is at ``at``; raises ``ValueError`` naming the failed check."""
    version = _VERSION.match(data, at)
    if not version:
        raise ValueError("no version line")
    head = data.find(_END, version.end() - 2)
    if head < 0:
        raise ValueError("headers do not end")
    headers: dict[str, str] = {}
    for line in data[version.end():head].split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("bad header line")
        headers[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    length = headers.get("content-length", "")
    if not length.isdigit():
        raise ValueError("no content length")
    start, end = head + 4, head + 4 + int(length)
    if data[end:end + 4] != _END:
        raise ValueError("block does not end where its length says")
    block = bytes(data[start:end])
    stated = headers.get("warc-block-digest", "")
    if stated.startswith("sha1:") and stated[5:] != digest_of(block):
        raise ValueError("block digest differs")
    return Record(at, end + 4, headers, block)


def _unpack(data: bytes, at: int, limit: int) -> tuple[bytes, int, str | None]:
    """The content of the gzip member at ``at``, the position after it and, if it fails, why.

    Of a member that fails, the content is what was unpacked before, and the
    position is ``at``.
    """
    unpacker = zlib.decompressobj(31)
    view, parts, size, pos = memoryview(data), [], 0, at
    while not unpacker.eof:
        if pos >= len(data):
            return b"".join(parts), at, "gzip member is cut off"
        piece = view[pos:pos + _PIECE]
        pos += len(piece)
        before = unpacker.copy()
        try:
            parts.append(unpacker.decompress(piece, limit - size + 1))
        except zlib.error as e:
            parts += _sound(before, piece, limit - size + 1)
            return b"".join(parts), at, f"gzip member: {e}"
        size += len(parts[-1])
        if size > limit:
            return b"".join(parts), at, "gzip member too large"
    return b"".join(parts), pos - len(unpacker.unused_data), None


def _sound(unpacker, piece: memoryview, limit: int) -> list[bytes]:
    """What ``piece`` unpacks to before its first bad byte."""
    out, step = [], max(1, len(piece) // 2)
    pos = 0
    while pos < len(piece) and limit > 0:
        before = unpacker.copy()
        try:
            out.append(unpacker.decompress(piece[pos:pos + step], limit))
        except zlib.error:
            if step == 1:
                break
            unpacker, step = before, max(1, step // 2)
            continue
        limit -= len(out[-1])
        pos += step
    return out


def _plain(data: bytes) -> Iterator[Record | Gap]:
    at = 0
    while at < len(data):
        try:
            found = parse_record(data, at)
        except ValueError as e:
            nxt = len(data)
            for mark in _VERSION.finditer(data, at + 1):
                try:
                    parse_record(data, mark.start())
                except ValueError:
                    continue
                nxt = mark.start()
                break
            yield Gap(at, nxt, str(e))
            at = nxt
            continue
        yield found
        at = found.end


def _read_member(data: bytes, at: int, limit: int) -> tuple[list[Record | Gap], int]:
    """Records of the member at ``at`` (positions of the file) and its end; a member without any record fails.

    Of a member that fails, the records before the damage count, with ``at`` as
    their end, and a gap that names the damage comes last.
    """
    content, end, why = _unpack(data, at, limit)
    found: list[Record | Gap] = []
    for x in _plain(content):
        found.append(x._replace(offset=at, end=end))
    if (content or why) and not any(isinstance(x, Record) for x in found):
        raise ValueError(why or (found[0].reason if found else "no record"))
    if why:
        while isinstance(found[-1], Gap):
            found.pop()
        found.append(Gap(at, at, why))
    return found, end


def salvage(data: bytes, limit: int = UNLIMITED) -> Iterator[Record | Gap]:
    """Records and gaps of an archive, plain or of gzip members, in file order.

    After a failed check the search goes on at the next gzip magic (or version
    line in a plain file) that leads to a whole valid record.  A gap inside a
    member has the member's positions.  An empty file has neither.
    """
    if GZIP_MAGIC not in data:
        yield from _plain(data)
        return
    at = 0
    while at < len(data):
        try:
            if data[at:at + 3] == GZIP_MAGIC:
                found, end = _read_member(data, at, limit)
            else:
                one = parse_record(data, at)
                found, end = [one], one.end
        except ValueError as e:
            nxt = _next_valid(data, at + 1, limit)
            yield Gap(at, nxt, str(e))
            at = nxt
            continue
        if end == at:                     # the member failed after some records
            nxt = _next_valid(data, at + 1, limit)
            yield from (x._replace(end=nxt) for x in found)
            at = nxt
            continue
        yield from found
        at = end


def _next_valid(data: bytes, at: int, limit: int) -> int:
    marks = re.compile(re.escape(GZIP_MAGIC) + rb"|" + _VERSION.pattern)
    for mark in marks.finditer(data, at):
        try:
            if mark.group().startswith(GZIP_MAGIC):
                if not _read_member(data, mark.start(), limit)[0]:
                    continue   # an empty member proves nothing
            else:
                parse_record(data, mark.start())
        except ValueError:
            continue
        return mark.start()
    return len(data)


RECORD_SCHEMA = ("file string, offset long, end long, gap string, type string, record_id string, uri string, "
                 "refers_to string, payload_digest string, payload_bytes long, payload binary")


def _http(block: bytes) -> tuple[int | None, bytes]:
    """Stated content length and body of an HTTP response block."""
    head, _, body = block.partition(_END)
    stated = re.search(rb"(?i)\r\ncontent-length: *(\d+)", head)
    return (int(stated.group(1)) if stated else None), body


def read_archives(spark: SparkSession, path: str, payloads: bool = True, limit: int = UNLIMITED) -> DataFrame:
    """Rows of ``RECORD_SCHEMA`` of all archives below ``path``: records, and gaps (``gap`` says why).

    A file is one task's work and is read whole.  ``limit`` guards against
    members that unpack to more bytes: they are gaps.  Files of no bytes and
    folders of no files give no rows; a folder that is not there raises.
    A response's digest and size come from its payload; a response whose
    payload differs from its stated digest is a gap.  A revisit has those of
    the payload it refers to, from its headers.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("end", pa.int64()), ("gap", pa.string()),
                            ("type", pa.string()), ("record_id", pa.string()), ("uri", pa.string()),
                            ("refers_to", pa.string()), ("payload_digest", pa.string()),
                            ("payload_bytes", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for i in range(batch.num_rows):
                name, content = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                rows: list[dict] = []
                held = 0
                for x in salvage(content, limit):
                    rows.append(_row(name, x, payloads))
                    held += len(rows[-1].get("payload") or b"")
                    if held > 1 << 23 or len(rows) >= 4096:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, RECORD_SCHEMA)


def _row(name: str, x: Record | Gap, payloads: bool) -> dict:
    row: dict = {"file": name, "offset": x.offset, "end": x.end}
    if isinstance(x, Gap):
        return row | {"gap": x.reason}
    h = x.headers
    stated = h.get("warc-payload-digest", "").removeprefix("sha1:") or None
    size, body = _http(x.block)
    row |= {"type": h.get("warc-type"), "record_id": h.get("warc-record-id", "").strip("<>"),
            "uri": h.get("warc-target-uri"), "refers_to": h.get("warc-refers-to", "").strip("<>") or None}
    if row["type"] == "revisit":
        return row | {"payload_digest": stated, "payload_bytes": size}
    digest = digest_of(body)
    if stated and stated != digest:
        return row | {"gap": "payload digest differs"}
    return row | {"payload_digest": digest, "payload_bytes": len(body), "payload": body if payloads else None}


def quarantine(records: DataFrame) -> DataFrame:
    """The log of byte ranges that could not be read."""
    return records.where("gap is not null").select("file", "offset", "end", F.col("gap").alias("reason"))


def round_trip(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               payload_col: str = "html", **options) -> DataFrame:
    """Write ``pages`` to archives in the shared scratch folder and read them back, one row per record.

    The records are counted: a gap, or another number of records than pages,
    raises.  Null ids, null and empty payloads, repeated rows and very long
    payloads are records like any other; an empty table writes no record and
    gives no rows.  ``options`` are those of ``write_archives``.
    """
    folder = new_folder(spark, "warc")
    write_archives(pages, folder, id_col, url_col, payload_col, **options)

    def page(name: str):
        return F.expr(f"cast(nullif(substring({name}, 10), '') as bigint)")

    return _whole(read_archives(spark, folder, payloads=False), pages.count()).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), page("refers_to").alias("refers_to"), "uri", "file")


def _whole(records: DataFrame, expected: int) -> DataFrame:
    """``records``, written; raises unless they are ``expected`` records without a gap."""
    kept = written(records.drop("payload"), "warc_records")
    found = kept.agg(F.count("*").alias("n"), F.count("gap").alias("gaps")).first()
    if found.gaps or found.n != expected:
        raise RuntimeError(f"{expected} records expected, {found.n - found.gaps} read, {found.gaps} gaps")
    return kept
