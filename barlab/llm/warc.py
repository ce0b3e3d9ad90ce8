"""WARC archives: written one gzip member a record, read back in byte ranges.

Writing: each task writes archives of its own rows, one file after the other, to
a name that no other attempt uses; the table of archives, committed by Spark,
lists the files of the attempts that counted.  What a lost attempt has left is in
no table and is never read.

Reading: archives are cut into byte ranges, dealt over the tasks.  A task looks
for the gzip magic from the first byte of its range on.  A candidate counts when
the gzip header is sound and the bytes inflated first are those of a WARC record
header; it owns the records whose members start inside its range, the last of
which it reads beyond the range's end.  After a whole member (length and checksum
right) the search goes on behind it, so compressed bytes that look like the magic
are met only by a range that starts inside a member, and fail the header test.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.llm.common import short_batches, small_join, written
from barlab.session import scratch_dir

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
BLOCK = 1 << 20
#: Bytes that decide on a candidate, and bytes inflated at a time.
HEAD = 4096
PIECE = 1 << 16
#: A revisit names the payload it repeats, not its bytes.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVES = "path string, bytes long, records long"
RECORDS = ("path string, start long, length long, warc_type string, record_id string, target_uri string, page_id long, "
           "refers_to_id string, refers_to_page long, payload_digest string, payload_bytes long, payload binary, sound boolean")
_ARROW_RECORDS = pa.schema([
    ("path", pa.string()), ("start", pa.int64()), ("length", pa.int64()), ("warc_type", pa.string()), ("record_id", pa.string()),
    ("target_uri", pa.string()), ("page_id", pa.int64()), ("refers_to_id", pa.string()), ("refers_to_page", pa.int64()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("sound", pa.bool_())])


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder or file that all executors share."""
    if path.startswith("s3a://"):
        path = "s3://" + path[len("s3a://"):]
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


# --------------------------------------------------------------------------- one record
def _fields(pairs: list[tuple[str, str | None]]) -> bytes:
    return "".join(f"{name}: {value}\r\n" for name, value in pairs if value is not None).encode("utf-8")


def _uri(url: str | None) -> str | None:
    """The URL with blanks, control characters and ``%`` of no escape escaped."""
    return None if url is None else quote(url, safe="".join(map(chr, range(33, 127))))


def record_bytes(kind: str, fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    head = b"WARC/1.1\r\n" + _fields([("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))])
    return head + b"\r\n" + block + b"\r\n\r\n"


def _http(payload_bytes: int) -> bytes:
    return b"HTTP/1.1 200 OK\r\n" + _fields([("Content-Type", "text/html; charset=utf-8"),
                                             ("Content-Length", str(payload_bytes))]) + b"\r\n"


def compressed(record: bytes, level: int = 6) -> bytes:
    """One gzip member.  A record that holds such members itself may be stored as
    it is by the compressor; then it is coded so that none can be found inside."""
    for strategy in (zlib.Z_DEFAULT_STRATEGY, zlib.Z_HUFFMAN_ONLY, zlib.Z_FIXED):
        coder = zlib.compressobj(level, zlib.DEFLATED, 31, 8, strategy)
        member = coder.compress(record) + coder.flush()
        at = member.find(MAGIC, 1)
        while at >= 0 and not starts_record(member[at:at + HEAD]):
            at = member.find(MAGIC, at + 1)
        if at < 0:
            return member
    raise ValueError("a record can't be told apart from the archive it holds")


# --------------------------------------------------------------------------- finding records
def starts_record(head: bytes) -> bool:
    """Whether bytes that begin with the magic are a gzip member that begins with
    a WARC record header; ``head`` must reach well into the member."""
    if len(head) < 18 or head[3] & 0xE0:  # reserved flags are 0
        return False
    try:
        return zlib.decompressobj(31).decompress(head, len(VERSION)) == VERSION
    except zlib.error:
        return False


class _Window:
    """Reads forward in a file; ``held[i:]`` are the bytes from ``at`` on."""

    def __init__(self, file, at: int):
        self.file, self.base, self.i, self.held, self.ended = file, at, 0, b"", False
        file.seek(at)

    @property
    def at(self) -> int:
        return self.base + self.i

    def more(self) -> bool:
        got = self.file.read(BLOCK) if not self.ended else b""
        self.ended = not got
        self.held += got
        return bool(got)

    def head(self) -> bytes:
        while len(self.held) - self.i < HEAD and self.more():
            pass
        return self.held[self.i:self.i + HEAD]

    def skip(self, n: int) -> None:
        self.i += n
        if self.i >= BLOCK:
            self.held, self.base, self.i = self.held[self.i:], self.base + self.i, 0


def members(file, start: int, end: int) -> Iterator[tuple[int, int, bytes]]:
    """``(offset, compressed length, bytes)`` of the members with WARC records
    that start in ``[start, end)``.  A member that is cut off or fails its checksum
    is no record; the search goes on behind its magic."""
    window = _Window(file, start)
    while window.at < end:
        found = window.held.find(MAGIC, window.i)
        if found < 0:
            rest = len(window.held) - window.i
            window.skip(max(0, rest - len(MAGIC) + 1))  # the magic may straddle two blocks
            if not window.more():
                return
            continue
        window.skip(found - window.i)
        if window.at >= end:
            return
        whole = _whole_member(window) if starts_record(window.head()) else None
        if whole is None:
            window.skip(1)
            continue
        yield window.at, *whole
        window.skip(whole[0])


def _whole_member(window: _Window) -> tuple[int, bytes] | None:
    decoder, parts, done = zlib.decompressobj(31), [], 0
    while True:
        piece = window.held[window.i + done:window.i + done + PIECE]
        if not piece and not window.more():
            return None
        try:
            parts.append(decoder.decompress(piece))
        except zlib.error:
            return None
        done += len(piece)
        if decoder.eof:
            return done - len(decoder.unused_data), b"".join(parts)


_LINE = re.compile(rb"([^:\r\n]+):[ \t]*([^\r\n]*)\r?\n")


def parsed(data: bytes) -> dict | None:
    """Named fields (lower-case names), ``kind`` and ``block`` of a record; None
    if its header or length is wrong."""
    head_end = data.find(b"\r\n\r\n")
    if head_end < 0 or not data.startswith(VERSION):
        return None
    lines = data[data.find(b"\n") + 1:head_end + 2]
    fields = {k.strip().lower().decode("latin-1"): v.decode("utf-8", "replace").strip() for k, v in _LINE.findall(lines)}
    size = fields.get("content-length", "")
    if not size.isdigit() or len(data) < head_end + 4 + int(size):
        return None
    return fields | {"block": data[head_end + 4:head_end + 4 + int(size)]}


def _hex_digest(value: str | None) -> str | None:
    """Lower-case hex of ``sha1:...`` in base 32 or hex, else None."""
    name, _, text = (value or "").partition(":")
    if name.lower() != "sha1":
        return None
    try:
        return text.lower() if len(text) == 40 else base64.b32decode(text.upper()).hex()
    except ValueError:
        return None


def _payload(record: dict) -> tuple[bytes | None, int | None]:
    """Payload and its length: behind the HTTP header of a response; a revisit
    has no bytes and the length that its HTTP header states."""
    if not record.get("content-type", "").startswith("application/http"):
        return None, None
    head, cut, body = record["block"].partition(b"\r\n\r\n")
    if not cut:
        return None, None
    if record.get("warc-type") != "revisit":
        return body, len(body)
    stated = re.search(rb"(?im)^content-length:[ \t]*(\d+)", head)
    return None, int(stated[1]) if stated else None


def _long(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?\d{1,19}", text) else None


def record_row(path: str, start: int, length: int, data: bytes) -> tuple:
    record = parsed(data)
    if record is None:
        return (path, start, length, *[None] * 9, False)
    payload, size = _payload(record)
    stated = _hex_digest(record.get("warc-payload-digest"))
    digest = hashlib.sha1(payload).hexdigest() if payload is not None else stated
    return (path, start, length, record.get("warc-type"), record.get("warc-record-id"), record.get("warc-target-uri"),
            _long(record.get("warc-page-id")), record.get("warc-refers-to"), _long(record.get("warc-refers-to-page-id")),
            digest, size, payload, stated is None or stated == digest)


# --------------------------------------------------------------------------- tables
def page_decisions(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *,
                   min_revisit: int = 1000) -> DataFrame:
    """``page_id, url, html, sha, refers_to, revisit`` per row.  Of rows with equal
    payloads of at least ``min_revisit`` bytes the one with the largest identifier
    is the response; the copies' groups are found on 32-byte digests.  Only the
    answers of groups that have copies are joined to the rows: the large ones, of
    which there can be few, and if counting shows few also the others, by
    broadcast, else by shuffle."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        html.alias("html"))
    rows = rows.withColumn("sha", F.when(F.octet_length("html") >= min_revisit, F.unhex(F.sha2("html", 256))))
    groups = written(rows.filter("sha IS NOT NULL").groupBy("sha").agg(F.max("page_id").alias("best"), F.count("*").alias("n"))
                     .filter("n > 1"), "warc-copies")
    copies = groups.agg(F.sum("n")).first()[0] or 0
    large = max(1_000, copies // 10_000)
    hot = groups.filter(F.col("n") > large).select("sha", F.col("best").alias("hot"))
    rest = groups.filter(F.col("n") <= large).select("sha", F.col("best").alias("cold"))
    rows = rows.join(F.broadcast(hot), "sha", "left")
    # rows that are answered, or can have no copy, get a key of their own (never 32 bytes): none of them meets in one task
    alone = F.concat(F.lit("row "), F.monotonically_increasing_id().cast("string")).cast("binary")
    rows = rows.withColumn("key", F.when(F.col("sha").isNull() | F.col("hot").isNotNull(), alone).otherwise(F.col("sha")))
    rows = small_join(rows, rest.withColumnRenamed("sha", "key"), "key", "left")
    best = F.coalesce("hot", "cold")
    revisit = best.isNotNull() & ~F.col("page_id").eqNullSafe(best)
    return rows.select("page_id", "url", "html", F.when(revisit, best).alias("refers_to"), revisit.alias("revisit"))


@dataclass(frozen=True)
class _Writer:
    """Writes the rows of one task as archives of about ``archive_bytes``."""

    folder: str
    date: str
    archive_bytes: int

    def _id(self, name: str) -> str:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, self.folder.rsplit('/', 1)[-1] + ' ' + name)}>"

    def _info(self, name: str) -> bytes:
        return compressed(record_bytes("warcinfo", [
            ("WARC-Record-ID", self._id(name)), ("WARC-Date", self.date), ("WARC-Filename", name),
            ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))

    def member(self, page: int | None, url: str | None, html: bytes, refers_to: int | None, revisit: bool, place: str) -> bytes:
        digest = "sha1:" + base64.b32encode(hashlib.sha1(html).digest()).decode()
        name = lambda p: None if p is None else self._id(f"page {p}")
        fields = [("WARC-Record-ID", name(page) if page is not None and not revisit else self._id(f"row {place}")),
                  ("WARC-Date", self.date), ("WARC-Target-URI", _uri(url)), ("WARC-Payload-Digest", digest),
                  ("WARC-Page-ID", None if page is None else str(page)), ("Content-Type", "application/http; msgtype=response")]
        head = _http(len(html))
        if not revisit:
            return compressed(record_bytes("response", fields, head + html))
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", name(refers_to)),
                   ("WARC-Refers-To-Page-ID", None if refers_to is None else str(refers_to))]
        return compressed(record_bytes("revisit", fields, head))

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        attempt = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        fs, folder = file_system(self.folder)
        out, name, size, records, files = None, "", 0, 0, []
        for batch in batches:
            for k in range(batch.num_rows):
                page, url, html, refers_to, revisit = (batch.column(c)[k].as_py() for c in range(5))
                if out is None:
                    name = f"part-{attempt}-{len(files)}.warc.gz"
                    out = fs.open_output_stream(f"{folder}/{name}", compression=None)
                    size, records = out.write(self._info(name)), 1
                size += out.write(self.member(page, url, html, refers_to, revisit, f"{attempt} {len(files)} {records}"))
                records += 1
                if size >= self.archive_bytes:
                    out.close()
                    files.append((name, size, records))
                    out = None
        if out is not None:
            out.close()
            files.append((name, size, records))
        yield pa.RecordBatch.from_pydict({"path": [f"{self.folder}/{n}" for n, _, _ in files],
                                          "bytes": pa.array([s for _, s, _ in files], pa.int64()),
                                          "records": pa.array([r for _, _, r in files], pa.int64())},
                                         schema=pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())]))


def write_warc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *,
               folder: str | None = None, min_revisit: int = 1000, archive_bytes: int = 1 << 30,
               date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Writes the archives and returns their table ``path, bytes, records``.

    ``folder`` must be one that all executors share (default: a fresh one under
    ``spark.checkpoint.dir``).  One record a row, one gzip member a record, a
    ``warcinfo`` record at the head of each file.  Null html counts as empty; a
    null url is left out; a null identifier is left out and never wins against a
    known one; in a group of copies without identifiers no row can be named, so
    each is a response, as is every row that shares the largest identifier.  Very
    long payloads are one record each, held one at a time.  An empty table gives no
    archive; other columns of ``pages``, whatever their names, are ignored.
    """
    spark = pages.sparkSession
    short_batches(spark)
    folder = folder or scratch_dir(spark, "warc")
    fs, at = file_system(folder)
    fs.create_dir(at, recursive=True)
    rows = page_decisions(pages, id_col, url_col, html_col, min_revisit=min_revisit)
    return written(rows.mapInArrow(_Writer(folder, date, archive_bytes), ARCHIVES), "warc-archives")


def read_warc(spark: SparkSession, archives: DataFrame, *, range_bytes: int = 8 << 20, payloads: bool = True) -> DataFrame:
    """One row per record of the archives (``path, bytes``): place, named header
    fields, ``payload`` (null for revisits, records that are not HTTP and with
    ``payloads=False``), ``payload_bytes``, ``payload_digest`` (hex SHA-1 of the
    payload read; of revisits the one stated) and ``sound``, false where the
    digest stated differs from the payload read or the header can't be parsed.

    Works on any archives with one gzip member a record.  An archive in which a
    record holds another archive's members uncompressed, as :func:`write_warc`
    never leaves it, could give the inner records too.
    """
    step = F.lit(range_bytes).cast("long")
    ranges = (archives.filter("bytes > 0")
              .select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, step)).alias("start"), "bytes")
              .select("path", "start", F.least(F.col("start") + step, F.col("bytes")).alias("end")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                fs, at = file_system(path)
                rows, held = [], 0
                with fs.open_input_file(at) as file:
                    for offset, length, data in members(file, start, end):
                        row = record_row(path, offset, length, data)
                        rows.append(row if payloads else (*row[:11], None, row[12]))
                        held += len(data) if payloads else 0
                        if held >= 16 << 20 or len(rows) >= 4096:
                            yield _batch(rows)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows)

    dealt = ranges.repartition(max(1, ranges.count()), "path", "start") if archives.limit(1).count() else ranges
    return dealt.mapInArrow(read, RECORDS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), _ARROW_RECORDS)],
                                      schema=_ARROW_RECORDS)
