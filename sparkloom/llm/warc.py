"""WARC archives of pages, and a salvage reader.

Archives are files of one gzip member for each record. The reader checks each record; where a check fails it
looks for the next valid member or version line, in a member's content too, goes on there, and logs the bytes
between as a gap. Files are written by the executors through Arrow's file systems into a folder that all share;
a table lists the files of the tasks that succeeded, so that files of lost or repeated tasks are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = b"WARC/1.1\r\n"
VERSIONS = (b"WARC/1.0\r\n", VERSION)
CUT_OFF = "member is cut off"
DATE = "2024-01-01T00:00:00Z"
FILE_BYTES = 64 << 20
CHUNK = 1 << 20
HOT_SHARE = 1 / 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_SCHEMA = "path string, at long, until long, kind string, reason string, record_id string, url string, refers_to string, payload_digest string, payload_bytes long, payload binary"


def digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def matches(said: str | None, data: bytes) -> bool | None:
    """Whether a labelled digest is that of ``data``; None if its algorithm, or its encoding by the length, isn't known."""
    label, _, value = (said or "").partition(":")
    name = label.lower().replace("-", "")
    if name not in ("md5", "sha1", "sha256", "sha384", "sha512"):
        return None
    made, value = hashlib.new(name, data, usedforsecurity=False).digest(), value.rstrip("=")
    forms = [(made.hex(), value.lower()), (base64.b32encode(made).decode().rstrip("="), value.upper()), (base64.b64encode(made).decode().rstrip("="), value)]
    return next((right == given for right, given in forms if len(right) == len(given)), None)


def record(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    head = {"WARC-Type": kind, "WARC-Date": DATE, **fields, "WARC-Block-Digest": f"sha1:{digest(block)}", "Content-Length": str(len(block))}
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(raw: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def page_record(page: str, url: str | None, payload: bytes, payload_digest: str, refers_to: str | None) -> bytes:
    """A response, or a revisit whose HTTP header keeps the payload's length."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = {"WARC-Record-ID": f"<urn:page:{page}>", "Content-Type": "application/http;msgtype=response", "WARC-Payload-Digest": f"sha1:{payload_digest}"}
    if url is not None:
        fields["WARC-Target-URI"] = quote(url, safe="!#$%&'()*+,/:;=?@[]~")
    if refers_to is None:
        return record("response", fields, http + payload)
    return record("revisit", fields | {"WARC-Profile": PROFILE, "WARC-Refers-To": f"<urn:page:{refers_to}>"}, http)


@dataclass
class Record:
    at: int
    until: int
    fields: dict[str, str]
    block: bytes


@dataclass
class Gap:
    at: int
    until: int
    reason: str


@dataclass
class _Window:
    """Bytes of a stream from ``base`` on; what was passed is forgotten."""

    stream: object
    data: bytearray = field(default_factory=bytearray)
    base: int = 0
    ended: bool = False

    def upto(self, end: int) -> bool:
        """Whether the stream has bytes up to ``end``."""
        while self.base + len(self.data) < end and not self.ended:
            more = self.stream.read(CHUNK)
            self.ended = not more
            self.data += more
        return self.base + len(self.data) >= end

    def get(self, at: int, end: int) -> bytes:
        self.upto(end)
        return bytes(self.data[at - self.base : end - self.base])

    def forget(self, at: int) -> None:
        if at - self.base > CHUNK:
            del self.data[: at - self.base]
            self.base = at


class Damaged(Exception):
    pass


def _parse(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int, bool]:
    """Fields, block and end of the record at ``at``, and whether a digest vouches for its block; raises Damaged where a check fails."""
    if not raw.startswith(VERSIONS, at):
        raise Damaged("no version line")
    end = raw.find(b"\r\n\r\n", at)
    if end < 0:
        raise Damaged("header without end")
    fields = {}
    for line in raw[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("bad header line")
        fields[name.strip().decode("latin-1").lower()] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Damaged("no content length")
    after = end + 4 + int(length)
    if raw[after : after + 4] != b"\r\n\r\n":
        raise Damaged("block does not end where it should")
    block = raw[end + 4 : after]
    vouched = matches(fields.get("warc-block-digest"), block)
    if vouched is False:
        raise Damaged("block digest differs")
    return fields, block, after + 4, bool(vouched)


def _before_fault(opened, part: bytes) -> bytes:
    """What ``opened`` makes of ``part`` up to the fault in it."""
    out = []
    try:
        for i in range(len(part)):
            rest = part[i : i + 1]
            while made := opened.decompress(rest, 1):
                out.append(made)
                rest = opened.unconsumed_tail
    except zlib.error:
        pass
    return b"".join(out)


def _member(window: _Window, at: int) -> tuple[bytes, int, str | None]:
    """Content, end and fault of the gzip member at ``at``; content and end are those before the fault, if there is one."""
    opened, out, here = zlib.decompressobj(31), [], at
    while not opened.eof:
        part = window.get(here, here + 65536)
        if not part:
            return b"".join(out), here, CUT_OFF
        before = opened.copy()
        try:
            out.append(opened.decompress(part))
        except zlib.error as e:
            return b"".join([*out, _before_fault(before, part)]), here, f"member: {e}"
        here += len(part)
    return b"".join(out), here - len(opened.unused_data), None


def _consumed(window: _Window, at: int, size: int) -> int:
    """Where the bytes end that make the first ``size`` bytes, but for the last, of the content of the member at ``at``;
    with the last, zlib would go on to what follows it."""
    opened, here, left = zlib.decompressobj(31), at, size - 1
    while left > 0:
        part = window.get(here, here + 65536)
        left -= len(opened.decompress(part, left))
        here += len(part) - len(opened.unconsumed_tail)
    return here


def _version(raw: bytes, at: int) -> int:
    """The first version line from ``at`` on, or the end."""
    found = [i for mark in VERSIONS if (i := raw.find(mark, at)) >= 0]
    return min(found, default=len(raw))


def _contents(raw: bytes, fault: str | None) -> Iterator[tuple[int, int, dict[str, str], bytes] | tuple[int, int, str]]:
    """Records of a member's content (start, end, fields, block) and the gaps (start, end, reason) between them.

    After a fault other than a cut any byte may be wrong, so that a record without a digest isn't taken.
    """
    here, bad = 0, None
    while here < len(raw):
        try:
            fields, block, end, vouched = _parse(raw, here)
            if not vouched and fault not in (None, CUT_OFF):
                raise Damaged(f"no digest to go by; {fault}")
        except Damaged as e:
            bad = bad or (here, str(e))
            here = _version(raw, here + 1)
            continue
        if bad:
            yield bad[0], here, bad[1]
            bad = None
        yield here, end, fields, block
        here = end
    if bad:
        yield bad[0], here, bad[1]


def _plain(window: _Window, at: int) -> tuple[bytes, int]:
    """The plain record at ``at`` and its end."""
    size = 65536
    while True:
        raw = window.get(at, at + size)
        head = raw.find(b"\r\n\r\n")
        if head >= 0 or len(raw) < size:
            break
        size *= 2
    fields = [x.partition(b":")[2].strip() for x in raw[: max(head, 0)].split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if head < 0 or not fields or not fields[0].isdigit():
        raise Damaged("bad header")
    end = at + head + 4 + int(fields[0]) + 4
    if not window.upto(end):
        raise Damaged("record is cut off")
    return window.get(at, end), end


def _opens(window: _Window, at: int) -> bool:
    """Whether a record seems to begin at ``at``."""
    raw = window.get(at, at + 512)
    if raw.startswith(VERSIONS):
        return True
    if not raw.startswith(b"\x1f\x8b\x08"):
        return False
    try:
        return zlib.decompressobj(31).decompress(raw, 8).startswith(b"WARC/1.")
    except zlib.error:
        return False


def _next(window: _Window, at: int) -> int | None:
    """The first place from ``at`` on where a record seems to begin."""
    while True:
        window.upto(at + CHUNK)
        found = [i for mark in (b"\x1f\x8b\x08", b"WARC/1.") if (i := window.data.find(mark, at - window.base)) >= 0]
        if found:
            at = window.base + min(found)
            if _opens(window, at):
                return at
            at += 1
        elif window.ended:
            return None
        else:
            at = max(at, window.base + len(window.data) - 6)
            window.forget(at)


def _of_member(window: _Window, at: int) -> Iterator[Record | Gap]:
    """Records and gaps of the gzip member at ``at``; the last ends where the reader goes on."""
    raw, end, fault = _member(window, at)
    found = _contents(raw, fault)
    if fault:
        found = list(found)
        good = max((x[1] for x in found if len(x) == 4), default=0)
        while found and found[-1][1] > good:
            found.pop()
        end = _consumed(window, at, good)
    for x in found:
        if len(x) == 4:
            yield Record(at, end, *x[2:])
        else:
            yield Gap(at, end, f"{x[2]} (bytes {x[0]} to {x[1]} of the member's content)")
    if fault:
        later = _next(window, max(end, at + 1))
        yield Gap(end, window.base + len(window.data) if later is None else later, fault)
    elif not raw:
        yield Gap(at, end, "empty member")


def salvage(stream) -> Iterator[Record | Gap]:
    """All records of an archive that pass the checks, and the gaps between them, in order.

    Memory holds one record or member. The records and gaps of a member have the member's place; of a damaged one the
    records that were decompressed before the damage have the place up to the last of them, and a gap follows. Where a
    member's own check fails, those of its records that have no block digest are gaps.
    """
    window, at = _Window(stream), 0
    while window.upto(at + 1):
        window.forget(at)
        if window.get(at, at + 2) == b"\x1f\x8b":
            for x in _of_member(window, at):
                yield x
                last = x.until
            at = last
            continue
        try:
            raw, _ = _plain(window, at)
            fields, block, size, _ = _parse(raw)
            yield Record(at, at + size, fields, block)
            at += size
        except Damaged as e:
            start, later = at, _next(window, at + 1)
            at = window.base + len(window.data) if later is None else later
            yield Gap(start, at, str(e))


def _at(spark: SparkSession, folder: str) -> str:
    """The folder as an address on the file system that Spark itself would use for it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    whole = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return whole if "://" in whole else whole.replace(":/", ":///", 1)


def _write(folder: str):
    """``folder``: an address with its file system, as ``_at`` gives it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        stream, paths, sizes, counts, size = None, [], [], [], 0
        for batch in batches:
            for page, url, payload, refers, revisit in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to", "revisit")), strict=True):
                raw = payload.as_buffer().to_pybytes() if payload.is_valid else b""
                if stream is None:
                    paths.append(f"{base}/{uuid.uuid4().hex}.warc.gz")
                    stream, size = system.open_output_stream(paths[-1], compression=None), 0
                    counts.append(0)
                    sizes.append(0)
                    stream.write(member(record("warcinfo", {"WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n")))
                name = str(page.as_py()) if page.is_valid else ""
                size += stream.write(member(page_record(name, url.as_py(), raw, digest(raw), str(refers.as_py()) if revisit.as_py() else None)))
                counts[-1] += 1
                sizes[-1] = size
                if size >= FILE_BYTES:
                    stream.close()
                    stream = None
        if stream is not None:
            stream.close()
        if paths:
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], names=["path", "records", "bytes"])

    return run


def write_warc(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Writes a record for every row of ``pages`` (page_id, url, html) and lists the files: path, records, bytes.

    The payload is the html in UTF-8; null is empty. Of the rows with equal payloads of ``least_bytes`` bytes or
    more, those with the smallest page_id are responses and the others revisits that refer to it; rows without
    page_id, and smaller payloads, are responses. Other columns are ignored. Repeated rows are records of their own; an empty
    table writes no file. ``folder`` without a scheme is on Spark's default file system. The list is lazy: save it.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    # Payloads of over HOT_SHARE of the rows are fewer than its inverse; broadcast, they need no shuffle by their digest.
    first = rows.filter(F.length("payload") >= least_bytes).groupBy("sha").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
    hot = F.col("n") > pages.count() * HOT_SHARE
    often, rarer = F.broadcast(first.filter(hot).drop("n")), first.filter(~hot).drop("n")
    rows = rows.join(often, "sha").unionByName(rows.join(often.select("sha"), "sha", "left_anti").join(rarer, "sha", "left")).withColumn("revisit", F.coalesce(F.col("page_id") > F.col("first_id"), F.lit(False)))
    rows = rows.select("page_id", "url", "payload", F.col("first_id").alias("refers_to"), "revisit")
    return rows.mapInArrow(_write(_at(pages.sparkSession, folder)), "path string, records long, bytes long")


def _http(block: bytes) -> tuple[int | None, bytes]:
    """The payload's length by the HTTP header, and the payload that is there."""
    head, _, payload = block.partition(b"\r\n\r\n")
    said = [x.partition(b":")[2].strip() for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    return (int(said[0]) if said and said[0].isdigit() else None), payload


def _read(folder: str, with_payload: bool):
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    types = [kinds[x.split()[1]] for x in READ_SCHEMA.split(", ")]

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        system = fs.FileSystem.from_uri(folder)[0]
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with system.open_input_stream(path, compression=None) as stream:
                    for x in salvage(stream):
                        if isinstance(x, Gap):
                            rows.append((path, x.at, x.until, "gap", x.reason, *[None] * 6))
                            continue
                        kind, of = x.fields.get("warc-type"), x.fields.get
                        length, payload = _http(x.block) if kind in ("response", "revisit") else (None, x.block)
                        said = (of("warc-payload-digest") or "").removeprefix("sha1:") or None
                        if kind == "response" and matches(of("warc-payload-digest"), payload) is False:
                            rows.append((path, x.at, x.until, "gap", "payload digest differs", *[None] * 6))
                            continue
                        length = len(payload) if kind != "revisit" else length
                        rows.append((path, x.at, x.until, kind, None, of("warc-record-id"), of("warc-target-uri"), of("warc-refers-to"), said, length, payload if with_payload else None))
                        size += len(payload) if with_payload else 0
                        if len(rows) >= 1000 or size >= 8 << 20:
                            yield flush(rows)
                            rows, size = [], 0
        if rows:
            yield flush(rows)

    return run


def read_warc(files: DataFrame, folder: str | None = None, with_payload: bool = True) -> DataFrame:
    """Records and gaps of the archives that ``files`` (path) lists; ``folder`` names their file system, Spark's own
    default without a scheme or without a folder.

    A row for each record (kind is its type) or gap (kind ``gap``, with the reason), by READ_SCHEMA. Damage costs the records
    it hits; in a gzip member of several records also those that can't be decompressed after it, or have no digest (``salvage``).
    Digests of an unknown algorithm or encoding aren't checked. A missing file is an error. One task reads a file.
    """
    spark = files.sparkSession
    spread = files.select("path").repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1))
    return spread.mapInArrow(_read(_at(spark, folder or "/"), with_payload), READ_SCHEMA)
