"""Operator 2: web archives packaged in ZIP files.

Writing: a WARC record per page, each compressed by itself, one after the other in a stored
member ``archive/data.warc.gz``, with a stored index ``indexes/index.cdxj`` of their places; the
ZIP directories have ZIP64 fields throughout.  Tasks make archives of about ``ARCHIVE_BYTES``
and Spark's text sink writes each as a file (the line end that it adds is the archive's comment
of one byte), so that any file system works that Spark can write.

Reading: :class:`ZipArchive` reads ranges only: the end record, the ZIP64 locator and end record,
the central directory, members' local headers, the indexes, and then single records.  Nothing is
extracted.  Members under ``archive/`` hold records (compressed one by one, or plain), those under
``indexes/`` (``.cdx``, ``.cdxj``, also gzipped) their places: CDXJ lines ``key timestamp {json}`` or bare JSON, whose
``filename`` names the member where there are several.  Spark's binary-file source hands each
archive to a task; with ``seek``, for folders that every executor has mounted, tasks read
the directory and index alone, and the records' ranges are dealt over all tasks, which seek them.

Payloads that are equal (SHA-1 of all bytes) and have ``least_bytes`` or more are stored once, with
the largest page_id; the others are revisit records, which have the HTTP header only.

Defined results: a null html is an empty payload; a null url is an empty target; a null page_id
is written without a number, read as null, and revisits the largest page_id of its payload if
there is one; rows that repeat a page_id with the same payload get records of the same type;
records of other writers have a null page_id, and the digest of their payload if they name none;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import urllib.parse
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.llm import arrays
from codeloom.operators.broadcast import materialize

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Compressed bytes after which an archive is closed.
ARCHIVE_BYTES = 4 << 20
DATE, STAMP = "1970-01-01T00:00:00Z", "19700101000000"
PAGE = "urn:page:"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Signatures of ZIP structures.
LOCAL, CENTRAL, END, END64, LOCATOR = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
COMMENT = b"\n"


class ArchiveError(ValueError):
    pass


def zip_stored(members: list[tuple[str, list[bytes]]]) -> bytes:
    """A ZIP64 archive of stored members, each given by its parts; the comment is left to come."""
    out, central, at = [], [], 0
    for name, parts in members:
        raw, size, crc = name.encode(), sum(map(len, parts)), 0
        for p in parts:
            crc = zlib.crc32(p, crc)
        head = struct.pack("<IHHHHHIIIHH", LOCAL, 45, 0x800, 0, 0, 33, crc, FULL32, FULL32, len(raw), 20) + raw + struct.pack("<HHQQ", 1, 16, size, size)
        central.append(struct.pack("<IHHHHHHIIIHHHHHII", CENTRAL, 45, 45, 0x800, 0, 0, 33, crc, FULL32, FULL32, len(raw), 28, 0, 0, 0, 0, FULL32) + raw + struct.pack("<HHQQQ", 1, 24, size, size, at))
        out += [head, *parts]
        at += len(head) + size
    directory = b"".join(central)
    end64 = struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, len(members), len(members), len(directory), at)
    locator = struct.pack("<IIQI", LOCATOR, 0, at + len(directory), 1)
    end = struct.pack("<IHHHHIIH", END, 0, 0, FULL16, FULL16, FULL32, FULL32, len(COMMENT))
    return b"".join([*out, directory, end64, locator, end])


class ZipArchive:
    """Members of a ZIP file of ``size`` bytes, by ranges: ``read(offset, length)``."""

    def __init__(self, read: Callable[[int, int], bytes], size: int):
        self.read, self.size = read, size
        self.members = self._directory()

    def _exactly(self, offset: int, length: int) -> bytes:
        out = bytes(self.read(offset, length)) if 0 <= offset <= self.size - length else b""
        if len(out) != length:
            raise ArchiveError(f"bytes {offset}+{length} aren't in the archive")
        return out

    def _directory(self) -> dict[str, tuple[int, int, int, int]]:
        tail_at = max(0, self.size - 22 - FULL16)
        tail = self._exactly(tail_at, self.size - tail_at)
        at = len(tail)
        while True:   # the comment may hold the signature: take the end record whose comment ends the file
            at = tail.rfind(struct.pack("<I", END), 0, at + 3 if at < len(tail) else at)
            if at < 0:
                raise ArchiveError("no end record")
            if at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail):
                break
        n, length, offset = struct.unpack_from("<HII", tail, at + 10)
        if FULL16 == n or FULL32 in (length, offset):
            where = tail_at + at - 20
            sign, _, end64, _ = struct.unpack("<IIQI", self._exactly(where, 20)) if where >= 0 else (0,) * 4
            if sign == LOCATOR:
                sign, *_, n, length, offset = struct.unpack("<IQHHIIQQQQ", self._exactly(end64, 56))
                if sign != END64:
                    raise ArchiveError("no ZIP64 end record")
        data, members, p = self._exactly(offset, length), {}, 0
        for _ in range(n):
            if p + 46 > len(data) or struct.unpack_from("<I", data, p)[0] != CENTRAL:
                raise ArchiveError("broken central directory")
            flags, method = struct.unpack_from("<HH", data, p + 8)
            packed, size, names, extras, comments = struct.unpack_from("<IIHHH", data, p + 20)
            local = struct.unpack_from("<I", data, p + 42)[0]
            name = data[p + 46:p + 46 + names]
            extra = data[p + 46 + names:p + 46 + names + extras]
            q = 0
            while q + 4 <= len(extra):
                kind, own = struct.unpack_from("<HH", extra, q)
                if kind == 1:
                    wide = iter(struct.unpack_from(f"<{own // 8}Q", extra, q + 4))
                    try:
                        size = next(wide) if size == FULL32 else size
                        packed = next(wide) if packed == FULL32 else packed
                        local = next(wide) if local == FULL32 else local
                    except StopIteration:
                        raise ArchiveError("broken ZIP64 field") from None
                q += 4 + own
            members[name.decode("utf-8" if flags & 0x800 else "cp437")] = (method, local, packed, size)
            p += 46 + names + extras + comments
        return members

    def place(self, name: str) -> tuple[int, int]:
        """Offset and length of a stored member's bytes."""
        if name not in self.members:
            raise ArchiveError(f"no member {name}")
        method, local, packed, _ = self.members[name]
        if method:
            raise ArchiveError(f"{name} isn't stored")
        head = self._exactly(local, 30)
        if struct.unpack_from("<I", head)[0] != LOCAL:
            raise ArchiveError(f"no local header of {name}")
        names, extras = struct.unpack_from("<HH", head, 26)
        return local + 30 + names + extras, packed

    def range(self, name: str, offset: int, length: int) -> bytes:
        """Part of a stored member."""
        at, size = self.place(name)
        if not 0 <= offset <= size - length:
            raise ArchiveError(f"bytes {offset}+{length} aren't in {name}")
        return self._exactly(at + offset, length)


def _header(fields: list[tuple[str, str]]) -> bytes:
    return b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """A WARC record of a page; with ``refers_to`` a revisit record, without the payload."""
    revisit = refers_to is not None
    target = "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")
    block = b"HTTP/1.1 200 OK\r\n" + _header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))]) + b"\r\n" + (b"" if revisit else payload)
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<{PAGE}{'' if page_id is None else page_id}>"), ("WARC-Target-URI", target), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if revisit:
        fields += [("WARC-Refers-To", f"<{PAGE}{refers_to}>"), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + _header(fields) + b"\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in head.decode().split("\r\n")[1:] if line)}


def _page(uri: str | None) -> int | None:
    uri = (uri or "").strip("<>")
    number = uri.removeprefix(PAGE) if uri.startswith(PAGE) else ""
    return int(number) if number.removeprefix("-").isdecimal() else None


def parsed(data: bytes) -> dict:
    """A record's values; the payload's digest is checked."""
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found or not head.startswith(b"WARC/1."):
        raise ArchiveError("no WARC record")
    fields = _fields(head)
    length = int(fields["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ArchiveError("a record's length is wrong")
    http, _, payload = block.partition(b"\r\n\r\n") if fields.get("content-type", "").startswith("application/http") else (b"", b"", block)
    kind, _, digest = fields.get("warc-payload-digest", "").rpartition(":")
    revisit = fields["warc-type"] == "revisit"
    size = _fields(http.decode("utf-8", "replace").encode()).get("content-length", "") if http else ""
    size = int(size) if size.isdecimal() else len(payload)
    own = None if revisit else base64.b32encode(hashlib.sha1(payload).digest()).decode()
    if own and (len(payload) != size or kind == "sha1" and own != digest):
        raise ArchiveError("a payload and its length or digest don't match")
    digest = own if own and kind != "sha1" else digest
    return {"page_id": _page(fields.get("warc-record-id")), "url": fields.get("warc-target-uri", "").strip("<>"), "payload_bytes": size, "payload_digest": digest,
            "record_type": fields["warc-type"], "refers_to": _page(fields.get("warc-refers-to")), "payload": None if revisit else payload}


def archive(records: list[tuple[str, bytes]]) -> bytes:
    """A packaged archive of compressed records, each with its target."""
    lines, at = [], 0
    for target, data in records:
        entry = {"url": target, "offset": str(at), "length": str(len(data)), "filename": DATA.rpartition("/")[2]}
        lines.append(f"{sort_key(target)} {STAMP} {json.dumps(entry)}\n".encode())
        at += len(data)
    return zip_stored([(DATA, [data for _, data in records]), (INDEX, sorted(lines))])


def sort_key(url: str) -> str:
    """A URL with its host's labels in reverse order, so that an index keeps hosts together; no blanks."""
    _, found, rest = url.partition("://")
    host, slash, path = (rest if found else url).partition("/")
    key = ",".join(reversed(host.lower().split("."))) + ")" + slash + path
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in key)


def entries(zipped: ZipArchive) -> Iterator[tuple[int, int]]:
    """Offset and length in the archive of every indexed record."""
    data = {n.rpartition("/")[2]: n for n in zipped.members if n.startswith("archive/") and n.endswith((".warc", ".warc.gz"))}
    indexes = [n for n in zipped.members if n.startswith("indexes/") and n.endswith((".cdx", ".cdxj", ".cdx.gz", ".cdxj.gz"))]
    if not indexes and data:
        raise ArchiveError("no index of the records")
    places = {}
    for index in indexes:
        raw = zipped.range(index, 0, zipped.place(index)[1])
        if index.endswith(".gz"):
            out = []
            while raw:                       # gzip members, one after the other
                z = zlib.decompressobj(31)
                out.append(z.decompress(raw) + z.flush())
                raw = z.unused_data
            raw = b"".join(out)
        for line in raw.splitlines():
            at = line.find(b"{")
            if at < 0:
                continue                     # an index's own head line
            entry = json.loads(line[at:])
            if "offset" not in entry:
                continue
            name = entry.get("filename") or (next(iter(data)) if len(data) == 1 else None)
            if name is None or name.rpartition("/")[2] not in data:
                raise ArchiveError(f"no member for {entry}")
            name = data[name.rpartition("/")[2]]
            if name not in places:
                places[name] = zipped.place(name)
            start, size = places[name]
            offset, length = int(entry["offset"]), int(entry["length"])
            if not 0 <= offset <= size - length:
                raise ArchiveError(f"bytes {offset}+{length} aren't in {name}")
            yield start + offset, length


def unpacked(raw: bytes) -> bytes:
    """A record's bytes, which may be compressed."""
    return zlib.decompress(raw, wbits=31) if raw[:2] == b"\x1f\x8b" else raw


def records(zipped: ZipArchive) -> Iterator[dict]:
    """All records of a packaged archive, by its indexes."""
    for offset, length in entries(zipped):
        yield parsed(unpacked(zipped._exactly(offset, length)))


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0) -> None:
    """Write ``pages`` as packaged archives under ``path``."""
    arrays.bounded_batches(pages.sparkSession)
    p = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), F.coalesce(F.col(f"`{html}`"), F.lit("")).alias("payload"))
    p = p.withColumn("sha1", F.unhex(F.sha1(F.col("payload").cast("binary"))))
    equal = p.where(F.octet_length("payload") >= least_bytes).groupBy("sha1").agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1 and keep is not null").select("sha1", "keep")
    equal = materialize(equal, "equal_payloads")
    p = p.join(equal, "sha1", "left").select("page_id", "url", "payload", "sha1", F.when(~F.col("keep").eqNullSafe(F.col("page_id")), F.col("keep")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([archive(held)], pa.binary())], names=["archive"])

        for batch in batches:
            columns = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                page, target, payload, sha1, refers_to = (c[i].as_py() for c in columns)
                data = record(page, target, payload.encode("utf-8", "surrogatepass"), base64.b32encode(sha1).decode(), refers_to)
                z = zlib.compressobj(1, zlib.DEFLATED, 31)
                held.append((target or "", z.compress(data) + z.flush()))
                size += len(held[-1][1])
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    held, size = [], 0
        if held:
            yield closed()

    made = p.mapInArrow(arrays.released(write), "archive binary").select(F.col("archive").cast("string").alias("value"))
    made.write.option("maxRecordsPerFile", 1).mode("errorifexists").text(path)


RECORD = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()), T.StructField("payload", T.BinaryType())])


def read_archives(spark: SparkSession, path: str, payloads: bool = True, seek: bool = False) -> DataFrame:
    """Every record of the packaged archives under ``path``; payloads only where asked for.

    ``seek``: ``path`` is mounted in every executor; nothing but directories, indexes and records is read.
    """
    schema = RECORD if payloads else T.StructType(RECORD.fields[:-1])
    if seek:
        return _read_by_seeking(spark, path, schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                view = memoryview(content.as_buffer())
                rows = []
                for r in records(ZipArchive(lambda at, n, v=view: v[at:at + n], len(view))):
                    rows.append({n: r[n] for n in schema.names})
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_pylist(rows, arrow)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    kinds = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.BinaryType(): pa.binary()}
    arrow = pa.schema([(f.name, kinds[f.dataType]) for f in schema.fields])
    return spark.read.format("binaryFile").load(path).where("length > 0").select("content").mapInArrow(arrays.released(read), schema)


def _read_by_seeking(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Archives of any size: (file, offset, length) rows from the indexes, dealt over the tasks that seek them."""
    kinds = {T.LongType(): pa.int64(), T.StringType(): pa.string(), T.BinaryType(): pa.binary()}
    arrow = pa.schema([(f.name, kinds[f.dataType]) for f in schema.fields])

    def local(uri: str) -> str:
        return urllib.parse.unquote(uri.removeprefix("file://").removeprefix("file:"))

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, size in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist()):
                with open(local(uri), "rb") as f:
                    found = list(entries(ZipArchive(lambda at, n, f=f: f.seek(at) * 0 or f.read(n), size)))
                if found:
                    offsets, lengths = zip(*found)
                    yield pa.RecordBatch.from_arrays([pa.array([uri] * len(found)), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], names=["path", "offset", "length"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, name, f = [], None, None
            for r in sorted(batch.to_pylist(), key=lambda r: (r["path"], r["offset"])):
                if r["path"] != name:
                    if f:
                        f.close()
                    name, f = r["path"], open(local(r["path"]), "rb")
                f.seek(r["offset"])
                got = parsed(unpacked(f.read(r["length"])))
                rows.append({n: got[n] for n in schema.names})
            if f:
                f.close()
            yield pa.RecordBatch.from_pylist(rows, arrow)

    arrays.bounded_batches(spark)
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "length")     # no content is read
    places = files.mapInArrow(locate, "path string, offset long, length long")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return places.repartition(tasks, "path", "offset").mapInArrow(arrays.released(read), schema)
