"""WARC archives as a PySpark Python data source.

Writing: each task writes ``.warc.gz`` files of one gzip member per record into a
temporary folder; the commit moves the files of the tasks that succeeded, so a
repeated or lost task leaves no records behind. Each member's header has the
``sl`` extra field (its compressed and full length), so a reader can step over
what it doesn't want.

Reading: files are packed into partitions by size. Predicates on the record
type and the other header columns are pushed down; a record's header is parsed
first, and a payload that isn't wanted is neither inflated nor decoded.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage,
)

from .bitmap import marked
from .storage import importable, materialize

SCHEMA = "record_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, payload_length long, computed_digest string, payload binary"
#: Columns that come from the WARC header, and so can be tested before the payload is touched.
HEADERS = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest"}
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL, DATE = 3, "1970-01-01T00:00:00Z"
FILE_BYTES, BATCH_BYTES, STEP = 64 << 20, 8 << 20, 1 << 16


def filesystem(uri: str):
    """pyarrow's file system of a URI or path, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(value: str) -> str:
    """A header's value: control characters would end or break the line, so they are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def record(kind: str, record_id: str, uri: str | None, refers_to: str | None, payload: bytes) -> bytes:
    """A response with its payload, or a revisit with the HTTP header alone; digest and length are the full payload's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind != "revisit" else http
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", DATE)]
    fields += [("WARC-Target-URI", _line(uri))] if uri is not None else []
    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{refers_to}>")] if kind == "revisit" else []
    fields += [("WARC-Payload-Digest", f"sha1:{digest32(payload)}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member with the ``sl`` field."""
    deflate = zlib.compressobj(LEVEL, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    length = 24 + len(body) + 8
    head = b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff" + struct.pack("<H", 12) + b"sl" + struct.pack("<HII", 8, length & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcWriter(DataSourceArrowWriter):
    """Takes rows with record_type, record_id, target_uri, refers_to and payload."""

    def __init__(self, path: str, job: str):
        self.path, self.temp = path.rstrip("/"), f"{path.rstrip('/')}/_temporary-{job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, temp = filesystem(self.temp)
        files, out, size = [], None, 0
        try:
            for batch in iterator:
                cols = [batch.column(batch.schema.get_field_index(c)) for c in ("record_type", "record_id", "target_uri", "refers_to", "payload")]
                for row in zip(*cols, strict=True):
                    kind, rid, uri, refers, payload = (x.as_py() for x in row)
                    if out is None:
                        fs.create_dir(temp, recursive=True)
                        files.append(f"{uuid.uuid4().hex}.warc.gz")
                        out, size = fs.open_output_stream(f"{temp}/{files[-1]}", compression=None), 0
                    data = member(record(kind, rid, uri, refers, payload or b""))
                    out.write(data)
                    size += len(data)
                    if size >= FILE_BYTES:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, path = filesystem(self.path)
        temp = filesystem(self.temp)[1]
        fs.create_dir(path, recursive=True)
        with ThreadPoolExecutor(16) as pool:  # names only, but many of them
            list(pool.map(lambda name: fs.move(f"{temp}/{name}", f"{path}/{name}"), (f for m in messages if m for f in m.files)))
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow.fs import FileType

        fs, temp = filesystem(self.temp)
        if fs.get_file_info(temp).type == FileType.Directory:
            fs.delete_dir(temp)


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


def _test(f: Filter):
    """A predicate over a header value; None if this one isn't supported. A null fails all but the tests for null."""
    if isinstance(f, Not):
        inner = _test(f.child)
        return inner and (inner[0], lambda v, t=inner[1]: v is not None and not t(v))
    name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
    if name not in HEADERS:
        return None
    if isinstance(f, IsNull):
        return name, lambda v: v is None
    if isinstance(f, IsNotNull):
        return name, lambda v: v is not None
    tests = {
        EqualTo: lambda v, x: v == x, EqualNullSafe: lambda v, x: v == x, In: lambda v, x: v in x, GreaterThan: lambda v, x: v > x, GreaterThanOrEqual: lambda v, x: v >= x,
        LessThan: lambda v, x: v < x, LessThanOrEqual: lambda v, x: v <= x, StringStartsWith: lambda v, x: v.startswith(x), StringEndsWith: lambda v, x: v.endswith(x), StringContains: lambda v, x: x in v,
    }
    test = tests.get(type(f))
    value = getattr(f, "value", None)
    if test is None or value is None or isinstance(f, EqualNullSafe) and value is None:
        return None
    return name, lambda v: v is not None and test(v, value)


class _Ahead:
    """A file read forwards in steps that are kept: small members that follow each other cost one request for many, and only a jump past what is held seeks."""

    def __init__(self, file):
        self.file, self.at, self.low, self.held = file, 0, 0, b""

    def seek(self, at: int) -> None:
        self.at = at

    def read(self, most: int, least: int = 1) -> bytes:
        """Up to ``most`` bytes, at least ``least`` of them unless the file ends."""
        out = b""
        while len(out) < least:
            inside = self.at - self.low
            part = self.held[inside : inside + most - len(out)] if 0 <= inside < len(self.held) else b""
            if not part:
                if self.file.tell() != self.at:
                    self.file.seek(self.at)
                part = self.file.read(STEP)
                self.low, self.held = self.at - len(out), out + part
                part = part[: most - len(out)]
                if not part:
                    break
            out += part
            self.at += len(part)
        return out


class _Gzip:
    """Members of a gzip file, one at a time; ``head`` inflates no more than it must."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at = _Ahead(file), size, 0

    def start(self) -> bool:
        if self.at >= self.size:
            return False
        self.file.seek(self.at)
        self.raw, self.out, self.length = self.file.read(STEP, 64), b"", None
        if self.raw[:2] != b"\x1f\x8b":
            raise ValueError(f"no gzip member at byte {self.at}")
        if self.raw[3] & 4 and self.raw[12:14] == b"sl":
            self.length = struct.unpack_from("<I", self.raw, 16)[0] or None
        self.read, self.inflate = len(self.raw), zlib.decompressobj(31)
        return True

    def more(self, want: int) -> bool:
        """Inflates about ``want`` bytes more; false at the member's end."""
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail or self.raw
        self.raw = b""
        if not data:
            data = self.file.read(STEP)
            self.read += len(data)
            if not data:
                raise EOFError("a gzip member is cut off")
        self.out += self.inflate.decompress(data, want)
        return True

    def head(self, end: bytes = b"\r\n\r\n") -> bytes:
        while end not in self.out and self.more(4096):
            pass
        return self.out.partition(end)[0]

    def rest(self) -> bytes:
        parts = [self.out]
        self.out = b""
        while self.more(1 << 20):
            parts.append(self.out)
            self.out = b""
        return b"".join(parts)

    def next(self) -> None:
        if self.length:
            self.at += self.length
            return
        while self.more(1 << 20):
            self.out = b""
        self.at += self.read - len(self.inflate.unused_data)


class _Plain:
    """Records of a file that isn't compressed, with the same steps."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at = file, size, 0

    def start(self) -> bool:
        self.out = b""
        self.file.seek(self.at)
        return self.at < self.size

    def head(self) -> bytes:
        while b"\r\n\r\n" not in self.out:
            data = self.file.read(4096)
            if not data:
                raise EOFError("a record's header is cut off")
            self.out += data
        top = self.out.partition(b"\r\n\r\n")[0]
        self.length = len(top) + 4 + int(_fields(top).get("content-length", 0))
        return top

    def rest(self) -> bytes:
        return self.out[: self.length] + self.file.read(max(0, self.length - len(self.out)))

    def next(self) -> None:
        self.at += self.length + 4


def _fields(head: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a line that begins with white space goes on with the one before."""
    out: dict[str, str] = {}
    name = ""
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def _value(name: str, fields: dict[str, str]) -> str | None:
    v = fields.get(HEADERS[name])
    if v is None:
        return None
    if name in ("record_id", "refers_to"):
        return v.removeprefix("<").removesuffix(">")
    return v.split(":", 1)[-1] if name == "payload_digest" else v


class WarcReader(DataSourceReader):
    def __init__(self, path: str, payload: str, split_bytes: int):
        self.path, self.payload, self.split_bytes, self.tests = path, payload, split_bytes, []

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        for f in filters:
            test = _test(f)
            if test is None:
                yield f
            else:
                self.tests.append((test[0], f))

    def partitions(self) -> list[Files]:
        from pyarrow.fs import FileSelector, FileType

        fs, path = filesystem(self.path)
        found = fs.get_file_info(FileSelector(path, recursive=True)) if fs.get_file_info(path).type == FileType.Directory else [fs.get_file_info(path)]
        hidden = lambda x: any(p[:1] in ("_", ".") for p in x.path[len(path) :].split("/"))
        packs, room = [], 0
        for f in sorted((x for x in found if x.type == FileType.File and x.path.endswith((".warc", ".warc.gz")) and not hidden(x)), key=lambda x: x.path):
            if not packs or f.size > room:
                packs.append([])
                room = self.split_bytes
            packs[-1].append(f.path)
            room -= f.size
        return [Files(tuple(p)) for p in packs] or [Files(())]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(self.path)
        tests = [(name, _test(f)[1]) for name, f in self.tests]
        names = [x.split(" ")[0] for x in SCHEMA.split(", ")]
        types = [pa.int64() if "long" in x else pa.binary() if "binary" in x else pa.string() for x in SCHEMA.split(", ")]
        rows, size = [], 0
        pack = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
        for path in partition.paths:
            with fs.open_input_file(path) as file:
                records = (_Gzip if path.endswith(".gz") else _Plain)(file, file.size())
                while records.start():
                    head = records.head()
                    fields = _fields(head)
                    if all(t(_value(name, fields)) for name, t in tests):
                        rows.append(self._row(records, head, fields))
                        size += 500 + len(rows[-1][-1] or b"")
                        if size >= BATCH_BYTES:
                            yield pack()
                            rows, size = [], 0
                    records.next()
        if rows:
            yield pack()

    def _row(self, records, head: bytes, fields: dict[str, str]) -> tuple:
        cols = [_value(n, fields) for n in HEADERS]
        http = fields.get("content-type", "").startswith("application/http")
        length, digest, payload = None, None, None
        revisit = fields.get("warc-type") == "revisit"
        if http and (revisit or self.payload != "none"):
            block = records.rest()[len(head) + 4 :][: int(fields.get("content-length", 0))]
            top, _, payload = block.partition(b"\r\n\r\n")
            length = int(_fields(top).get("content-length", len(payload)))
        elif self.payload != "none":
            payload = records.rest()[len(head) + 4 :][: int(fields.get("content-length", 0))]
            length = len(payload)
        if revisit or self.payload == "none":
            payload = None
        elif payload is not None:
            digest, length = digest32(payload), len(payload)
        return (*cols, length, digest, payload if self.payload == "bytes" else None)


class WarcDataSource(DataSource):
    """Format ``warc``. Options: ``path``; ``payload`` = bytes (default), digest (computed, not returned) or none; ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        payload = self.options.get("payload", "bytes")
        if payload not in ("bytes", "digest", "none"):
            raise ValueError("payload must be bytes, digest or none")
        return WarcReader(self.options["path"], payload, int(self.options.get("splitbytes", FILE_BYTES)))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("warc files are only added: use mode append")
        return WarcWriter(self.options["path"], uuid.uuid4().hex)


def register(spark: SparkSession) -> None:
    importable(spark)
    spark.dataSource.register(WarcDataSource)
    spark.conf.set(PUSHDOWN, "true")  # the reader takes filters, which Spark refuses otherwise


def read(spark: SparkSession, path: str, payload: str = "bytes") -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", payload).load(path)


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Rows for the writer. Of equal payloads of at least ``least_bytes`` the least id is the response, the others revisit it.

    Null html is an empty payload and null urls have no target. Rows of one id
    that is the least are all responses. Rows without an id revisit a row that
    has one; if none has, they are responses. Payloads are told apart by length
    and SHA-256. Only payloads that occur again, and by chance a few more, are
    shuffled; other columns of ``pages`` are left out. Blanks around a URL are
    lost in a header, and its control characters are percent-encoded.
    """
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("target_uri"), payload.alias("payload"))
    rows = rows.withColumn("key", F.concat_ws(":", F.octet_length("payload").cast("string"), F.sha2("payload", 256)))
    least = rows.where(F.octet_length("payload") >= least_bytes).groupBy("key").agg(F.count("*").alias("times"), F.min("id").alias("first")).where("times > 1 and first is not null").select(F.col("key").alias("of"), "first")
    least = materialize(least, "repeated_payloads")
    split, there = marked(rows, least, F.col("key"), F.col("of"))
    held = split.where(F.col(there)).join(least.hint("merge"), F.col("key") == F.col("of"), "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("")))
    found = held.select(F.when(again, "revisit").otherwise("response").alias("record_type"), urn(F.col("id")).alias("record_id"), "target_uri", F.when(again, urn(F.col("first"))).alias("refers_to"), "payload")
    single = split.where(~F.col(there)).select(F.lit("response").alias("record_type"), urn(F.col("id")).alias("record_id"), "target_uri", F.lit(None).cast("string").alias("refers_to"), "payload")
    return single.union(found)


def write(rows: DataFrame, path: str) -> None:
    register(rows.sparkSession)
    rows.write.format("warc").mode("append").save(path)


def page_of(urn: str) -> Column:
    return F.regexp_extract(urn, "^urn:page:(-?[0-9]+)$", 1).try_cast("long")
