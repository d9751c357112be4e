"""PNG files: bytes to grey pixels with an error per file instead of a failed job, and a sink for line crops."""

from __future__ import annotations

import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from ..operators import layout, manifest
from ..session import long_rows

# fixed values of the format: signature, channels by colour type, the pixels that may be asked for at most
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
MOST_PIXELS = 1 << 28
#: Folders among which line crops are dealt, and how many of them, and of their files, are read at once.
FOLDERS, TOGETHER = 1024, 16


def to_png(grey: np.ndarray) -> bytes:
    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    h, w = grey.shape
    raw = np.zeros((h, w + 1), np.uint8)
    raw[:, 1:] = grey
    return SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw.tobytes())) + chunk(b"IEND", b"")


def _chunks(content: bytes) -> dict[bytes, bytes]:
    """Data by kind, of one kind joined."""
    if content[:8] != SIGNATURE:
        raise ValueError("no PNG signature")
    out: dict[bytes, bytes] = {}
    at = 8
    while b"IEND" not in out:
        if len(content) < at + 12:
            raise ValueError("cut off")
        size, kind = struct.unpack(">I4s", content[at : at + 8])
        data, check = content[at + 8 : at + 8 + size], content[at + 8 + size : at + 12 + size]
        if len(check) < 4:
            raise ValueError("cut off")
        if zlib.crc32(kind + data) != int.from_bytes(check, "big"):
            raise ValueError(f"checksum of {kind.decode('latin-1')}")
        out[kind] = out.get(kind, b"") + data
        at += 12 + size
    return out


def _row(kind: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    """A row without its filter; ``step`` bytes a pixel."""
    if kind == 0:
        return line
    if kind == 1:
        return line.reshape(-1, step).cumsum(axis=0, dtype=np.uint8).ravel()
    if kind == 2:
        return line + above
    if kind not in (3, 4):
        raise ValueError(f"filter {kind}")
    out, up, new = [0] * step, [0] * step + above.tolist(), line.tolist()
    for k, value in enumerate(new):
        left, top, corner = out[k], up[k + step], up[k]
        if kind == 3:
            guess = (left + top) // 2
        else:
            near = [(abs(top - corner), 0, left), (abs(left - corner), 1, top), (abs(left + top - 2 * corner), 2, corner)]
            guess = min(near)[2]
        out.append((value + guess) & 255)
    return np.array(out[step:], np.uint8)


def from_png(content: bytes) -> np.ndarray:
    """Grey levels of a PNG of 1 to 8 bits a sample; what is wrong with another is said by ValueError."""
    chunks = _chunks(content)
    if len(chunks.get(b"IHDR", b"")) != 13:
        raise ValueError("no header")
    w, h, depth, colour, _, _, interlaced = struct.unpack(">IIBBBBB", chunks[b"IHDR"])
    if colour not in CHANNELS or depth > 8 or interlaced:
        raise ValueError(f"colour type {colour} of {depth} bits{', interlaced' if interlaced else ''}")
    if not 0 < w * h <= MOST_PIXELS:
        raise ValueError(f"{w} by {h} pixels")
    channels = CHANNELS[colour]
    size, step = (w * channels * depth + 7) // 8, max(1, channels * depth // 8)
    try:
        raw = zlib.decompressobj().decompress(chunks.get(b"IDAT", b""), h * (size + 1))
    except zlib.error as e:
        raise ValueError(str(e)) from e
    if len(raw) < h * (size + 1):
        raise ValueError("too few rows")
    lines = np.frombuffer(raw, np.uint8).reshape(h, size + 1)
    out, above = np.empty((h, size), np.uint8), np.zeros(size, np.uint8)
    for y in range(h):
        above = out[y] = _row(int(lines[y, 0]), lines[y, 1:], above, step)
    if depth < 8:
        bits = np.unpackbits(out, axis=1).reshape(h, -1, depth)[:, :w]
        out = (bits @ (1 << np.arange(depth)[::-1])).astype(np.uint8)
        out = out if colour == 3 else (out * (255 // ((1 << depth) - 1))).astype(np.uint8)
    if colour == 3:
        table = np.frombuffer(chunks.get(b"PLTE", b""), np.uint8).reshape(-1, 3)
        if len(table) <= out.max():
            raise ValueError("palette too short")
        return layout.grey(table[out][:, :, ::-1])
    out = out.reshape(h, w, channels)
    return layout.grey(out[:, :, 2::-1]) if channels > 2 else np.ascontiguousarray(out[:, :, 0])


def decode(files: DataFrame, content: str = "content") -> DataFrame:
    """``files`` with ``height``, ``width``, ``pixels`` and ``error`` in place of ``content``: a file that is no image has an error and no pixels."""
    long_rows(files.sparkSession)

    @F.pandas_udf("height int, width int, pixels binary, error string")
    def decoded(raw: pd.Series) -> pd.DataFrame:
        out = []
        for r in raw:
            try:
                g = from_png(bytes(r)) if r is not None else None
                out.append((None, None, None, "no content") if g is None else (*g.shape, g.tobytes(), None))
            except ValueError as e:
                out.append((None, None, None, str(e)))
        return pd.DataFrame(out, columns=["height", "width", "pixels", "error"]).astype({"height": "Int32", "width": "Int32"})

    rest = [c for c in files.columns if c != content]
    return files.withColumn("_image", decoded(content)).select(*rest, "_image.*")


def encode(height: Column | str, width: Column | str, pixels: Column | str) -> Column:
    """The bytes of a PNG file; null without pixels."""

    @F.pandas_udf("binary")
    def encoded(h: pd.Series, w: pd.Series, raw: pd.Series) -> pd.Series:
        return pd.Series([None if r is None else to_png(np.frombuffer(r, np.uint8).reshape(int(a), int(b))) for a, b, r in zip(h, w, raw, strict=True)])

    return encoded(height, width, pixels)


def read_images(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, height, width, pixels, error)`` of every file in a folder, wherever Spark can read it."""
    return decode(spark.read.format("binaryFile").load(folder).select("path", "content"))


@dataclass
class Written(WriterCommitMessage):
    files: int


def _opened(path: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{posixpath.abspath(path)}")


class CropWriter(DataSourceWriter):
    def __init__(self, path: str):
        self.path = path

    def _place(self):
        fs, at = _opened(self.path)
        fs.create_dir(at, recursive=True)
        return fs, at

    def write(self, iterator: Iterator) -> Written:
        """Each file is written under a hidden name of this attempt and then renamed: it is there whole or not at all, and a repeated task writes the same again."""
        fs, at = self._place()
        attempt, n, made = uuid.uuid4().hex, 0, set()
        for row in iterator:
            folder = posixpath.join(at, f"part={zlib.crc32(row.image_path.encode()) % FOLDERS:03x}")
            if folder not in made:
                fs.create_dir(folder, recursive=True)
                made.add(folder)
            hidden = posixpath.join(folder, f".{row.image_path}.{attempt}")
            with fs.open_output_stream(hidden) as out:
                out.write(row.content)
            fs.move(hidden, posixpath.join(folder, row.image_path))
            n += 1
        return Written(n)

    def commit(self, messages: list) -> None:
        fs, at = self._place()
        with fs.open_output_stream(posixpath.join(at, "_SUCCESS")) as out:
            out.write(b"%d\n" % sum(m.files for m in messages if m))

    def abort(self, messages: list) -> None:
        """Whole files stay, as they would be written again; without ``_SUCCESS`` the folder isn't complete."""


class CropFiles(DataSource):
    """``df.write.format("line_crops").save(folder)`` of ``(image_path, content)``: a file each, in one of ``FOLDERS`` folders by its name."""

    @classmethod
    def name(cls) -> str:
        return "line_crops"

    def schema(self) -> str:
        return "image_path string, content binary"

    def writer(self, schema: object, overwrite: bool) -> CropWriter:
        return CropWriter(self.options["path"])


@dataclass
class Folders(InputPartition):
    names: list[str]


class CropReader(DataSourceReader):
    """Lists the folders on the driver and their files where they are read: no process holds the names of all files."""

    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Folders]:
        from pyarrow.fs import FileSelector, FileType

        fs, at = _opened(self.path)
        names = sorted(f.base_name for f in fs.get_file_info(FileSelector(at)) if f.type == FileType.Directory)
        return [Folders(names[k : k + TOGETHER]) for k in range(0, len(names), TOGETHER)] or [Folders([])]

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        from pyarrow.fs import FileSelector, FileType

        fs, at = _opened(self.path)
        for folder in partition.names:
            files = [f for f in fs.get_file_info(FileSelector(posixpath.join(at, folder))) if f.type == FileType.File and f.size and f.base_name[0] not in "._"]
            for k in range(0, len(files), TOGETHER):
                some, contents = files[k : k + TOGETHER], []
                for f in some:
                    with fs.open_input_stream(f.path) as source:
                        contents.append(source.read())
                paths = [posixpath.join(self.path, folder, f.base_name) for f in some]
                yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], names=["path", "content"])


class CropFolders(DataSource):
    """``spark.read.format("line_crop_files").load(folder)``: ``(path, content)`` of each file that ``line_crops`` wrote there."""

    @classmethod
    def name(cls) -> str:
        return "line_crop_files"

    def schema(self) -> str:
        return "path string, content binary"

    def reader(self, schema: object) -> CropReader:
        return CropReader(self.options["path"])


def read_crops(spark: SparkSession, folder: str) -> DataFrame:
    """As ``read_images``, of a folder that ``write_crops`` wrote, however many crops it holds: Spark's own scan keeps every file's name, size and place on the driver."""
    spark.dataSource.register(CropFolders)
    return decode(spark.read.format("line_crop_files").load(folder))


def write_crops(crops: DataFrame, folder: str, page: str = "page") -> None:
    """Line crops ``(source_id, page, line_id, height, width, pixels)`` as files named by source, page and line; one without pixels has no file."""
    spark = crops.sparkSession
    spark.dataSource.register(CropFiles)
    name = manifest.line_name(F.col("source_id"), F.col(page).cast("int"), F.col("line_id").cast("int"))
    some = crops.where((F.col("height") > 0) & (F.col("width") > 0))
    some.select(name.alias("image_path"), encode("height", "width", "pixels").alias("content")).write.format("line_crops").mode("append").save(folder)


__all__ = ["CropFiles", "CropFolders", "decode", "encode", "from_png", "pa", "read_crops", "read_images", "to_png", "write_crops"]
