"""Media columns: texts stored as lossless grey images in ZIP archives, read back by a Spark data source.

write_archives() turns each text into a payload (its UTF-8 bytes and 255s up to a multiple of WIDTH; 255 never
occurs in UTF-8) and each payload into a PNG of 8-bit grey samples, and every task writes its images as ZIP
archives of bounded size into the shared folder. MediaSource plans partitions as byte ranges over the archives; a reader takes the
members whose headers start in its range, through the archive's own directory, and streams them as Arrow batches.
A member that can't be read, or whose checksum is wrong, is read again at its offset from a newly opened file,
whatever became of the members before it; if it fails RETRIES times the task fails, so no member is ever left out.
"""

from __future__ import annotations

import contextlib
import hashlib
import io
import struct
import time
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidewell.llm.scratch import Scratch

WIDTH = 576
PAD = b"\xff"
#: Bytes of an archive that one partition reads; media bytes in an Arrow batch; tries for each member.
SPLIT, BATCH, RETRIES = 32 << 20, 4 << 20, 3
#: Bytes after which a task begins a new archive; each of an archive's ranges reads the directory of no more than that.
ARCHIVE = 128 << 20

_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def payload_of(text: bytes) -> bytes:
    """The text and as many 255s as make a positive multiple of WIDTH."""
    return text + PAD * (WIDTH - len(text) % WIDTH if len(text) % WIDTH or not text else 0)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(payload: bytes) -> bytes:
    """A grey image of WIDTH samples a row; each row is stored with filter 0."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    raw = np.zeros((len(rows), WIDTH + 1), np.uint8)
    raw[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(raw.tobytes(), 6)) + _chunk(b"IEND", b"")


def decode_png(media: bytes) -> np.ndarray:
    """Samples (rows by WIDTH) of an image that encode_png made; ValueError for anything else."""
    if media[:8] != _SIGNATURE:
        raise ValueError("not a PNG")
    at, width, height, data = 8, 0, 0, []
    while at < len(media):
        (size,) = struct.unpack_from(">I", media, at)
        kind, body = media[at + 4 : at + 8], media[at + 8 : at + 8 + size]
        if struct.unpack_from(">I", media, at + 8 + size)[0] != zlib.crc32(kind + body):
            raise ValueError("bad chunk checksum")
        if kind == b"IHDR":
            width, height = struct.unpack_from(">II", body)
        elif kind == b"IDAT":
            data.append(body)
        at += size + 12
    raw = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(height, width + 1)
    if raw[:, 0].any():
        raise ValueError("only filter 0 is read")
    return raw[:, 1:]


class _Counted(io.RawIOBase):
    """A write-only stream without seek, as archives are written to object stores."""

    def __init__(self, out: pa.NativeFile):
        self._out, self._at = out, 0

    def writable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._at

    def write(self, data) -> int:  # noqa: ANN001
        n = len(data)
        self._out.write(data)
        self._at += n
        return n


class _Seekable(io.RawIOBase):
    """A file of pyarrow that answers a seek before its start as Python's files do."""

    def __init__(self, file: pa.NativeFile):
        self._file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._file.tell()

    def seek(self, offset: int, whence: int = 0) -> int:
        at = offset + (0, self._file.tell(), self._file.size())[whence]
        if at < 0:
            raise OSError("seek before the start")
        return self._file.seek(at)

    def readinto(self, buffer) -> int:  # noqa: ANN001
        data = self._file.read(len(buffer))
        buffer[: len(data)] = data
        return len(data)

    def close(self) -> None:
        self._file.close()
        super().close()


def _writer(folder: str, most: int):  # noqa: ANN202
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        task = TaskContext.get()
        texts = (row for batch in batches for row in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True))
        first = next(texts, None)
        part = n = 0
        while first is not None:
            name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{part:05d}.zip"
            with fs.open_output_stream(f"{path}/{name}") as stream, zipfile.ZipFile(_Counted(stream), "w", zipfile.ZIP_STORED, allowZip64=True) as archive:
                while first is not None:
                    doc_id, text = first
                    media = encode_png(payload_of(text.cast(pa.binary()).as_py() or b""))
                    archive.writestr(zipfile.ZipInfo(f"{'' if doc_id is None else doc_id}_{n}.png", (1980, 1, 1, 0, 0, 0)), media)
                    n += 1
                    first = next(texts, None)
                    if archive.fp.tell() >= most:
                        break
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([fs.get_file_info(f"{path}/{name}").size], pa.int64()), pa.array([n], pa.int64())], ["name", "bytes", "members"])
            part, n = part + 1, 0

    return write


def write_archives(df: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text", most: int = ARCHIVE) -> None:
    """Write the images of all rows of df as archives below folder, with a list of those that finished tasks left.

    A task begins a new archive after `most` bytes, so an archive's directory is small beside it and beside a
    reader's memory however much a task writes. Archives of lost or repeated task attempts aren't in the list. Null texts are written as empty ones.
    """
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    done = rows.mapInArrow(_writer(folder, most), "name string, bytes long, members long")
    fs, path = pafs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    names = [f"{r['bytes']} {r['name']}\n" for r in done.collect()]  # a short line for each archive of ARCHIVE bytes, none for a document
    with fs.open_output_stream(f"{path}/_archives") as out:
        out.write("".join(sorted(names)).encode())


@dataclass
class ByteRange(InputPartition):
    """Members of one archive whose headers start in [start, end)."""

    name: str
    start: int
    end: int


class MediaReader(DataSourceReader):
    """Reads the members of listed archives by byte range."""

    def __init__(self, folder: str, split: int = SPLIT):
        self.folder, self.split = folder, split

    def partitions(self) -> list[ByteRange]:
        fs, path = pafs.FileSystem.from_uri(self.folder)
        with fs.open_input_stream(f"{path}/_archives") as listed:
            lines = listed.read().decode().splitlines()
        sized = [(int(size), name) for size, name in (x.split(" ", 1) for x in lines)]
        return [ByteRange(name, lo, min(lo + self.split, size)) for size, name in sized for lo in range(0, size, self.split)] or [ByteRange("", 0, 0)]

    def _open(self, name: str) -> zipfile.ZipFile:
        fs, path = pafs.FileSystem.from_uri(self.folder)
        return zipfile.ZipFile(io.BufferedReader(_Seekable(fs.open_input_file(f"{path}/{name}")), 1 << 20))

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("member", pa.string()), ("offset", pa.int64()), ("media", pa.binary())])
        if not partition.name:
            return
        archive = self._open(partition.name)
        rows: list[tuple] = []
        held = 0
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
        try:
            for info in archive.infolist():
                if not partition.start <= info.header_offset < partition.end:
                    continue
                for left in range(RETRIES - 1, -1, -1):
                    try:
                        media = archive.read(info)  # by its header's offset; compares the checksum
                        break
                    except (OSError, zipfile.BadZipFile, zlib.error, EOFError):
                        if not left:
                            raise
                        time.sleep(0.2)
                        with contextlib.suppress(OSError):
                            archive.close()
                        archive = self._open(partition.name)
                number = info.filename.split("_")[0]
                rows.append((int(number) if number else None, info.filename, info.header_offset, media))
                held += len(media)
                if held >= BATCH:
                    yield batch()
                    rows, held = [], 0
            if rows:
                yield batch()
        finally:
            with contextlib.suppress(OSError):
                archive.close()


class MediaSource(DataSource):
    """spark.read.format("tidewell_media").option("folder", ...): doc_id, member, offset and media of every member."""

    @classmethod
    def name(cls) -> str:
        return "tidewell_media"

    def schema(self) -> str:
        return "doc_id long, member string, offset long, media binary"

    def reader(self, schema) -> MediaReader:  # noqa: ANN001
        return MediaReader(self.options["folder"], int(self.options.get("split", SPLIT)))


def read_archives(spark: SparkSession, folder: str, split: int = SPLIT) -> DataFrame:
    """The members of the archives that write_archives left below folder."""
    spark.dataSource.register(MediaSource)
    return spark.read.format("tidewell_media").option("folder", folder).option("split", split).load()


def _features(samples: np.ndarray) -> str:
    """Shape, mean and deviation of the samples in thousandths, and how many lie in each eighth of the range."""
    eighths = np.bincount(samples.reshape(-1) >> 5, minlength=8)
    total, squares, n = int(samples.sum(dtype=np.int64)), int((samples.astype(np.int64) ** 2).sum()), samples.size
    return f"{samples.shape[1]}x{samples.shape[0]};{total * 1000 // n};{(squares * n - total * total) * 1000 // (n * n)};" + ",".join(map(str, eighths))


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for media in batch["media"].to_pylist():
            samples = decode_png(media)
            payload = samples.tobytes()
            rows.append((len(payload.rstrip(PAD)), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), _features(samples)))
        columns = list(zip(*rows, strict=True)) or [()] * 7
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])


def describe_media(media: DataFrame) -> DataFrame:
    """Decodes each image of (doc_id, media) and returns doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256 and feature."""
    return media.select("doc_id", "media").mapInArrow(_describe, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def store_and_describe(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stores every text of df as media in the shared folder, reads it back through MediaSource and describes it.

    One row for each row of df, repeated ids and rows included; null and empty texts are one row of 255s; null ids
    stay null; other columns are ignored; an empty df gives an empty result. Equal texts give equal values.
    """
    scratch = Scratch(df.sparkSession, "media")
    folder = f"{scratch.root}/archives"
    write_archives(df, folder, id_col, text_col)
    return describe_media(read_archives(df.sparkSession, folder))
