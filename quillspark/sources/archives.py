"""Zip archives as a data source: many tasks read one archive, none holds more than an entry.

Partitions are ranges of an archive's bytes, made from its size alone. A task finds the end record,
reads the central directory, and takes the entries whose local header begins in its range. What is
refused is refused by the records: each refusal is a row, so that one entry doesn't hide the others.
"""

from __future__ import annotations

import re
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quillspark.sources.corpus import _open, safe

ENTRY = "archive string, name string, data binary, method int, error string"
#: Records of the format (fixed values): signature and layout of the end record, of an entry of the directory, and before an entry's data.
END, DIRECTORY, LOCAL = (b"PK\x05\x06", struct.Struct("<4s4H2LH")), (b"PK\x01\x02", struct.Struct("<4s6H3L5H2L")), (b"PK\x03\x04", struct.Struct("<4s5H3L2H"))
COMMENT = 0xFFFF
ZIP64 = 0xFFFFFFFF
STORED, DEFLATED = 0, 8


class Refused(ValueError):
    pass


@dataclass
class Entry:
    name: str
    method: int
    crc: int
    packed: int
    size: int
    at: int


def _record(f, at: int, kind: tuple, what: str) -> tuple:
    mark, layout = kind
    f.seek(at)
    data = f.read(layout.size)
    if len(data) < layout.size or data[:4] != mark:
        raise Refused(f"bad {what}")
    return layout.unpack(data)


def directory(f, size: int) -> Iterator[Entry | Refused]:
    """Entries of an archive in the order of its directory; what can't be read ends them."""
    tail = min(size, END[1].size + COMMENT)
    f.seek(size - tail)
    data = f.read(tail)
    at = data.rfind(END[0], 0, max(0, len(data) - END[1].size + 4))
    if at < 0:
        yield Refused("no end record")
        return
    _, _, _, _, count, _, place, _ = END[1].unpack_from(data, at)
    if place == ZIP64:
        yield Refused("zip64 isn't read")
        return
    for i in range(count):
        try:
            _, _, _, flags, method, _, _, crc, packed, full, n_name, n_extra, n_comment, *_, offset = _record(f, place, DIRECTORY, f"directory record {i}")
        except Refused as e:
            yield e
            return
        raw = f.read(n_name)
        yield Entry(raw.decode("utf-8" if flags & 0x800 else "cp437", "replace"), method, crc, packed, full, offset)
        place += DIRECTORY[1].size + n_name + n_extra + n_comment


def content(f, e: Entry) -> bytes:
    """An entry's data, or Refused: another method, zip64, a bad header, size or checksum, a name that leaves its folder."""
    if not safe(e.name.replace("\\", "/")) or re.match(r"[A-Za-z]:", e.name):
        raise Refused("escapes its folder")
    if e.method not in (STORED, DEFLATED):
        raise Refused(f"method {e.method} isn't read")
    if ZIP64 in (e.packed, e.size, e.at):
        raise Refused("zip64 isn't read")
    *_, n_name, n_extra = _record(f, e.at, LOCAL, "local header")
    f.seek(e.at + LOCAL[1].size + n_name + n_extra)
    data = f.read(e.packed)
    if e.method == DEFLATED:
        inflate = zlib.decompressobj(-zlib.MAX_WBITS)
        try:
            data = inflate.decompress(data, e.size + 1)
        except zlib.error as x:
            raise Refused(f"bad data: {x}") from x
    if len(data) != e.size:
        raise Refused("size mismatch")
    if zlib.crc32(data) != e.crc:
        raise Refused("bad checksum")
    return data


@dataclass
class Range(InputPartition):
    path: str
    size: int
    first: int
    last: int


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root, self.most = options["path"], int(options.get("bytes", 64 << 20))
        self.suffix = options.get("suffix", ".zip")

    def partitions(self) -> list[Range]:
        files, root = _open(self.root)
        found = files.get_file_info(fs.FileSelector(root, recursive=True))
        return [Range(x.path, x.size, at, at + self.most) for x in sorted(found, key=lambda x: x.path) if x.is_file and x.path.endswith(self.suffix) for at in range(0, max(x.size, 1), self.most)]

    def read(self, partition: Range | None) -> Iterator[tuple]:
        if partition is None:
            return
        files, root = _open(self.root)
        name = partition.path.removeprefix(root).lstrip("/")
        with files.open_input_file(partition.path) as f:
            own = []
            for e in directory(f, partition.size):
                if isinstance(e, Refused):
                    if partition.first == 0:
                        yield name, None, None, None, str(e)
                elif partition.first <= min(e.at, partition.size - 1) < partition.last and not e.name.endswith("/"):
                    own.append(e)
            for e in sorted(own, key=lambda e: e.at):
                try:
                    yield name, e.name, content(f, e), e.method, None
                except Refused as x:
                    yield name, e.name, None, e.method, str(x)


class ArchiveSource(DataSource):
    """``format("archives")``: options path (a folder), suffix, and bytes (of an archive for one task)."""

    @classmethod
    def name(cls) -> str:
        return "archives"

    def schema(self) -> str:
        return ENTRY

    def reader(self, schema) -> DataSourceReader:
        return ArchiveReader(self.options)


def read_archives(spark: SparkSession, root: str, most: int = 64 << 20, suffix: str = ".zip") -> DataFrame:
    """Entries (archive, name, data, method, error) of all archives below a folder, ``most`` bytes of one to a task.
    Folders are left out; an archive or entry that is refused has a row with the reason and no data."""
    spark.dataSource.register(ArchiveSource)
    return spark.read.format("archives").option("path", root).option("bytes", most).option("suffix", suffix).load()


def write_archives(files: DataFrame, root: str) -> DataFrame:
    """Pack ``files`` (path, content binary) into one archive for each partition, below ``root``; gives (archive, entries). Contents that don't shrink are stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, folder = _open(root)
        at.create_dir(folder)
        name, n = f"{uuid.uuid4().hex}.zip", 0
        with at.open_output_stream(f"{folder}/{name}.tmp") as out, zipfile.ZipFile(out, "w") as z:
            for b in batches:
                for path, data in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
                    small = len(zlib.compress(data, 1)) < len(data)
                    z.writestr(path, data, zipfile.ZIP_DEFLATED if small else zipfile.ZIP_STORED)
                    n += 1
        at.move(f"{folder}/{name}.tmp", f"{folder}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())], names=["archive", "entries"])

    return files.select("path", "content").mapInArrow(run, "archive string, entries bigint")
