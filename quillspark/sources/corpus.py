"""A corpus of files as a transactional data source: versions, a manifest, and one name for what is current.

A run writes its files into a folder of its own and, for each task, a list of them with their
digests. Committing writes the manifest and then moves one small file, CURRENT, over the old one:
readers see the old corpus until then and the new one after. A run that fails or is refused leaves CURRENT
as it was and deletes its folder. Tasks that run twice write the same files; only those of the attempt that
Spark accepts are in the manifest. Paths are URIs that pyarrow's file systems open on every executor.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from quillspark.operators import guards

ENTRY = "path string, content string, sha256 string, bytes bigint"


def _open(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", root))


def _put(files: fs.FileSystem, path: str, data: bytes) -> None:
    """Written beside its place and moved, so that nobody reads half of it."""
    beside = f"{path}.{uuid.uuid4().hex}.tmp"
    with files.open_output_stream(beside) as f:
        f.write(data)
    files.move(beside, path)


def _get(files: fs.FileSystem, path: str) -> bytes | None:
    if files.get_file_info(path).type == fs.FileType.NotFound:
        return None
    with files.open_input_stream(path) as f:
        return f.read()


def safe(path: str | None) -> bool:
    return bool(path) and not path.startswith("/") and not re.search(r"(^|/)\.{0,2}(/|$)|\\|\x00", path)


class CorpusSource(DataSource):
    """``format("corpus")``: option ``path``; rows (path, content), read with sha256 and bytes as the manifest states them."""

    @classmethod
    def name(cls) -> str:
        return "corpus"

    def schema(self) -> str:
        return ENTRY

    def reader(self, schema) -> DataSourceReader:
        return CorpusReader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return CorpusWriter(self.options["path"], self.options["run"], schema.fieldNames())


@dataclass
class Written(WriterCommitMessage):
    listing: str
    files: int


@dataclass
class Listing(InputPartition):
    listing: str


class CorpusWriter(DataSourceWriter):
    def __init__(self, root: str, run: str, names: list[str]):
        self.root, self.run, self.path, self.content = root, run, names.index("path"), names.index("content")

    def write(self, iterator: Iterator) -> Written:
        files, root = _open(self.root)
        home, listing, made = f"{root}/versions/{self.run}", f"lists/{uuid.uuid4().hex}", set()
        files.create_dir(f"{home}/lists")
        entries = []
        for row in iterator:
            path, data = row[self.path], row[self.content].encode()
            if not safe(path):
                raise ValueError(f"{path} leaves its folder")
            folder = f"{home}/files/{path}".rpartition("/")[0]
            if folder not in made:
                files.create_dir(folder)
                made.add(folder)
            _put(files, f"{home}/files/{path}", data)
            entries.append(json.dumps([path, hashlib.sha256(data).hexdigest(), len(data)]))
        _put(files, f"{home}/{listing}", "\n".join(entries).encode())
        return Written(listing, len(entries))

    def commit(self, messages: list[Written | None]) -> None:
        files, root = _open(self.root)
        done = [m for m in messages if m]
        manifest = {"run": self.run, "files": sum(m.files for m in done), "lists": sorted(m.listing for m in done if m.files)}
        _put(files, f"{root}/versions/{self.run}/manifest", json.dumps(manifest).encode())
        _put(files, f"{root}/CURRENT", self.run.encode())

    def abort(self, messages: list[Written | None]) -> None:
        files, root = _open(self.root)
        if files.get_file_info(f"{root}/versions/{self.run}").type != fs.FileType.NotFound:
            files.delete_dir(f"{root}/versions/{self.run}")


class CorpusReader(DataSourceReader):
    def __init__(self, root: str):
        self.root = root
        files, at = _open(root)
        self.run = (_get(files, f"{at}/CURRENT") or b"").decode()

    def partitions(self) -> list[Listing]:
        if not self.run:
            return []
        files, root = _open(self.root)
        return [Listing(x) for x in json.loads(_get(files, f"{root}/versions/{self.run}/manifest"))["lists"]]

    def read(self, partition: Listing | None) -> Iterator[tuple]:
        if partition is None:
            return
        files, root = _open(self.root)
        home = f"{root}/versions/{self.run}"
        for line in _get(files, f"{home}/{partition.listing}").decode().split("\n"):
            path, digest, size = json.loads(line)
            data = _get(files, f"{home}/files/{path}")
            if data is None or hashlib.sha256(data).hexdigest() != digest:
                raise ValueError(f"{path} isn't what was written")
            yield path, data.decode(), digest, size


def read_corpus(spark: SparkSession, root: str) -> DataFrame:
    """The files of the current version (path, content, sha256, bytes), each held against its digest; none if there is no version yet."""
    spark.dataSource.register(CorpusSource)
    return spark.read.format("corpus").load(root)


def write_corpus(files: DataFrame, violations: DataFrame, root: str, owned: DataFrame | None = None) -> str:
    """Make ``files`` (path, content) the current version below ``root``, or raise and leave everything as it is.

    Nothing is written while ``violations`` (guard, subject, detail) has rows, a path leaves the folder,
    is null or stands twice, or a content is null. owned (dir): folders this run answers for; files
    of the current version in other folders stay, those in owned ones go unless they are written
    again. Without it the run answers for everything. Returns the version's name.
    """
    spark = files.sparkSession
    spark.dataSource.register(CorpusSource)
    new = files.select("path", "content")
    bad_path = F.col("path").isNull() | (F.col("path") == "") | F.col("path").startswith("/") | F.col("path").rlike(r"(^|/)\.{0,2}(/|$)|\\|\x00")
    shape = guards.violation(new.where(bad_path), "path", "path", "'leaves its folder'")
    empty = guards.violation(new.where("content is null"), "content", "path", "'is null'")
    guards.require_none(guards.gathered(violations, guards.unique(new, "path"), shape, empty))
    if owned is not None:
        folder = F.regexp_replace("path", "/?[^/]*$", "")
        kept = read_corpus(spark, root).withColumn("dir", folder).join(owned.select("dir").distinct(), "dir", "left_anti").select("path", "content")
        new = new.unionByName(kept.join(new.select("path"), "path", "left_anti"))
    run = uuid.uuid4().hex
    new.write.format("corpus").mode("append").option("path", root).option("run", run).save()
    return run


def sweep(root: str) -> int:
    """Delete versions other than the current one, once nothing reads them; how many there were."""
    files, at = _open(root)
    current, gone = (_get(files, f"{at}/CURRENT") or b"").decode(), 0
    for x in files.get_file_info(fs.FileSelector(f"{at}/versions", allow_not_found=True)):
        if x.base_name != current:
            files.delete_dir(x.path)
            gone += 1
    return gone
