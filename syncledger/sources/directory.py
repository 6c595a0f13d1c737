"""A Spark data source over directory trees (S1), and a chunked content digest.

``spark.read.format("directory_tree").load(path)`` lists a tree as
``path, is_dir, mtime, md5sum, size``: every file and every folder, empty ones
too, each with its own time. The driver lists only the upper levels, until
there are enough folders to deal out; a partition holds a group of folders and
lists what is below them, row by row. :func:`read_tree` adds the files' md5 if
asked: the listed files are dealt to tasks anew, so a folder with very many
files is spread, and each is read block by block: no row and no task ever holds
a whole file.

Paths may be plain or URIs of any file system that pyarrow opens (``file:``,
``hdfs:``, ``s3:``, ``gs:``); the listed paths have no scheme. The tree must be
visible to the executors under the same path. A link to a folder is listed as a
folder and not entered. A file that vanishes between the listing and its digest
has a NULL md5; a folder that vanishes is listed without its content.
"""

from __future__ import annotations

import hashlib
import itertools
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT = "directory_tree"
#: Bytes of a file read at once.
CHUNK = 4 << 20
#: Folders the driver finds before it deals them out, a partition's share of them, and rows sent at once.
PLANNED = 4096
GROUP = 16
ROWS = 1000

LOCAL_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("is_dir", T.BooleanType(), False),
    T.StructField("mtime", T.TimestampNTZType(), True),
    T.StructField("md5sum", T.StringType(), True),
    T.StructField("size", T.LongType(), True),
])


def open_tree(path: str):
    """(file system, path in it) of a plain path or a URI."""
    from pyarrow import fs

    if re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", path):
        # file:/x and file:x are file:///x
        return fs.FileSystem.from_uri(re.sub(r"^file:/*", "file:///", path))
    return fs.LocalFileSystem(), path


def digest_file(system, path: str, chunk: int = CHUNK) -> str:
    """md5 of a file, read in blocks of ``chunk`` bytes."""
    md5 = hashlib.md5(usedforsecurity=False)
    with system.open_input_stream(path, buffer_size=0) as stream:
        while block := stream.read(chunk):
            md5.update(block)
    return md5.hexdigest()


def entries(system, folder: str) -> Iterator[tuple]:
    """What lies directly in a folder: (path, is a folder, time in ns, size, to be entered); nothing if it is gone."""
    from pyarrow import fs

    if isinstance(system, fs.LocalFileSystem):  # one by one, however many there are
        try:
            with os.scandir(folder) as found:
                for e in found:
                    try:
                        stat, is_dir = e.stat(), e.is_dir()
                    except FileNotFoundError:  # gone since, or a link to nothing
                        continue
                    yield e.path, is_dir, stat.st_mtime_ns, stat.st_size, is_dir and not e.is_symlink()
        except (FileNotFoundError, NotADirectoryError):
            return
    else:
        for e in system.get_file_info(fs.FileSelector(folder, recursive=False, allow_not_found=True)):
            if e.type in (fs.FileType.File, fs.FileType.Directory):
                is_dir = e.type == fs.FileType.Directory
                yield e.path, is_dir, e.mtime_ns, e.size, is_dir


@dataclass
class Folders(InputPartition):
    """Folders to list with all below them (``deep``), and entries that the driver has met already (``rows``)."""

    deep: list
    rows: list


class TreeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.planned = int(options.get("planned", PLANNED))
        self.group = int(options.get("group", GROUP))

    def partitions(self) -> list[Folders]:
        """Upper levels, listed folder by folder until enough folders are found; then groups of folders to descend."""
        system, root = open_tree(self.path)
        root = root.rstrip("/") or "/"
        top = system.get_file_info(root)
        if top.type.name == "NotFound":
            raise FileNotFoundError(f"no such folder or file: {self.path}")
        is_dir = top.type.name == "Directory"
        seen, front, below = [(top.path, is_dir, top.mtime_ns, top.size)], [top.path] if is_dir else [], []
        while front and len(front) + len(below) < self.planned:
            for e in entries(system, front.pop(0)):
                seen.append(e[:4])
                if e[4]:
                    below.append(e[0])
            if not front:
                front, below = below, []
        front += below
        return [Folders([], seen[i:i + ROWS]) for i in range(0, len(seen), ROWS)] + \
            [Folders(front[i:i + self.group], []) for i in range(0, len(front), self.group)]

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        system, _ = open_tree(self.path)
        rows = self._walk(system, partition)
        while some := list(itertools.islice(rows, ROWS)):
            path, is_dir, time, size = zip(*some, strict=True)
            yield pa.record_batch(
                [pa.array([p if p.startswith("/") else f"/{p}" for p in path], pa.string()), pa.array(is_dir, pa.bool_()),
                 pa.array([None if t is None else t // 1000 for t in time], pa.timestamp("us")),
                 pa.nulls(len(some), pa.string()),
                 pa.array([0 if d else n for d, n in zip(is_dir, size, strict=True)], pa.int64())],
                ["path", "is_dir", "mtime", "md5sum", "size"])

    def _walk(self, system, partition: Folders) -> Iterator[tuple]:
        yield from partition.rows
        todo = list(partition.deep)
        while todo:
            for e in entries(system, todo.pop()):
                yield e[:4]
                if e[4]:
                    todo.append(e[0])


class DirectoryTree(DataSource):
    """``directory_tree``: options ``path``, ``planned`` (folders the driver finds before it deals them out) and
    ``group`` (folders of a partition)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return LOCAL_SCHEMA

    def reader(self, schema: T.StructType) -> TreeReader:
        return TreeReader(dict(self.options))


def with_digests(tree: DataFrame, path: str, chunk: int = CHUNK) -> DataFrame:
    """The listing ``tree`` of ``path`` with the md5 of every file (T6), worked out in as many tasks as a shuffle has."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = open_tree(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):  # results go on while files are read
                some = batch.slice(at, 64)
                md5 = [None if d else _digest_or_none(system, p, chunk)
                       for p, d in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True)]
                yield some.set_column(some.schema.get_field_index("md5sum"), "md5sum", pa.array(md5, pa.string()))

    spark = tree.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return tree.repartition(parts, "path").mapInArrow(digest, tree.schema)


def _digest_or_none(system, path: str, chunk: int) -> str | None:
    try:
        return digest_file(system, path, chunk)
    except FileNotFoundError:
        return None


def read_tree(spark: SparkSession, path: str, digest: bool = False, chunk: int = CHUNK, **options) -> DataFrame:
    """The tree below ``path`` (or the one file that it names), the folder itself included."""
    spark.dataSource.register(DirectoryTree)
    reader = spark.read.format(FORMAT)
    for key, value in options.items():
        reader = reader.option(key, str(value))
    tree = reader.load(path)
    return with_digests(tree, path, chunk) if digest else tree
