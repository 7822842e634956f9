"""Trees of landed files as a data source: one row per file, also for those that can't be read (SRC-08, SRC-09, SRC-11, SRC-14).

    spark.dataSource.register(LandedTree)
    spark.read.format("landed_tree").option("path", folder).load().where("path LIKE 'a/%.csv'")
    df.select("path", "content").write.format("landed_tree").option("path", folder).mode("append").save()

Reading: path (below the folder), modified, length, content, text (content as UTF-8) and error. A file that
can't be opened, is longer than ``maxFileBytes``, or isn't UTF-8 is a row with an error, so that one bad file
never fails its tree. Partitions are planned by bytes (``maxPartitionBytes``), small files together. Filters
on path are applied to the listing, before any file is opened, where the session pushes filters down to Python
sources (PUSHDOWN, which read() hands on as the option ``pushdown``); without that Spark applies them afterwards.

Writing: one file per row, put in place by a rename once it is whole, so that a task that runs twice leaves
one file. The order of files doesn't matter; of rows with one path any one stays.
"""

from __future__ import annotations

import datetime
import posixpath
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, datasource
from pyspark.sql.types import Row, StructType

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
SCHEMA = "path string, modified timestamp, length bigint, content binary, text string, error string"
#: Bytes of files that a task reads, and of one file, at most.
PARTITION_BYTES, FILE_BYTES = 64 << 20, 512 << 20
#: What an entry of the listing costs in bytes besides its content, so that empty files aren't all one task's.
OPEN_COST = 64 << 10
BATCH_BYTES = 8 << 20


@dataclass
class Files(datasource.InputPartition):
    """Files of one task: (path below the root, bytes, modified)."""

    files: list[tuple[str, int, datetime.datetime | None]]


def opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


def packed(files: Iterable[tuple[str, int, datetime.datetime | None]], most: int) -> list[Files]:
    """Files in the order of their paths, dealt into tasks of about ``most`` bytes; a larger file stands alone."""
    out, held = [], 0
    for one in sorted(files, key=lambda f: f[0]):
        cost = one[1] + OPEN_COST
        if not out or held + cost > most:
            out.append(Files([]))
            held = 0
        out[-1].files.append(one)
        held += cost
    return out


def keeps(f: datasource.Filter):
    """A test of a path for a filter on the column path; None for any other filter."""
    if tuple(getattr(f, "attribute", ())) != ("path",):
        return None
    return {
        datasource.EqualTo: lambda p: p == f.value,
        datasource.In: lambda p: p in f.value,
        datasource.StringStartsWith: lambda p: p.startswith(f.value),
        datasource.StringEndsWith: lambda p: p.endswith(f.value),
        datasource.StringContains: lambda p: f.value in p,
        datasource.IsNotNull: lambda p: True,
    }.get(type(f))


class TreeReader(datasource.DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.root = options["path"]
        self.partition_bytes, self.file_bytes = int(options.get("maxpartitionbytes", PARTITION_BYTES)), int(options.get("maxfilebytes", FILE_BYTES))
        self.tests = []

    def partitions(self) -> list[Files]:
        system, root = opened(self.root)
        found = system.get_file_info(fs.FileSelector(root, recursive=True))
        named = ((posixpath.relpath(f.path, root), f.size or 0, f.mtime) for f in found if f.type == fs.FileType.File)
        # names that begin with a dot or an underscore are Spark's and Hadoop's own
        shown = (f for f in named if not any(x[0] in "._" for x in f[0].split("/")))
        return packed((f for f in shown if all(test(f[0]) for test in self.tests)), self.partition_bytes) or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, root = opened(self.root)
        schema = pa.schema([("path", pa.string()), ("modified", pa.timestamp("us", "UTC")), ("length", pa.int64()), ("content", pa.binary()), ("text", pa.string()), ("error", pa.string())])
        rows, held = [], 0
        for path, length, modified in partition.files:
            content = text = error = None
            try:
                if length > self.file_bytes:
                    raise ValueError(f"longer than {self.file_bytes} bytes")
                with system.open_input_stream(f"{root}/{path}") as f:
                    content = f.read()
                text = content.decode("utf-8")
            except Exception as e:  # whatever is wrong with a file is its row's error
                error = f"{type(e).__name__}: {e}"[:500]
            rows.append((path, modified, length, content, text, error))
            held += length
            if held >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


class PushingReader(TreeReader):
    """A reader that takes filters; Spark refuses one where the session doesn't push filters down."""

    def pushFilters(self, filters: list[datasource.Filter]) -> Iterable[datasource.Filter]:
        for f in filters:
            test = keeps(f)
            if test is None:
                yield f
            else:
                self.tests.append(test)


class TreeWriter(datasource.DataSourceWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.root = options["path"]

    def write(self, rows: Iterator[Row]) -> datasource.WriterCommitMessage:
        system, root = opened(self.root)
        for row in rows:
            path = posixpath.normpath(row.path)
            if path.startswith(("/", "..")):
                raise ValueError(f"{row.path} leads out of the tree")
            system.create_dir(posixpath.dirname(f"{root}/{path}"), recursive=True)
            made = f"{root}/{posixpath.dirname(path)}/._{uuid.uuid4().hex}"
            with system.open_output_stream(made) as f:
                f.write(bytes(row.content) if isinstance(row.content, (bytes, bytearray)) else (row.content or "").encode())
            system.move(made, f"{root}/{path}")
        return datasource.WriterCommitMessage()

    def commit(self, messages: list[datasource.WriterCommitMessage | None]) -> None:
        """Every file is in place already."""

    def abort(self, messages: list[datasource.WriterCommitMessage | None]) -> None:
        """Files that are whole stay; a run that follows puts them in place again."""


class LandedTree(datasource.DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_tree"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> TreeReader:
        return (PushingReader if self.options.get("pushdown") == "true" else TreeReader)(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> TreeWriter:
        if overwrite:
            raise ValueError("a tree is written in append mode; files of the same path are replaced")
        return TreeWriter(dict(self.options))


def read(spark: SparkSession, folder: str, **options: str | int) -> DataFrame:
    """The files of a tree."""
    spark.dataSource.register(LandedTree)
    return spark.read.format("landed_tree").options(path=folder, pushdown=spark.conf.get(PUSHDOWN, "false"), **options).load()


def write(df: DataFrame, folder: str) -> None:
    """Each row of df (path, content) as a file of a tree."""
    df.sparkSession.dataSource.register(LandedTree)
    df.select("path", "content").write.format("landed_tree").option("path", folder).mode("append").save()
