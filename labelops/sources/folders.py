"""Folders as a Spark data source: listed in the tasks, one input partition per folder prefix.

Spark's own file readers list on the driver and keep every file there. Here the driver lists only the folders down to
the depth a scan needs (classes, or splits and classes); each of these prefixes is listed by a task, which passes its
files on as rows. Content is read only when a digest is asked for, in tasks that are dealt by bytes, chunk by chunk.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from labelops.lineage import stored

FORMAT = "labelops_folder"
SCHEMA = "path string, rel string, length bigint, mtime timestamp"
#: Rows of one batch, and bytes of a file that are held while it is hashed.
BATCH_ROWS, CHUNK_BYTES = 10_000, 1 << 20
#: Bytes a hashing task gets.
TASK_BYTES = 128 << 20


def filesystem(folder: str):
    """A worker's file system for a folder, and the folder's path in it; ValueError where there is none for the scheme."""
    from pyarrow import fs

    if folder.startswith("file:"):
        return fs.LocalFileSystem(), unquote(re.sub("^file:/+", "/", folder)) if "%" in folder else re.sub("^file:/+", "/", folder)
    if re.match("^[A-Za-z][A-Za-z0-9+.-]*://", folder):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(), os.path.abspath(folder)


def qualified(spark: SparkSession, root: str) -> str:
    """The folder as its file system spells it, without a closing slash; local paths as ``file:/...``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub("^file:/+", "file:/", base).rstrip("/")


@dataclass
class Prefix(InputPartition):
    """A folder below the root, with everything below it or with its own files alone."""

    rel: str
    recursive: bool


def _children(fs, base: str, rel: str):
    """(name, info) of what lies in a folder; hidden names are left out."""
    from pyarrow import fs as pfs

    folder = f"{base}/{rel}" if rel else base
    for info in fs.get_file_info(pfs.FileSelector(folder)):
        if not info.base_name.startswith("."):
            yield f"{rel}/{info.base_name}" if rel else info.base_name, info


class FolderReader(DataSourceReader):
    def __init__(self, root: str, suffixes: tuple[str, ...], depth: int):
        self.root, self.suffixes, self.depth = root, suffixes, depth

    def partitions(self) -> Sequence[InputPartition]:
        from pyarrow import fs as pfs

        fs, base = filesystem(self.root)
        level, found = [""], []
        for _ in range(self.depth):
            found += [Prefix(rel, False) for rel in level]
            level = [name for rel in level for name, info in _children(fs, base, rel) if info.type == pfs.FileType.Directory]
        return sorted([*found, *[Prefix(rel, True) for rel in level]], key=lambda p: p.rel)

    def read(self, partition: Prefix) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs as pfs

        fs, base = filesystem(self.root)
        schema = pa.schema([("path", pa.string()), ("rel", pa.string()), ("length", pa.int64()), ("mtime", pa.timestamp("us", "UTC"))])
        folders, rows = [partition.rel], []
        while folders:
            for rel, info in _children(fs, base, folders.pop()):
                if info.type == pfs.FileType.Directory:
                    if partition.recursive:
                        folders.append(rel)
                elif not self.suffixes or rel.lower().endswith(self.suffixes):
                    rows.append((f"{self.root}/{rel}", rel, info.size, (info.mtime_ns or 0) // 1000))
                if len(rows) >= BATCH_ROWS:
                    yield self._batch(rows, schema)
                    rows = []
        if rows:
            yield self._batch(rows, schema)

    @staticmethod
    def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class FolderSource(DataSource):
    """Options: ``path`` (qualified), ``suffixes`` (comma-separated, lower case, with the dot), ``depth`` of the folders that make a partition each."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> FolderReader:
        suffixes = tuple(s for s in self.options.get("suffixes", "").split(",") if s)
        return FolderReader(self.options["path"], suffixes, int(self.options.get("depth", "1")))


def can_list(root: str) -> bool:
    """Whether workers have a file system for the (qualified) folder."""
    try:
        filesystem(root)
    except Exception:  # an unknown scheme or a store without its library
        return False
    return True


def list_folder(spark: SparkSession, root: str, extensions: Sequence[str] | None = None, depth: int = 1) -> DataFrame:
    """(path, rel, length, mtime) of the files below ``root``; names that begin with a dot are hidden.

    ``rel`` is the path below the root. With ``extensions`` only these, in any case. Folders down to ``depth`` are
    listed by the driver, what is below each of them by one task. A missing root is an error; an empty one gives no row.
    """
    spark.dataSource.register(FolderSource)
    suffixes = ",".join(e.lower() for e in extensions or ())
    return spark.read.format(FORMAT).option("path", qualified(spark, root)).option("suffixes", suffixes).option("depth", str(depth)).load()


def add_digest(files: DataFrame, keep: F.Column | None = None) -> DataFrame:
    """A written listing with ``content_hash``, the SHA-256 of each file; NULL where ``keep`` is false.

    Tasks get about TASK_BYTES each, so that a class with many files is hashed by many tasks.
    """
    spark = files.sparkSession
    wanted = F.lit(True) if keep is None else keep
    total = files.agg(F.sum(F.when(wanted, F.col("length"))).alias("n")).first()["n"] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    schema = T.StructType([*files.schema.fields, T.StructField("_wanted", T.BooleanType()), T.StructField("content_hash", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict = {}
        for batch in batches:
            hashes = []
            for path, on in zip(batch.column("path").to_pylist(), batch.column("_wanted").to_pylist()):
                if not on:
                    hashes.append(None)
                    continue
                folder, _, name = path.rpartition("/")
                if folder not in opened:
                    opened.clear()
                    opened[folder] = filesystem(folder)
                fs, base = opened[folder]
                state = hashlib.sha256()
                with fs.open_input_stream(f"{base}/{name}", compression=None) as source:
                    while chunk := source.read(CHUNK_BYTES):
                        state.update(chunk)
                hashes.append(state.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes, pa.string())], names=[*batch.schema.names, "content_hash"])

    return files.withColumn("_wanted", wanted).repartition(tasks).mapInArrow(run, schema).drop("_wanted")


def write_files(rows: DataFrame, root: str, name: str = "rel", content: str = "content") -> DataFrame:
    """Write each row's binary content as a file ``<root>/<name>``, in the tasks; returns what was written as (rel, length), a written table.

    A file appears under its name only when it is complete: it is written beside it under a hidden name and moved, so
    a task that runs twice leaves the same files. Names must be relative and stay below the root; NULL content is an
    empty file. Of rows with the same name the last one written stays.
    """
    base = qualified(rows.sparkSession, root)
    schema = T.StructType([T.StructField("rel", T.StringType()), T.StructField("length", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, top = filesystem(base)
        made: set[str] = set()
        for batch in batches:
            names, sizes = batch.column(0).to_pylist(), []
            for rel, body in zip(names, batch.column(1)):
                parts = (rel or "").split("/")
                if any(p in ("", ".", "..") for p in parts):
                    raise ValueError(f"not a name below the root: {rel!r}")
                folder = "/".join([top, *parts[:-1]])
                if folder not in made:
                    if len(made) > BATCH_ROWS:
                        made.clear()
                    fs.create_dir(folder, recursive=True)
                    made.add(folder)
                data = body.as_py() or b""
                hidden = f"{folder}/.{uuid.uuid4()}"
                with fs.open_output_stream(hidden, compression=None) as sink:
                    sink.write(data)
                fs.move(hidden, f"{folder}/{parts[-1]}")
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], names=["rel", "length"])

    return stored(rows.select(F.col(name).alias("rel"), F.col(content).cast("binary").alias("content")).mapInArrow(run, schema))
