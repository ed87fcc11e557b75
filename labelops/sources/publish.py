"""Published tables: data under a path of its own, and a numbered manifest that makes it the current version.

A rename is no commit on an object store, and a reader may look between two renames. Here data is written to a folder that no one
else uses, and one small manifest, created under its number only if that number is free, names it. Readers take the
highest complete manifest. A writer that dies leaves data that no manifest names; of two writers that start from the same version one
finds the number taken and leaves what it wrote unpublished.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MANIFESTS = "_manifests"
DIGITS = 12


def hadoop_path(spark: SparkSession, path: str):
    """The file system of a path and the path, as the JVM knows them."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def create_once(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file with its whole content; FileExistsError when there is one already.

    On a local (or mounted) folder a complete file is linked under the name, elsewhere the store's own exclusive create is used.
    """
    fs, target = hadoop_path(spark, path)
    if fs.getUri().getScheme() == "file":
        local = target.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        hidden = f"{os.path.dirname(local)}/.{uuid.uuid4()}"
        with open(hidden, "w", encoding="utf-8") as f:
            f.write(text)
        try:
            os.link(hidden, local)
        finally:
            os.unlink(hidden)
        return
    try:
        out = fs.create(target, False)
    except Exception as e:
        if "FileAlreadyExists" in str(e):
            raise FileExistsError(path) from e
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all manifests, complete or not, in order."""
    fs, folder = hadoop_path(spark, f"{root.rstrip('/')}/{MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n.split(".")[0]) for n in names if re.fullmatch(rf"\d{{{DIGITS}}}\.json", n))


def _manifest_path(root: str, number: int) -> str:
    return f"{root.rstrip('/')}/{MANIFESTS}/{number:0{DIGITS}d}.json"


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict | None:
    """The manifest of a version, by default the highest complete one; None when there is none.

    A manifest a writer died in is not complete and is passed over; asking for it by its number is an error."""
    for n in [version] if version is not None else reversed(numbers(spark, root)):
        fs, target = hadoop_path(spark, _manifest_path(root, n))
        source = fs.open(target)
        try:
            body = bytes(source.readAllBytes()).decode("utf-8", "replace")
        finally:
            source.close()
        try:
            found = json.loads(body)
        except json.JSONDecodeError:
            if version is not None:
                raise ValueError(f"version {n} of {root} is not complete") from None
            continue
        return found
    return None


class Draft:
    """Data written for a root but not published: ``path`` to look at it, then ``commit`` or ``discard``."""

    def __init__(self, df: DataFrame, root: str, partition_by: Sequence[str] = ()):
        self.spark, self.root = df.sparkSession, root.rstrip("/")
        seen = numbers(self.spark, root)
        self.base = seen[-1] if seen else 0
        self.data = f"data-{uuid.uuid4()}"
        self.path = f"{self.root}/{self.data}"
        self.schema = df.schema
        out = df.hint("rebalance", *partition_by) if partition_by else df
        out.write.partitionBy(*partition_by).parquet(self.path)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    def commit(self, **facts) -> int:
        """Publish as the version after the one that was current when the draft was begun."""
        number = self.base + 1
        body = {"version": number, "data": self.data, "schema": self.schema.jsonValue(), **facts}
        try:
            create_once(self.spark, _manifest_path(self.root, number), json.dumps(body, sort_keys=True))
        except FileExistsError:
            self.discard()
            raise FileExistsError(f"version {number} of {self.root} was published by another writer") from None
        except Exception:
            self.discard()
            raise
        return number

    def discard(self) -> None:
        fs, target = hadoop_path(self.spark, self.path)
        fs.delete(target, True)


def read_published(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The rows of a version, by default the current one."""
    found = manifest(spark, root, version)
    if found is None:
        raise FileNotFoundError(f"nothing is published at {root}")
    return spark.read.schema(T.StructType.fromJson(found["schema"])).parquet(f"{root.rstrip('/')}/{found['data']}")


def expire(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove versions before the last ``keep`` complete ones, data first named by them; drafts of others stay."""
    complete = [n for n in numbers(spark, root) if _is_complete(spark, root, n)]
    for n in complete[: max(0, len(complete) - keep)]:
        data = manifest(spark, root, n)["data"]
        # the manifest goes first, so that no reader starts on data that is going
        for path in (_manifest_path(root, n), f"{root.rstrip('/')}/{data}"):
            fs, target = hadoop_path(spark, path)
            fs.delete(target, True)


def remove_drafts(spark: SparkSession, root: str, older_than_ms: int = 7 * 24 * 3_600_000) -> list[str]:
    """Remove data no manifest names, last changed longer ago than that: what writers that died have left."""
    fs, folder = hadoop_path(spark, root)
    if not fs.exists(folder):
        return []
    named = {manifest(spark, root, n)["data"] for n in numbers(spark, root) if _is_complete(spark, root, n)}
    now = spark.sparkContext._jvm.java.lang.System.currentTimeMillis()
    found = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("data-") and now - s.getModificationTime() >= older_than_ms]
    gone = [p for p in found if p.getName() not in named]
    for p in gone:
        fs.delete(p, True)
    return sorted(p.getName() for p in gone)


def _is_complete(spark: SparkSession, root: str, number: int) -> bool:
    try:
        return manifest(spark, root, number) is not None
    except ValueError:
        return False
