"""Versions of a table that readers find, each made visible by one step.

The files of a version are written first, under names of their own.  Then an entry that names them appears in the
folder of commits, under the next number, by a rename that fails if another writer has taken the number.  Readers take
the entry with the highest number, so they see the last complete version and never a part of one; of two writers that
began from the same version one wins and the other learns of it.

The file system must refuse a rename onto a file that exists, as HDFS does.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from regionpulse.sources.sinks import write_version

COMMITS = "_commits"


class Conflict(RuntimeError):
    """Another writer has made the next version."""


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, root: str):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return _path(spark, root).getFileSystem(conf), spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, root).toUri(), conf
    )


def _numbers(spark: SparkSession, root: str) -> list[int]:
    files, _ = _files(spark, root)
    folder = _path(spark, f"{root}/{COMMITS}")
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))


def latest(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and entry of the last version; 0 and an empty entry before the first."""
    numbers = _numbers(spark, root)
    return (numbers[-1], entry(spark, root, numbers[-1])) if numbers else (0, {})


def entry(spark: SparkSession, root: str, number: int) -> dict:
    """The entry of one version."""
    files, _ = _files(spark, root)
    stream = files.open(_path(spark, f"{root}/{COMMITS}/{number:012d}.json"))
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, root: str, content: dict, base: int) -> int:
    """Make ``content`` the version after ``base``; :class:`Conflict` if there is one already."""
    files, context = _files(spark, root)
    number = base + 1
    written = _path(spark, f"{root}/{COMMITS}/.{uuid.uuid4().hex}")
    stream = files.create(written, False)
    try:
        stream.write(bytearray(json.dumps(content), "utf-8"))
    finally:
        stream.close()
    target = f"{root}/{COMMITS}/{number:012d}.json"
    never = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(written, _path(spark, target), never)
    except Py4JJavaError as error:
        files.delete(written, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            raise Conflict(f"version {number} of {root} was written by another writer") from None
        raise
    return number


def commit_version(df: DataFrame, root: str, base: int | None = None) -> int:
    """Write ``df`` as the next version of the table and return its number.

    ``base`` is the version that ``df`` was made from, the last one unless given.  On :class:`Conflict` nothing is
    visible of ``df``; a writer that merges reads the new version and tries again.
    """
    spark = df.sparkSession
    if base is None:
        base = latest(spark, root)[0]
    return commit(spark, root, {"path": write_version(df, root).removeprefix(root.rstrip("/")).lstrip("/")}, base)


def read_version(spark: SparkSession, root: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """The last version of a table, or a given one; empty before the first."""
    found = latest(spark, root)[1] if version is None else entry(spark, root, version)
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{found['path']}")


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete all but the last ``keep`` versions and what no version names: files of writers that failed or lost.

    Only for times when nobody writes.
    """
    files, _ = _files(spark, root)
    numbers = _numbers(spark, root)
    named = {entry(spark, root, n)["path"] for n in numbers[-keep:]}
    for number in numbers[:-keep]:
        files.delete(_path(spark, f"{root}/{COMMITS}/{number:012d}.json"), False)
    for status in files.listStatus(_path(spark, root)):
        if status.getPath().getName().startswith("version=") and status.getPath().getName() not in named:
            files.delete(status.getPath(), True)
