"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state on local disk instead of the heap: deduplication keys only grow.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(
    app_name: str = "regionpulse", master: str | None = None, **extra: str
) -> SparkSession:
    """Session with UTC timestamps and adaptive execution; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only when that is unset
    (tests, one machine) is a local folder made, once per session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="regionpulse-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


# Scratch paths of the open scopes, the innermost last.
_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path under the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, on whatever store it is; nothing if it is not there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch tables that are made inside, when what they are for has been written.

    Tables that are read after the scope must have a path of their own.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete_path(spark, path)


@contextmanager
def text_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of texts for the Python workers of what is run inside: 10,000 rows are too many where rows are whole documents."""
    limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}
    before = {key: spark.conf.get(key) for key in limits}
    try:
        for key, value in limits.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def spread(df: DataFrame) -> DataFrame:
    """Rows of a small input over all cores, for work that is heavy per row.

    A file with one row group is one task however many cores there are.  An
    input that already has a task per core is returned as it is, so a large
    scan is never shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


#: Rows that a file of a small table holds at least, where their number is known.
TASK_ROWS = 100_000


def sized(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of at most ``rows`` rows, in as many parts as these call for, if that is well below the shuffle's number.

    A table of some thousand rows is otherwise written as a file for every
    shuffle partition; on a local file system each file also starts processes.
    The rows are dealt out anew, as ``coalesce`` would have one task make what
    many do and hold the sorters of all their joins.
    """
    parts = max(1, -(-rows // TASK_ROWS))
    return df.repartition(parts) if 2 * parts <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def stage(df: DataFrame, path: str | None = None, partition_by: list[str] | None = None, rows: int | None = None) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where a result feeds several outputs: a written table survives the
    loss of executors, and later branches prune columns at the scan.  With
    ``rows``, a bound on their number, small tables are written in few files.
    """
    spark = df.sparkSession
    if rows is not None:
        df = sized(df, rows)
    path = path or scratch_path(spark, "stage")
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
