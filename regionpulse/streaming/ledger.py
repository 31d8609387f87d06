"""Streams that send each key once, and streams that grow a timeline."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from regionpulse.operators.dedupe import first_per_group
from regionpulse.session import scratch_scope, stage
from regionpulse.sources import key_index
from regionpulse.sources.readers import read_or_empty

BatchWriter = Callable[[DataFrame, int], None]


def ledger_batch(
    key: str, ledger: str, order: list[str], also: BatchWriter | None = None, stream: str = "stream"
) -> BatchWriter:
    """``foreachBatch`` body: rows whose key is new go into the ledger, in a partition of this stream and batch.

    ``stream`` names the run of a checkpoint: a stream that starts with a new
    checkpoint numbers its batches from 0 again and needs a new name, so that it
    sees, and keeps, what earlier ones wrote.  A batch that is repeated after a
    failure ignores its own partition and overwrites it, so a key is recorded
    once and the result is the same.  Rows without a key are not recorded.
    ``also`` sees the new rows of the batch, for instance to send them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        own = f"{stream}-{batch_id}"
        schema = batch.select(key).schema.add("batch_id", "string")
        seen = (
            read_or_empty(batch.sparkSession, ledger, schema)
            .where(F.col("batch_id") != own)
            .select(key)
        )
        keyed = batch.where(F.col(key).isNotNull())
        new = first_per_group(keyed, [key], order).join(seen, key, "left_anti")
        target = f"{ledger}/batch_id={own}"
        new.write.mode("overwrite").parquet(target)
        if also is not None:
            also(batch.sparkSession.read.schema(batch.schema).parquet(target), batch_id)

    return write


def start_ledger_stream(
    rows: DataFrame,
    key: str,
    ledger: str,
    checkpoint: str,
    order: list[str],
    also: BatchWriter | None = None,
    stream: str | None = None,
) -> StreamingQuery:
    """Run :func:`ledger_batch` over everything available, resuming from the checkpoint.

    Unless named, the stream is called after its checkpoint's folder.
    """
    name = stream or hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    return (
        rows.writeStream.foreachBatch(ledger_batch(key, ledger, order, also, name))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def indexed_batch(
    key: str, ledger: str, outbox: str, order: list[str], also: BatchWriter | None = None, stream: str = "stream"
) -> BatchWriter:
    """:func:`ledger_batch` over an indexed ledger: a batch opens only the partitions that may hold its keys.

    New rows are written to the outbox of the batch, then their keys are recorded, then ``also`` sees them.  A batch
    that runs again does not see its own keys and replaces both.  Sets of earlier batches of this stream, which cannot
    run again, are merged as the ledger grows.
    """

    def done(entry: dict, batch_id: int) -> bool:
        name, _, number = entry.get("lote", "").rpartition("-")
        return not name or (name == stream and int(number) < batch_id)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, own = batch.sparkSession, f"{stream}-{batch_id}"
        # Scratch tables of a batch go with it; a stream has batches without end.
        with scratch_scope(spark):
            key_index.compact(spark, ledger, lambda entry: done(entry, batch_id))
            keyed = stage(first_per_group(batch.where(F.col(key).isNotNull()), [key], order))
            new = stage(key_index.unseen(keyed, key, ledger, without=own), f"{outbox}/{own}")
            key_index.record(new, key, ledger, own)
            if also is not None:
                also(new, batch_id)

    return write


def start_indexed_stream(
    rows: DataFrame,
    key: str,
    ledger: str,
    checkpoint: str,
    order: list[str],
    also: BatchWriter | None = None,
    stream: str | None = None,
) -> StreamingQuery:
    """Run :func:`indexed_batch` over everything available, resuming from the checkpoint; the outbox is in the ledger's folder."""
    name = stream or hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    return (
        rows.writeStream.foreachBatch(indexed_batch(key, ledger, f"{ledger}/salida", order, also, name))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_append_stream(
    rows: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None
) -> StreamingQuery:
    """Append new rows to a Parquet table, each input file once; a restart resumes."""
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.outputMode("append").trigger(availableNow=True).start(path)


def start_timeline_stream(snapshots: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Timeline of rain or earthquake snapshots: every run adds, nothing is replaced."""
    dated = snapshots.withColumn("fecha_calculo_dia", F.to_date("fecha_calculo"))
    return start_append_stream(dated, path, checkpoint, ["fecha_calculo_dia"])
