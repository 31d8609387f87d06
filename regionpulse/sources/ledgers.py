"""Ledgers of what was already sent.

A ledger is a Parquet table partitioned by ``batch_id`` that only grows: a batch
appends its keys, also when it runs again with other rows.  Every read is a set,
so keys that a repeated batch writes twice do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from regionpulse.sources.readers import read_or_empty
from regionpulse.sources.schemas import LEDGER_ALERTS, LEDGER_URLS


def _with_batch(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("batch_id", T.StringType())])


def read_sent_ledger(spark: SparkSession, path: str) -> DataFrame:
    """URLs already sent; empty when there is no ledger yet."""
    return read_or_empty(spark, path, _with_batch(LEDGER_URLS)).select("url").distinct()


def read_alert_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Alert keys already sent; empty when there is no ledger yet."""
    return read_or_empty(spark, path, _with_batch(LEDGER_ALERTS)).select("clave").distinct()


def ledger_union(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old entries plus new ones, each once."""
    return old.select(key).union(new.select(key)).distinct()


def record_batch(keys: DataFrame, key: str, path: str, batch_id: str | int) -> None:
    """Add the keys of one batch; what the ledger holds already stays."""
    keys.select(key).distinct().write.mode("append").parquet(f"{path}/batch_id={batch_id}")


def compact_ledger(spark: SparkSession, path: str, target: str, key: str) -> None:
    """Rewrite many small batches as one ledger at ``target``, sorted within files."""
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField("batch_id", T.StringType())])
    entries = read_or_empty(spark, path, schema).select(key).distinct()
    entries.sortWithinPartitions(key).write.mode("overwrite").parquet(f"{target}/batch_id=compact")
