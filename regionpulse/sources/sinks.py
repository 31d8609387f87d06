"""Writers: accumulated tables, increments, timelines, exports and publication."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionpulse.operators.dedupe import not_seen
from regionpulse.sources.readers import read_or_empty

OUTCOME = T.StructType(
    [T.StructField("row_id", T.StringType()), T.StructField("estado_envio", T.IntegerType()),
     T.StructField("respuesta", T.StringType())]
)


def write_version(df: DataFrame, root: str) -> str:
    """Rewrite a table as a new version folder and return its path.

    The old version stays readable while the new one is written, so a plan
    that reads it can also replace it.
    """
    path = f"{root.rstrip('/')}/version={uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return path


def write_news(df: DataFrame, path: str) -> None:
    """Processed news, partitioned by publication date.

    The rebalance hint gathers each day into few files and lets adaptive
    execution split the days that are too large for one task.
    """
    dated = df.withColumn("fecha_particion", F.col("fecha_dt"))
    dated.hint("rebalance", "fecha_particion").write.mode("overwrite").partitionBy(
        "fecha_particion"
    ).parquet(path)


def append_increment(df: DataFrame, path: str, key: str) -> None:
    """Append only the rows whose key the table does not hold yet."""
    saved = read_or_empty(df.sparkSession, path, df.schema).select(key)
    not_seen(df, saved, key).write.mode("append").parquet(path)


def append_snapshot(df: DataFrame, path: str, calculated: str = "fecha_calculo") -> None:
    """Add a snapshot to a timeline; history is never rewritten."""
    dated = df.withColumn("fecha_calculo_dia", F.to_date(calculated))
    dated.write.mode("append").partitionBy("fecha_calculo_dia").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV export with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def publish(
    rows: DataFrame,
    row_id: str,
    deliver: Callable[[pd.DataFrame], list[tuple[int, str]]],
    outcome_path: str,
) -> DataFrame:
    """Send rows through a caller-supplied sink and return the outcome of each.

    ``deliver`` takes a batch without the ``row_id`` column, which is its index, and gives one
    ``(status, text)`` per row, in order.  It runs inside the tasks, one batch at a time; a task that is run again
    delivers again, with the same index, by which a receiver can tell repeats.  Outcomes are
    written before they are read, so later steps do not send again.
    """
    columns = [c for c in rows.columns if c != row_id]

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            results = deliver(batch.set_index(row_id)[columns])
            yield pd.DataFrame(
                {
                    "row_id": batch[row_id].astype("string"),
                    "estado_envio": [status for status, _ in results],
                    "respuesta": [text for _, text in results],
                }
            )

    rows.mapInPandas(send, OUTCOME).write.mode("overwrite").parquet(outcome_path)
    return rows.sparkSession.read.schema(OUTCOME).parquet(outcome_path)


def failed(outcomes: DataFrame) -> DataFrame:
    """Outcomes the receiver did not accept."""
    return outcomes.where(~F.coalesce(F.col("estado_envio").isin(200, 201), F.lit(False)))


def sent_rows(rows: DataFrame, row_id: str, outcomes: DataFrame) -> DataFrame:
    """Rows with an accepted outcome and no failed one: only these may enter the ledger.

    A row without an outcome, or with a null id, was not sent.
    """
    accepted = F.coalesce(F.col("estado_envio").isin(200, 201), F.lit(False))
    sent = outcomes.where(F.col("row_id").isNotNull()).groupBy(F.col("row_id").alias("_sent")).agg(F.bool_and(accepted).alias("_ok"))
    return rows.join(sent.where("_ok"), F.col(row_id).cast("string") == F.col("_sent"), "left_semi")
