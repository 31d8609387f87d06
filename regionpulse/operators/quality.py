"""Data-quality counters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def news_counters() -> list[Column]:
    """Rows, rows without a state and rows without a date."""
    return [
        F.count(F.lit(1)).alias("filas"),
        F.count_if(F.col("estado").isNull()).alias("sin_estado"),
        F.count_if(F.col("fecha_dt").isNull()).alias("sin_fecha"),
    ]


def quake_counters() -> list[Column]:
    """Events, and events outside every radius."""
    return [
        F.count(F.lit(1)).alias("sismos"),
        F.count_if(F.col("estado").isNull()).alias("fuera_de_radio"),
    ]


def count_news(df: DataFrame) -> DataFrame:
    return df.agg(*news_counters())


def count_quakes(df: DataFrame) -> DataFrame:
    return df.agg(*quake_counters())


def observed(df: DataFrame, name: str, counters: list[Column]) -> tuple[DataFrame, Observation]:
    """Attach counters to a running job, so they cost no extra pass."""
    observation = Observation(name)
    return df.observe(observation, *counters), observation


class Counters:
    """Counters of the steps of a job, gathered by the run that writes its results: no step is read a second time.

    A stage that runs again after a lost executor may count some rows twice, as all of Spark's metrics.
    """

    def __init__(self) -> None:
        self._steps: list[tuple[str, Observation]] = []

    def watch(self, df: DataFrame, step: str, counters: list[Column] | None = None) -> DataFrame:
        """``df``, counted as it passes; rows alone unless counters are given."""
        watched, observation = observed(df, f"{step}-{uuid.uuid4().hex}", counters or [F.count(F.lit(1)).alias("filas")])
        self._steps.append((step, observation))
        return watched

    def table(self, spark: SparkSession) -> DataFrame:
        """``(paso, contador, valor)`` of everything watched; waits for the runs of the watched tables."""
        rows = [(step, name, value) for step, observation in self._steps for name, value in observation.get.items()]
        return spark.createDataFrame(rows, "paso string, contador string, valor long")


def counted(write: Callable[[DataFrame, int], None], path: str, counters: list[Column]) -> Callable[[DataFrame, int], None]:
    """A stream's batch writer whose counters go into a table, in a partition of each batch; a repeated batch replaces its own."""

    def run(batch: DataFrame, batch_id: int) -> None:
        gathered = Counters()
        write(gathered.watch(batch, "lote", counters), batch_id)
        gathered.table(batch.sparkSession).drop("paso").write.mode("overwrite").parquet(f"{path}/lote={batch_id}")

    return run


def dedupe_counters(before: DataFrame, key: str) -> DataFrame:
    """Rows before and after deduplication by a key (null keys are one key)."""
    per_key = before.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("antes"), F.count("*").alias("despues")
    )


def ledger_counters(df: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Rows in total, and rows a ledger already holds; counted per key before the join."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    known = ledger.select(F.col(key).alias("_known")).distinct()
    joined = per_key.join(known, F.col(key) == F.col("_known"), "left")
    held = F.when(F.col("_known").isNotNull(), F.col("n"))
    return joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("filas"),
        F.coalesce(F.sum(held), F.lit(0)).cast("long").alias("omitidas"),
    )
