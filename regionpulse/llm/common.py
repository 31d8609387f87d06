"""Small helpers of the training-data operators."""

from __future__ import annotations

import gc
import sys
import time

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LAST = (1 << 63) - 1


def ship(module: str) -> None:
    """Send the functions of ``module`` to the executors by value, so that these need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def id_of(column: str = "doc_id") -> Column:
    """The id as a long that orders nulls last."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST))


def held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with ``value`` as a column that is computed once a row.

    Catalyst merges a projection into the next one, which would evaluate the value again for every element when a
    lambda refers to it; a generator stands between them.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def carried(docs: DataFrame) -> list[Column]:
    """The columns of ``docs`` under names that no operator uses inside, so that they may have any names."""
    return [_quoted(c).alias(f"carried_{k}") for k, c in enumerate(docs.columns)]


def restored(docs: DataFrame, **new: Column) -> list[Column]:
    """The ``carried`` columns under their own names, with some replaced."""
    return [new.get(c, F.col(f"carried_{k}")).alias(c) for k, c in enumerate(docs.columns)]


def text_batches(spark: SparkSession) -> None:
    """Batches of texts for Python workers: Spark's default of 10,000 rows is too much where rows are whole documents."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def release(spark: SparkSession) -> None:
    """Let the driver forget finished stages, so that Spark deletes their shuffle files.

    Spark's cleaner learns of them from the garbage collector and works in the background; the second round takes
    what the first has made unreachable.
    """
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


ship(__name__)
