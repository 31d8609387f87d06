"""Places and running sums in one global order, without a whole table or a whole group in one task.

A table is sorted into ranges of its order and written.  Each range is one task, which numbers its rows; how many rows,
or how much of a sum, came before a range is a table with one row per range and group, so that part is small whatever
the size of the table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from regionpulse.session import stage

# Bins of a group's values in each pass that looks for a threshold.
BINS = 1024
# Bits of a row's number inside its partition.
_IN_PARTITION = (1 << 33) - 1


def ranged(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """``df`` sorted into ranges and written, with ``_rango`` and ``_fila``: the range, and the place in it from 0.

    Rows that agree in the whole order stand in one range, in any order.
    """
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))
    return stage(rows.withColumns({"_rango": F.spark_partition_id(), "_fila": place}))


def _before(df: DataFrame, keys: list[str], amount: Column) -> DataFrame:
    """For each range and group its first place, and ``_antes``: what earlier ranges hold of the group."""
    sums = df.groupBy("_rango", *keys).agg(F.min("_fila").alias("_primera"), amount.alias("_suma"))
    earlier = W.partitionBy(*keys).orderBy("_rango").rowsBetween(W.unboundedPreceding, -1)
    return sums.withColumn("_antes", F.coalesce(F.sum("_suma").over(earlier), F.lit(0)))


def _joined(rows: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the row of their range and group; null keys meet."""
    names = ["_rango", *keys]
    renamed = small.select(*[F.col(c).alias(f"_{c}_") for c in names], *[c for c in small.columns if c not in names])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}_")) for c in names]
    return rows.join(renamed, same).drop(*[f"_{c}_" for c in names])


def numbered(df: DataFrame, order: Sequence[str | Column], name: str, keys: Sequence[str] = (), start: int = 0) -> DataFrame:
    """``df`` with the place of each row in the order, counted from ``start`` in each group of ``keys``.

    A range may hold the end of one group and the beginning of the next, and a group many ranges.
    """
    keys = list(keys)
    rows = ranged(df, [*keys, *order])
    place = F.col("_fila") - F.col("_primera") + F.col("_antes") + start
    # Without keys the sums are one row per range and go through one task.
    return _joined(rows, _before(rows, keys, F.count("*")), keys).withColumn(name, place).drop("_rango", "_fila", "_primera", "_suma", "_antes")


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], amount: str, name: str) -> DataFrame:
    """``df`` with the sum of ``amount`` over the earlier rows of its group, 0 for the first."""
    keys = list(keys)
    rows = ranged(df, [*keys, *order])
    in_range = W.partitionBy("_rango", *keys).orderBy("_fila").rowsBetween(W.unboundedPreceding, -1)
    local = rows.withColumn("_local", F.coalesce(F.sum(amount).over(in_range), F.lit(0)))
    total = F.col("_local") + F.col("_antes")
    return _joined(local, _before(rows, keys, F.sum(amount)), keys).withColumn(name, total).drop("_rango", "_fila", "_primera", "_suma", "_antes", "_local")


def _narrowed(values: DataFrame, keys: list[str], bounds: DataFrame) -> DataFrame:
    """The bounds of the bin that holds each group's ``_k``-th value, out of the bins between its bounds.

    ``bounds`` has ``_bajo``, ``_alto`` and ``_k``, which counts from the lower bound.  Groups with fewer values go.
    """
    inside = _grouped_join(values, bounds, keys).where(F.col("_valor").between(F.col("_bajo"), F.col("_alto")))
    part = (F.col("_valor") - F.col("_bajo")) / (F.col("_alto") - F.col("_bajo"))
    number = F.when(F.col("_alto") > F.col("_bajo"), F.least(F.floor(part * BINS), F.lit(BINS - 1))).otherwise(0)
    # At most BINS rows per group.
    counts = inside.groupBy(*keys, number.alias("_bin")).agg(
        F.count("*").alias("_n"), F.first("_k").alias("_k"), F.min("_valor").alias("_bajo"), F.max("_valor").alias("_alto")
    )
    upto = F.sum("_n").over(W.partitionBy(*keys).orderBy("_bin").rowsBetween(W.unboundedPreceding, 0))
    reached = counts.withColumn("_antes", upto - F.col("_n")).where((F.col("_antes") < F.col("_k")) & (F.col("_antes") + F.col("_n") >= F.col("_k")))
    return stage(reached.select(*keys, "_bajo", "_alto", (F.col("_k") - F.col("_antes")).alias("_k")))


def _grouped_join(rows: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the columns of their group, null keys included; groups without a row in ``small`` stay."""
    renamed = small.select(*[F.col(c).alias(f"_{c}_") for c in keys], *[c for c in small.columns if c not in keys])
    return rows.join(renamed, [F.col(c).eqNullSafe(F.col(f"_{c}_")) for c in keys], "left").drop(*[f"_{c}_" for c in keys])


def likely_first(df: DataFrame, keys: Sequence[str], k: int, by: Column) -> DataFrame:
    """The rows that can be among the first ``k`` of their group when ``by`` does not fall along the order.

    Two histograms of each group, the second inside the bin with the ``k``-th value, leave little more than ``k`` rows
    and those that are equal to the last of them.  Rows without ``by``, or where it is no finite number, stay.
    """
    keys = list(keys)
    number = by.cast("double")
    rows = df.withColumn("_valor", F.when(number.isNotNull() & ~F.isnan(number) & (F.abs(number) < 1e300), number))
    values = rows.where("_valor IS NOT NULL").select(*keys, "_valor")
    bounds = values.groupBy(*keys).agg(F.min("_valor").alias("_bajo"), F.max("_valor").alias("_alto"))
    bounds = stage(bounds.withColumn("_k", F.lit(k).cast("long")))
    for _ in range(2):
        bounds = _narrowed(values, keys, bounds)
    last = _grouped_join(rows, bounds.select(*keys, "_alto"), keys)
    return last.where("_valor IS NULL OR _alto IS NULL OR _valor <= _alto").drop("_valor", "_alto")
