"""Unions and order-aware deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from regionpulse.operators.ordering import likely_first, numbered
from regionpulse.sources.schemas import REDUNDANT_COLUMNS

# Up to this many rows per group Spark limits each group before the shuffle.
MAP_SIDE_LIMIT = 1000

def not_seen(rows: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key ``seen`` does not hold; null matches null.

    Rows without a key take no part in the shuffle: whether they stay hangs on
    one row at most of ``seen``.
    """
    given = F.col(key).isNotNull()
    keys = seen.select(F.col(key).alias("_seen"))
    fresh = rows.where(given).join(keys, F.col(key) == F.col("_seen"), "left_anti")
    null_seen = keys.where("_seen IS NULL").limit(1).select(F.lit(0).alias("_nula"))
    without = rows.where(~given).withColumn("_cero", F.lit(0))
    kept = without.join(F.broadcast(null_seen), F.col("_cero") == F.col("_nula"), "left_anti").drop("_cero")
    return fresh.unionByName(kept)


def first_per_group(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column], k: int = 1, rank: str | None = None,
    by: Column | None = None,
) -> DataFrame:
    """The first ``k`` rows of each group in the given order.

    For ``k`` within the planner's limit each task keeps ``k`` rows per group
    before the shuffle, so a group with most of the rows stays cheap.  Above
    it the rows are sorted into ranges and numbered through all ranges of
    their group.  ``by``, a number that never falls along the order, spares
    most rows of a large group that sort: histograms of it tell how far the
    first ``k`` can reach.  ``rank`` names an output column with the position
    in the group.
    """
    position = rank or "_pos"
    if k <= MAP_SIDE_LIMIT:
        ranked = df.withColumn(position, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    else:
        named = {f"_clave{i}": c for i, c in enumerate(keys) if isinstance(c, Column)}
        df = df.withColumns(named)
        names = [f"_clave{i}" if isinstance(c, Column) else c for i, c in enumerate(keys)]
        if by is not None:
            df = likely_first(df, names, k, by)
        ranked = numbered(df, order, position, names, start=1).drop(*named)
    kept = ranked.where(F.col(position) <= k)
    return kept if rank else kept.drop(position)


def keep_first(df: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """First row per key; all null keys are one group."""
    return first_per_group(df, [key], order)


def union_by_name(*parts: DataFrame) -> DataFrame:
    """Union by column name; a column missing on one side is null there."""
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def drop_redundant(df: DataFrame) -> DataFrame:
    """Drop columns other columns already cover; absent ones are ignored."""
    return df.drop(*REDUNDANT_COLUMNS)


def adapt_social(df: DataFrame) -> DataFrame:
    """Social-media variant: no profile link, likes and comments always present."""
    df = df.drop("profile_url")
    for name in ("likes", "comments"):
        if name not in df.columns:
            df = df.withColumn(name, F.lit(""))
    return df


def dedupe_key(df: DataFrame) -> str:
    """``url``, or ``source_url`` for social-media tables."""
    return "url" if "url" in df.columns else "source_url"


def merge_parts(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """United parts -> one row per key, first part and row winning, redundant columns gone."""
    if "url" not in df.columns:
        df = adapt_social(df)
    return keep_first(drop_redundant(df), dedupe_key(df), order)


def accumulate(old: DataFrame, new: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Earlier runs plus this one, one row per key, earlier runs winning."""
    both = union_by_name(old.withColumn("_run", F.lit(0)), new.withColumn("_run", F.lit(1)))
    return keep_first(both, dedupe_key(both), ["_run", *order]).drop("_run")


def increment(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` whose key earlier runs do not have; null matches null.

    The append-only way to accumulate: only the keys of the old table move.
    """
    return not_seen(new, old, key)
