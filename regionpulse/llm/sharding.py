"""Shards that all hold the same mixture of sources: proportional stratified interleaving.

The rows of every source are put in a seeded random order and numbered; row ``r`` of a source with ``n`` rows has
the fractional rank ``(r - 1/2) / n``.  Sorted by fractional rank, every stretch of the whole holds each source in its
share, so cutting the order into equal stretches gives shards that match the mixture and differ by one row at most.

Both numberings are made in buckets of about ``rows_per_bucket`` rows: counts per bucket give each bucket its first
number, and rows are numbered inside their bucket.  A source with a third of all rows is as many buckets as its size
asks for, and no task gets a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regionpulse.llm.common import table, text_of
from regionpulse.session import stage

SHARDS = 40
SEED = 20_240
ROWS_PER_BUCKET = 20_000


def _numbered(rows: DataFrame, keys: list[str], bucket: str, order: list[str], into: str) -> DataFrame:
    """Column ``into``: the number of each row from 1 by (bucket, order) within ``keys``."""
    counts = rows.groupBy(*keys, bucket).agg(F.count("*").alias("_in_bucket"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, bucket, F.coalesce(F.sum("_in_bucket").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(*keys, bucket).orderBy(*order)
    numbered = rows.withColumn("_within", F.row_number().over(within))
    return numbered.join(starts, [*keys, bucket]).withColumn(into, F.col("_start") + F.col("_within")).drop("_start", "_within")


def interleave(
    df: DataFrame,
    stratum: str | Column,
    identity: list[str],
    n_shards: int = SHARDS,
    seed: int = SEED,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``df`` with ``shard`` (from 0) and ``slot`` (from 0 without gaps in each shard).

    ``identity`` names the columns that make the seeded order; rows that agree in all of them are interchangeable.
    A null stratum is a stratum of its own; null identities are ordinary values; an empty input gives no rows.  Any
    column names are allowed except ``shard`` and ``slot``, which are replaced.
    """
    stratum = F.col(stratum) if isinstance(stratum, str) else stratum
    kept = [c for c in df.columns if c not in ("shard", "slot")]
    rows = stage(
        df.select(
            F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"),
            F.when(stratum.isNull(), "-").otherwise(F.concat(F.lit("+"), stratum.cast("string"))).alias("_stratum"),
            F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in identity]).alias("_hash"),
        )
    )
    total = rows.count()
    buckets = max(1, -(-total // rows_per_bucket))
    tie = [f"_row.`{c}`" for c in identity]
    ranked = _numbered(
        rows.withColumn("_bucket", F.pmod("_hash", F.lit(buckets))), ["_stratum"], "_bucket", ["_hash", *tie], "_rank"
    )
    sizes = rows.groupBy("_stratum").agg(F.count("*").alias("_size"))
    shares = stage(
        ranked.drop("_bucket")
        .join(sizes, "_stratum")
        .withColumn("_share", (2 * F.col("_rank") - 1) / (2 * F.col("_size")).cast("double"))
        .withColumn("_bucket", F.least(F.floor(F.col("_share") * buckets), F.lit(buckets - 1)))
    )
    placed = _numbered(
        shares.withColumn("_all", F.lit(0)), ["_all"], "_bucket", ["_share", "_stratum", "_rank"], "_place"
    )
    place = F.col("_place") - 1
    return placed.select(
        *[F.col(f"_row.`{c}`").alias(c) for c in kept],
        F.expr(f"int(((_place - 1) * {n_shards}) div {max(total, 1)})").alias("shard"),
        place.alias("_position"),
    ).select(
        *[F.col(f"`{c}`") for c in kept],
        "shard",
        F.expr(f"_position - (shard * {total}L + {n_shards - 1}) div {n_shards}").alias("slot"),
    )


def write_shards(df: DataFrame, path: str) -> None:
    """One folder of Parquet files per shard, each sorted by slot."""
    df.repartition("shard").sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    """The shard of every document; only its id, size and checksum travel, not the text."""
    text = text_of().cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    return interleave(docs, "source", ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source",
    )
