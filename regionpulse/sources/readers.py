"""Readers with fixed schemas for landed files."""

from __future__ import annotations

import csv
import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionpulse.functions.text import empty_strings
from regionpulse.sources.schemas import PROCESSED_NEWS, QUAKE_GEOJSON, RAIN_JSON, RAW_NEWS

log = logging.getLogger(__name__)

# Arrays are exploded as outer and nulls dropped after: a plain explode makes the
# planner repeat the expression behind the array in a filter on its size.

SOURCE_ORDER = "orden_fuente"
_TOO_MANY = "__campo_sobrante"


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet table, or an empty one when the path does not exist yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def find_parts(spark: SparkSession, folder: str, pattern: str = "*_part*.csv") -> list[str]:
    """Part files of a folder in name order; none is an error."""
    try:
        listing = (
            spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder).select("path")
        )
        paths = sorted(row.path for row in listing.collect())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        paths = []
    if not paths:
        raise FileNotFoundError(f"no part files like {pattern!r} in {folder!r}")
    return paths


def _headers(spark: SparkSession, paths: Sequence[str], encoding: str) -> dict[tuple[str, ...], list[str]]:
    """Paths by their header: the first lines of all files, found in one pass of tasks over them."""
    lines = (
        spark.read.option("encoding", encoding).option("ignoreCorruptFiles", True).text(list(paths))
        .select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), "value")
    )
    first = (
        lines.where("block = 0 AND value <> ''")
        .withColumn("place", F.monotonically_increasing_id())
        .groupBy("path").agg(F.min_by("value", "place").alias("header"))
    )
    groups: dict[tuple[str, ...], list[str]] = {}
    for header, files in first.groupBy("header").agg(F.collect_list("path")).collect():
        names = tuple(n.lstrip("\ufeff") for n in next(csv.reader([header])))
        groups.setdefault(names, []).extend(sorted(files))
    missing = {p.rsplit("/", 1)[-1] for p in paths} - {f.rsplit("/", 1)[-1] for files in groups.values() for f in files}
    for name in sorted(missing):
        log.warning("part %s skipped: no header", name)
    return groups


def read_raw_parts(
    spark: SparkSession,
    paths: Sequence[str],
    multiline: bool = True,
    encoding: str = "UTF-8",
) -> DataFrame:
    """CSV parts united by column name, with their order in :data:`SOURCE_ORDER`.

    Each part is read by its own header, so a part may lack a column.  Lines
    with too many fields are skipped, short ones padded with nulls, unreadable
    parts skipped with a warning.  ``multiline`` keeps line breaks inside
    quotes but reads each file in one task; turn it off for very large parts
    without such breaks, which are then split.
    """
    groups = _headers(spark, paths, encoding)
    if not groups:
        raise FileNotFoundError("no readable part file")

    integers = {f.name for f in RAW_NEWS if isinstance(f.dataType, T.IntegerType)}

    def clean(name: str) -> Column:
        value = F.when(~F.col(f"`{name}`").isin("", "nan"), F.col(f"`{name}`"))
        return (value.try_cast("int") if name in integers else value).alias(name)

    def read(header: tuple[str, ...], files: list[str]) -> DataFrame:
        fields = [T.StructField(n, T.StringType()) for n in (*header, _TOO_MANY)]
        lines = (
            spark.read.schema(T.StructType(fields))
            .option("header", True)
            .option("multiLine", multiline)
            .option("quote", '"')
            .option("escape", '"')
            .option("encoding", encoding)
            .option("mode", "PERMISSIVE")
            .option("ignoreCorruptFiles", True)
            .option("enforceSchema", True)
            .csv(files)
        )
        position = F.struct(
            F.col("_metadata.file_path").alias("archivo"),
            F.col("_metadata.file_block_start").alias("bloque"),
            F.monotonically_increasing_id().alias("fila"),
        )
        return (
            lines.select("*", position.alias(SOURCE_ORDER))
            .where(F.col(_TOO_MANY).isNull())
            .select(*[clean(n) for n in header], SOURCE_ORDER)
        )

    parts = [read(header, files) for header, files in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_accumulated(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Accumulated raw table of earlier runs, or an empty one."""
    return read_or_empty(spark, path, schema)


def read_processed(spark: SparkSession, path: str, schema: T.StructType = PROCESSED_NEWS) -> DataFrame:
    """Processed news table."""
    return spark.read.schema(schema).parquet(path)


def parse_list_literal(c: Column) -> Column:
    """Text like ``['a', 'b']`` -> array; null, empty, malformed or no list -> ``[]``."""
    return F.coalesce(F.from_json(c, "array<string>"), empty_strings())


def explode_rain_documents(df: DataFrame) -> DataFrame:
    """Documents with parallel day and amount arrays -> one row per day.

    A missing amount is 0.0; a document without days gives no rows.
    """
    days = F.arrays_zip(F.col("daily.time").alias("time"), F.col("daily.precipitation_sum").alias("mm"))
    return (
        df.select("estado", F.explode_outer(days).alias("d"))
        .where(F.col("d").isNotNull())
        .select(
            "estado",
            F.try_to_date(F.col("d.time"), "yyyy-MM-dd").alias("fecha"),
            F.coalesce(F.col("d.mm"), F.lit(0.0)).alias("mm"),
        )
    )


def read_rain_json(spark: SparkSession, path: str) -> DataFrame:
    """Landed weather documents -> daily rain rows."""
    return explode_rain_documents(spark.read.schema(RAIN_JSON).json(path))


def explode_quake_documents(df: DataFrame) -> DataFrame:
    """Feature collections -> one row per earthquake."""
    f = F.col("f")
    return df.select(F.explode_outer("features").alias("f")).where(f.isNotNull()).select(
        f["id"].alias("id_evento"),
        F.timestamp_millis(f["properties"]["time"]).alias("fecha_evento"),
        f["properties"]["mag"].alias("magnitud"),
        F.get(f["geometry"]["coordinates"], F.lit(2)).alias("profundidad_km"),
        F.coalesce(f["properties"]["place"], F.lit("")).alias("lugar"),
        F.get(f["geometry"]["coordinates"], F.lit(1)).alias("lat"),
        F.get(f["geometry"]["coordinates"], F.lit(0)).alias("lon"),
        F.coalesce(f["properties"]["url"], F.lit("")).alias("url_detalle"),
    )


def read_quake_geojson(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Landed features or feature collections, one JSON document per line -> earthquake rows.

    Files of lines are split over tasks.  ``multiline`` reads documents that span lines, each file in one task.  A line
    or file that does not parse fails the read, so that documents of the other layout are not lost.
    """
    either = T.StructType([*QUAKE_GEOJSON.fields, *QUAKE_GEOJSON["features"].dataType.elementType.fields])
    fields = T.StructType([*either.fields, T.StructField("_corrupt", T.StringType())])
    rows = spark.read.schema(fields).option("multiLine", multiline).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    lost = F.col("_corrupt").isNotNull() & F.col("features").isNull() & F.col("properties").isNull()
    message = F.lit("GeoJSON that does not parse; documents that span lines need multiline=True")
    rows = rows.where(F.when(lost, F.raise_error(message).cast("boolean")).otherwise(True))
    alone = F.array(F.struct(*[F.col(f.name) for f in QUAKE_GEOJSON["features"].dataType.elementType.fields]))
    return explode_quake_documents(rows.select(F.coalesce("features", F.when(F.col("properties").isNotNull(), alone)).alias("features")))
