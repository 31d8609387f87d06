"""Incremental news: deduplication, sliding alerts, undated rows and late ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from regionpulse.functions.levels import news_level
from regionpulse.functions.urls import domain
from regionpulse.sources.readers import read_or_empty


def dedupe_stream(hits: DataFrame, key: str = "url", event_time: str | None = None, delay: str = "7 days") -> DataFrame:
    """Each key once over the whole stream.

    With an event-time column the state is bounded: keys older than ``delay``
    are forgotten.
    """
    if event_time is None:
        return hits.dropDuplicates([key])
    return hits.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def split_undated(hits: DataFrame, column: str = "fecha_dt") -> tuple[DataFrame, DataFrame]:
    """Dated rows, and the rows without a date that stay out of the alerts."""
    return hits.where(F.col(column).isNotNull()), hits.where(F.col(column).isNull())


def sliding_alerts(
    events: DataFrame,
    hours: int = 72,
    slide_hours: int = 12,
    delay: str = "1 day",
    time: str = "fecha_dt",
) -> DataFrame:
    """Alert counts per sliding window, state, event type and source.

    ``events`` are exploded reports (one row per event type).  State is kept
    per source, not as a set of sources, so it stays small and spreads over the
    tasks; :func:`alerts_from_sources` turns the result into levels.
    """
    moment = F.col(time).cast("timestamp")
    stamped = events.withColumn("_t", moment).withColumn("dominio", domain(F.col("url")))
    return (
        stamped.withWatermark("_t", delay)
        .groupBy(
            F.window("_t", f"{hours} hours", f"{slide_hours} hours").alias("ventana"),
            "estado",
            "tipo_evento",
            "dominio",
        )
        .agg(
            F.count("*").alias("n"),
            F.bool_or("victimas").alias("victimas"),
            F.bool_or("rescate").alias("rescate"),
            F.bool_or("danios").alias("danios"),
        )
    )


def start_alert_stream(per_source: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the counts of :func:`sliding_alerts` as a table of changes.

    Every batch writes only the windows it has changed, in a partition of its
    own, and windows behind the watermark leave the state.  A repeated batch
    overwrites its partition.  :func:`latest_counts` reads the table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/lote={batch_id}")

    return (
        per_source.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_counts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The last change of every window, group and source of an alert stream's table."""
    changes = read_or_empty(spark, path, T.StructType([*schema.fields, T.StructField("lote", T.LongType())]))
    keys = ["ventana", "estado", "tipo_evento", "dominio"]
    last = changes.groupBy(*keys).agg(F.max_by(F.struct("n", "victimas", "rescate", "danios"), "lote").alias("_ultimo"))
    return last.select(*keys, "_ultimo.*")


def alerts_from_sources(per_source: DataFrame) -> DataFrame:
    """Levels per window, state and event type from per-source counts."""
    known = F.col("dominio").isNotNull()
    return (
        per_source.groupBy("ventana", "estado", "tipo_evento")
        .agg(
            F.sum("n").alias("n_noticias"),
            F.count("dominio").alias("n_fuentes_distintas"),
            F.count_if(known & F.col("victimas")).alias("_fv"),
            F.bool_or("victimas").alias("tiene_victimas"),
            F.bool_or("rescate").alias("tiene_rescate_activo"),
            F.bool_or("danios").alias("tiene_danios_estructurales"),
        )
        .select(
            F.col("ventana.start").alias("desde"),
            F.col("ventana.end").alias("hasta"),
            "estado",
            "tipo_evento",
            "n_noticias",
            "n_fuentes_distintas",
            "tiene_victimas",
            "tiene_rescate_activo",
            "tiene_danios_estructurales",
            news_level(
                F.col("tiene_victimas"), F.col("_fv"), F.col("tiene_rescate_activo"),
                F.col("tiene_danios_estructurales"), F.col("n_noticias"),
            ).alias("nivel_alerta"),
        )
    )


def alerts_and_late_rows(
    events: DataFrame, hours: int = 72, slide_hours: int = 12, delay: str = "1 day", time: str = "fecha_dt"
) -> DataFrame:
    """Reports with the windows they are in and the watermark they leave behind (``marca``, in microseconds).

    ``fin`` is the end of the last window of a report, ``paso`` lies between windows, ``ventanas`` counts them.

    A window ends when the watermark, the latest moment of earlier batches less ``delay``, reaches its end.
    :func:`start_late_stream` holds every batch against it: a report that comes after the end of one of its windows is
    kept as a row of its own, with the number of windows it has missed; it counts in those that are open, as in
    :func:`sliding_alerts`.  Moments are those of a session in UTC.
    """
    span, step = F.lit(hours * 3_600_000_000), F.lit(slide_hours * 3_600_000_000)
    now, wait = F.unix_micros("momento"), F.expr(f"INTERVAL '{delay}'")
    signs = [F.coalesce(c, F.lit(False)).alias(c) for c in ("victimas", "rescate", "danios")]
    stamped = events.select("estado", "tipo_evento", domain(F.col("url")).alias("dominio"), "url", F.col(time).cast("timestamp").alias("momento"), *signs)
    placed = stamped.select("*", (now - F.pmod(now, step) + span).alias("fin"), span.alias("largo"), step.alias("paso"))
    return placed.select("*", _steps(F.col("fin") - now).alias("ventanas"), F.unix_micros(F.col("momento") - wait).alias("marca"))


def _steps(time: Column) -> Column:
    """Steps that a time takes, counted up; none if it is not positive."""
    return F.when(time > 0, F.ceil(time / F.col("paso"))).otherwise(F.when(time <= 0, F.lit(0).cast("long")))


_KEYS = ["ventana", "estado", "tipo_evento", "dominio"]
_SIGNS = ["victimas", "rescate", "danios"]


def _table(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_GROUP = [(name, T.StringType()) for name in _KEYS[1:]]
_FLAGS = [(name, T.BooleanType()) for name in _SIGNS]
_WINDOW = _table(("start", T.TimestampType()), ("end", T.TimestampType()))
_COUNTS = _table(("ventana", _WINDOW), *_GROUP, ("n", T.LongType()), *_FLAGS)
_LATE = _table(*_GROUP, ("url", T.StringType()), ("momento", T.TimestampType()), *_FLAGS, ("ventanas_perdidas", T.IntegerType()))
_MARKS = _table(("marca", T.LongType()), ("lote", T.LongType()))


def start_late_stream(steps: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the late reports, the counts that a batch adds and the watermark it leaves, each as a table under ``path``.

    Every batch has a partition of its own in each, so that a repeated one overwrites what it has written, and is held
    against the marks of the batches before it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = read_or_empty(spark, f"{path}/marcas", _MARKS).where(F.col("lote") < batch_id)
        mark = max(earlier.agg(F.max("marca")).first()[0] or 0, 0)
        placed = batch.withColumn("abiertas", F.least("ventanas", _steps(F.col("fin") - F.lit(mark))))
        late = placed.where("ventanas > abiertas").withColumn("ventanas_perdidas", (F.col("ventanas") - F.col("abiertas")).cast("int"))
        late.select(*_LATE.names).write.mode("overwrite").parquet(f"{path}/tarde/lote={batch_id}")
        ends = F.sequence(F.col("fin") - (F.col("abiertas") - 1) * F.col("paso"), "fin", "paso")
        still_open = placed.where("abiertas > 0").withColumn("hasta", F.explode(ends))
        # Windows are numbers until they are counted.
        grouped = still_open.groupBy("hasta", "largo", *_KEYS[1:]).agg(F.count("*").alias("n"), *[F.bool_or(c).alias(c) for c in _SIGNS])
        window = F.struct(F.timestamp_micros(F.col("hasta") - F.col("largo")).alias("start"), F.timestamp_micros("hasta").alias("end"))
        counts = grouped.select(window.alias("ventana"), *_KEYS[1:], "n", *_SIGNS)
        counts.write.mode("overwrite").parquet(f"{path}/cuenta/lote={batch_id}")
        batch.agg(F.max("marca").alias("marca")).write.mode("overwrite").parquet(f"{path}/marcas/lote={batch_id}")

    return (
        steps.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Reports that came after the end of some of their windows, and how many."""
    return read_or_empty(spark, f"{path}/tarde", _LATE).select(*_LATE.names)


def counts_on_time(spark: SparkSession, path: str) -> DataFrame:
    """The counts of everything that was on time, for :func:`alerts_from_sources`."""
    return read_or_empty(spark, f"{path}/cuenta", _COUNTS).groupBy(*_KEYS).agg(F.sum("n").alias("n"), *[F.bool_or(c).alias(c) for c in _SIGNS])
