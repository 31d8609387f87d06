"""Streaming forms run over everything available, read back as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionpulse.operators.alerts import explode_events
from regionpulse.operators.selection import with_alert_key
from regionpulse.session import scratch_path
from regionpulse.streaming import ledger as SL
from regionpulse.streaming import news as SN
from workload import standins
from workload.standins import NEWS_SQL, table


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table as a file stream; a pattern also matches a single file."""
    return spark.readStream.schema(table(spark, sf, name).schema).parquet(f"{sf}/{name}.parque[t]")


def _news(spark: SparkSession, sf: str) -> DataFrame:
    return standins.news(spark, sf, read=_stream)


def stream_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    hits = SN.dedupe_stream(_news(spark, sf).select("url"), "url")
    path, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "checkpoint")
    SL.start_append_stream(hits, path, checkpoint).awaitTermination()
    return spark.read.schema("url string").parquet(path)


def stream_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Sliding 72-hour windows every 12 hours over the whole table."""
    dated, _ = SN.split_undated(explode_events(_news(spark, sf)))
    path = scratch_path(spark, "stream")
    per_source = SN.sliding_alerts(dated, delay="40 days")
    SN.start_alert_stream(per_source, path, scratch_path(spark, "checkpoint")).awaitTermination()
    return _alerts(SN.latest_counts(spark, path, per_source.schema))


def stream_late(spark: SparkSession, sf: str) -> DataFrame:
    """Recent reports first, then older ones: windows behind the watermark take no more of them.

    Rows are held against the watermark that the batch before the last one has left.
    """
    folder, path = scratch_path(spark, "landed"), scratch_path(spark, "stream")
    events = explode_events(standins.news(spark, sf)).where("fecha_dt IS NOT NULL")
    landed = _landed_by_period(spark, events, folder)
    per_source = SN.sliding_alerts(landed, delay="1 day")
    SN.start_alert_stream(per_source, path, scratch_path(spark, "checkpoint")).awaitTermination()
    return _alerts(SN.latest_counts(spark, path, per_source.schema))


# Periods in the order of their landing, and the files of each, which are one batch.
PERIODS = ("fecha_dt >= DATE '2024-01-25'", "fecha_dt >= DATE '2024-01-20' AND fecha_dt < DATE '2024-01-25'", "fecha_dt < DATE '2024-01-20'")
FILES = 4


def _landed_by_period(spark: SparkSession, events: DataFrame, folder: str) -> DataFrame:
    """A stream of the periods, each landed by many tasks."""
    for days in PERIODS:
        events.where(days).repartition(FILES).write.mode("append").parquet(folder)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", FILES).parquet(folder)


def _late(spark: SparkSession, sf: str) -> str:
    folder, path = scratch_path(spark, "landed"), scratch_path(spark, "stream")
    landed = _landed_by_period(spark, explode_events(standins.news(spark, sf)).where("fecha_dt IS NOT NULL"), folder)
    SN.start_late_stream(SN.alerts_and_late_rows(landed), path, scratch_path(spark, "checkpoint")).awaitTermination()
    return path


def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Reports that came after the end of a window, with the number of windows they have missed."""
    rows = SN.late_rows(spark, _late(spark, sf))
    return rows.groupBy("estado", "tipo_evento", "url", F.date_format("momento", "yyyy-MM-dd").alias("dia"), "ventanas_perdidas").agg(F.count("*").alias("n"))


def stream_on_time(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts of everything that was on time, by the same stream."""
    return _alerts(SN.counts_on_time(spark, _late(spark, sf)))


def _alerts(per_source: DataFrame) -> DataFrame:
    return SN.alerts_from_sources(per_source).select(
        F.date_format("desde", "yyyy-MM-dd HH:mm").alias("desde"), "estado", "tipo_evento", "n_noticias",
        "n_fuentes_distintas", "tiene_victimas", "tiene_rescate_activo", "tiene_danios_estructurales", "nivel_alerta",
    )


def stream_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Alert keys of each report recorded once, over a run that is repeated."""
    reports = explode_events(_news(spark, sf)).where("fecha_dt IS NOT NULL").withColumns(
        {"fecha_calculo": F.col("fecha_dt"), "nivel_alerta": F.when(F.col("victimas"), "Rojo").otherwise("Verde")}
    )
    keys = with_alert_key(reports).select("clave")
    path, checkpoint = scratch_path(spark, "ledger"), scratch_path(spark, "checkpoint")
    for _ in range(2):
        SL.start_ledger_stream(keys, "clave", path, checkpoint, ["clave"]).awaitTermination()
    return spark.read.schema("clave string, batch_id string").parquet(path).select("clave")


def stream_ledger_restart(spark: SparkSession, sf: str) -> DataFrame:
    """URLs recorded by a stream over some reports and by one with a new checkpoint over all of them."""
    path = scratch_path(spark, "ledger")
    hits = _news(spark, sf).select("url", "criterio_busqueda")
    for rows in (hits.where("criterio_busqueda = 'signup'"), hits):
        checkpoint = scratch_path(spark, "checkpoint")
        SL.start_ledger_stream(rows.select("url"), "url", path, checkpoint, ["url"]).awaitTermination()
    return spark.read.schema("url string, batch_id string").parquet(path).select("url")


def stream_timeline(spark: SparkSession, sf: str) -> DataFrame:
    """Order snapshots appended to a timeline by a stream that is started twice."""
    path, checkpoint = scratch_path(spark, "timeline"), scratch_path(spark, "checkpoint")
    orders = _stream(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("fecha_calculo"))
    for _ in range(2):
        SL.start_timeline_stream(orders, path, checkpoint).awaitTermination()
    rows = spark.read.schema("o_orderkey long, fecha_calculo timestamp, fecha_calculo_dia date").parquet(path)
    return rows.select("o_orderkey", F.date_format("fecha_calculo_dia", "yyyy-MM-dd").alias("dia"))


QUERIES = {
    f.__name__: f for f in (stream_dedupe, stream_alerts, stream_late, stream_late_rows, stream_on_time, stream_ledger, stream_ledger_restart, stream_timeline)
}

_SLID = """
        SELECT strftime(desde, '%Y-%m-%d %H:%M') AS desde, estado, tipo_evento, count(*) AS n_noticias,
               count(DISTINCT dominio) AS n_fuentes_distintas, bool_or(v) AS tiene_victimas, bool_or(r) AS tiene_rescate_activo,
               bool_or(d) AS tiene_danios_estructurales,
               CASE WHEN bool_or(v) AND count(DISTINCT dominio) FILTER (WHERE v) >= 2 THEN 'Rojo'
                    WHEN bool_or(r) OR bool_or(d) THEN 'Naranja' WHEN count(*) >= 2 THEN 'Amarillo' ELSE 'Verde' END AS nivel_alerta
        FROM slid GROUP BY desde, estado, tipo_evento"""

# The watermark of each period: a day before the latest moment of the periods before it.
_MARKS = f"""
  placed AS (SELECT *, CASE WHEN {PERIODS[0]} THEN 0 WHEN {PERIODS[1]} THEN 1 ELSE 2 END AS p FROM exploded WHERE fecha_dt IS NOT NULL),
  marks AS (SELECT p, coalesce((SELECT max(fecha_dt) FROM placed o WHERE o.p < q.p) - INTERVAL 1 DAY, TIMESTAMP '1970-01-01') AS mark
            FROM (SELECT DISTINCT p FROM placed) q),
  pairs AS (SELECT e.*, mark, CAST(fecha_dt AS TIMESTAMP) - to_hours(CAST(12 * i AS INTEGER)) AS desde FROM placed e JOIN marks USING (p), range(0, 6) t(i))"""

ORACLES = {
    "stream_late_rows": f"""WITH {NEWS_SQL}, {_MARKS},
        late AS (SELECT event_id, estado, tipo_evento, url, strftime(fecha_dt, '%Y-%m-%d') AS dia, count(*) AS ventanas_perdidas FROM pairs
          WHERE desde + INTERVAL 72 HOUR <= mark GROUP BY ALL)
        SELECT estado, tipo_evento, url, dia, ventanas_perdidas::INT AS ventanas_perdidas, count(*) AS n FROM late GROUP BY ALL""",
    "stream_on_time": f"""WITH {NEWS_SQL}, {_MARKS}, slid AS (SELECT * FROM pairs WHERE desde + INTERVAL 72 HOUR > mark) {_SLID}""",
    "stream_late": f"""WITH {NEWS_SQL},
        slid AS (
          SELECT e.*, CAST(fecha_dt AS TIMESTAMP) - to_hours(CAST(12 * i AS INTEGER)) AS desde FROM exploded e, range(0, 6) t(i)
          WHERE fecha_dt IS NOT NULL AND (fecha_dt >= DATE '2024-01-20' OR CAST(fecha_dt AS TIMESTAMP) + to_hours(CAST(72 - 12 * i AS INTEGER))
            > (SELECT max(fecha_dt) FROM exploded WHERE fecha_dt >= DATE '2024-01-20') - INTERVAL 1 DAY)) {_SLID}""",
    "stream_ledger_restart": f"WITH {NEWS_SQL} SELECT DISTINCT url FROM news WHERE url IS NOT NULL",
    "stream_timeline": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS dia FROM orders",
    "stream_dedupe": f"WITH {NEWS_SQL} SELECT DISTINCT url FROM news",
    "stream_alerts": f"""WITH {NEWS_SQL},
        slid AS (
          SELECT e.*, CAST(fecha_dt AS TIMESTAMP) - to_hours(CAST(12 * i AS INTEGER)) AS desde FROM exploded e, range(0, 6) t(i)
          WHERE fecha_dt IS NOT NULL)
        SELECT strftime(desde, '%Y-%m-%d %H:%M') AS desde, estado, tipo_evento, count(*) AS n_noticias,
               count(DISTINCT dominio) AS n_fuentes_distintas, bool_or(v) AS tiene_victimas, bool_or(r) AS tiene_rescate_activo,
               bool_or(d) AS tiene_danios_estructurales,
               CASE WHEN bool_or(v) AND count(DISTINCT dominio) FILTER (WHERE v) >= 2 THEN 'Rojo'
                    WHEN bool_or(r) OR bool_or(d) THEN 'Naranja' WHEN count(*) >= 2 THEN 'Amarillo' ELSE 'Verde' END AS nivel_alerta
        FROM slid GROUP BY desde, estado, tipo_evento""",
    "stream_ledger": f"""WITH {NEWS_SQL} SELECT DISTINCT concat(estado, '|', tipo_evento, '|', strftime(fecha_dt, '%Y-%m-%d'), '|',
        CASE WHEN v THEN 'Rojo' ELSE 'Verde' END) AS clave FROM exploded WHERE fecha_dt IS NOT NULL""",
}
