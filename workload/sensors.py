"""Rain over orders and earthquakes over events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regionpulse.operators import contracts as K
from regionpulse.operators import quakes as Z
from regionpulse.operators import quality as Q
from regionpulse.operators import rain as N
from regionpulse.plans.quakes import run_quakes
from regionpulse.plans.rain import run_rain
from regionpulse.session import scratch_path
from regionpulse.sources import readers
from regionpulse.sources.schemas import QUAKE_GEOJSON, RAIN_JSON
from workload.standins import (
    NEAREST_SQL,
    QUAKES_SQL,
    RAIN_END,
    RAIN_SQL,
    RAIN_START,
    RAIN_YEARS,
    STATES_SQL,
    day_text,
    quakes,
    rain_daily,
    states,
    table,
    thresholds,
)

CALCULATED = datetime(2024, 2, 1, 6, 30, 15, 250000)
FLOOR_MM = 100.0


def _risk(spark: SparkSession, sf: str) -> DataFrame:
    return N.rain_risk(rain_daily(spark, sf), states(spark, sf), RAIN_START, RAIN_END, RAIN_YEARS, FLOOR_MM)


def rain_windows(spark: SparkSession, sf: str) -> DataFrame:
    return N.rain_windows(rain_daily(spark, sf), RAIN_START, RAIN_END, RAIN_YEARS)


def rain_windows_overlapping(spark: SparkSession, sf: str) -> DataFrame:
    """Windows longer than a year, so one day belongs to several."""
    start = RAIN_START.replace(year=RAIN_START.year - 1)
    return N.rain_windows(rain_daily(spark, sf), start, RAIN_END, 3)


def rain_risk(spark: SparkSession, sf: str) -> DataFrame:
    return N.sort_rain(_risk(spark, sf))


def rain_ranked(spark: SparkSession, sf: str) -> DataFrame:
    return N.rank_rain(_risk(spark, sf)).select("orden", "estado")


def conform_rain(spark: SparkSession, sf: str) -> DataFrame:
    rows = K.conform_output(publish_rain(spark, sf), "rain")
    return rows.withColumn("fecha_calculo", F.date_format("fecha_calculo", "yyyy-MM-dd HH:mm:ss"))


def rain_at_risk(spark: SparkSession, sf: str) -> DataFrame:
    return N.at_risk(_risk(spark, sf)).select("estado", "alerta", "prioridad")


def rain_levels(spark: SparkSession, sf: str) -> DataFrame:
    return N.level_totals(_risk(spark, sf))


def rain_cumulative(spark: SparkSession, sf: str) -> DataFrame:
    return N.cumulative_rain(rain_daily(spark, sf), RAIN_START, RAIN_END).withColumn("fecha", day_text("fecha"))


def publish_rain(spark: SparkSession, sf: str) -> DataFrame:
    return K.prepare_rain(
        run_rain(rain_daily(spark, sf), states(spark, sf), RAIN_END, CALCULATED, 30, RAIN_YEARS, FLOOR_MM)
    )


def rain_timeline(spark: SparkSession, sf: str) -> DataFrame:
    """Two snapshots appended to a timeline."""
    path = scratch_path(spark, "timeline")
    for day in (RAIN_START, RAIN_END):
        run_rain(
            rain_daily(spark, sf), states(spark, sf), day, datetime(day.year, day.month, day.day, 9),
            30, RAIN_YEARS, FLOOR_MM, timeline=path,
        )
    rows = spark.read.parquet(path)
    return rows.groupBy(F.date_format("fecha_calculo_dia", "yyyy-MM-dd").alias("dia")).agg(
        F.count("*").alias("n"), F.sum("precipitacion_30dias").alias("mm")
    )


def rain_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as weather documents with two days each, as text."""
    doc = F.to_json(
        F.struct(
            F.concat(F.lit("e"), F.col("o_orderkey").cast("string")).alias("estado"),
            F.struct(
                F.array(F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format(F.date_add("o_orderdate", 1), "yyyy-MM-dd")).alias("time"),
                F.array(F.col("o_totalprice"), F.lit(None).cast("double")).alias("precipitation_sum"),
            ).alias("daily"),
        )
    )
    return table(spark, sf, "orders").select(doc.alias("doc"))


def rain_json(spark: SparkSession, sf: str) -> DataFrame:
    """Weather documents parsed and exploded."""
    docs = rain_documents(spark, sf).select(F.from_json("doc", RAIN_JSON).alias("d")).select("d.*")
    return readers.explode_rain_documents(docs).withColumn("fecha", day_text("fecha"))


def quake_bbox(spark: SparkSession, sf: str) -> DataFrame:
    kept = Z.filter_quakes(quakes(spark, sf), 4.5, datetime(2024, 1, 5), datetime(2024, 1, 25))
    return kept.select("id_evento")


def quake_newest(spark: SparkSession, sf: str) -> DataFrame:
    return Z.sort_quakes(quakes(spark, sf)).select("id_evento", "magnitud")


def quake_ranked(spark: SparkSession, sf: str) -> DataFrame:
    return Z.rank_quakes(quakes(spark, sf)).select("orden", "id_evento")


def conform_quakes(spark: SparkSession, sf: str) -> DataFrame:
    rows = K.conform_output(publish_quakes(spark, sf), "quakes")
    return rows.withColumn("fecha_calculo", F.date_format("fecha_calculo", "yyyy-MM-dd HH:mm:ss"))


def _assigned(spark: SparkSession, sf: str) -> DataFrame:
    return Z.assign_nearest_state(quakes(spark, sf), states(spark, sf), 150.0)


def quake_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return _assigned(spark, sf).select("id_evento", "estado")


def quake_nearest_sliced(spark: SparkSession, sf: str) -> DataFrame:
    """The same with the capitals taken in slices."""
    found = Z.assign_nearest_state(quakes(spark, sf), states(spark, sf), 150.0, slice_size=7)
    return found.select("id_evento", "estado")


def quake_metrics(spark: SparkSession, sf: str) -> DataFrame:
    rows = Z.quake_metrics(_assigned(spark, sf), states(spark, sf), thresholds(spark, sf), 30, CALCULATED)
    return rows.drop("fecha_calculo")


def publish_quakes(spark: SparkSession, sf: str) -> DataFrame:
    now = datetime(2024, 1, 31)
    _, metrics = run_quakes(quakes(spark, sf), states(spark, sf), thresholds(spark, sf), now, CALCULATED)
    return K.prepare_quakes(metrics)


def quake_counters(spark: SparkSession, sf: str) -> DataFrame:
    return Q.count_quakes(_assigned(spark, sf))


def _feature(suffix: str, place: Column) -> Column:
    """An event as an earthquake's feature."""
    i = F.col("event_id")
    return F.struct(
        F.concat(i.cast("string"), F.lit(suffix)).alias("id"),
        F.struct((i * 1000).alias("time"), F.col("value").alias("mag"), place.alias("place"), F.lit(None).cast("string").alias("url")).alias("properties"),
        F.struct(F.array((i % 90) / 2.0, (i % 45) / 4.0, F.col("value")).alias("coordinates")).alias("geometry"),
    )


def features(spark: SparkSession, sf: str) -> DataFrame:
    """``event_id`` and ``feature`` of every event."""
    return table(spark, sf, "events").select("event_id", _feature("a", F.col("event_type")).alias("feature"))


def geo_json(spark: SparkSession, sf: str) -> DataFrame:
    """Events as feature collections of two features, parsed and exploded."""
    doc = F.to_json(F.struct(F.array(_feature("a", F.col("event_type")), _feature("b", F.lit(None).cast("string"))).alias("features")))
    docs = table(spark, sf, "events").select(F.from_json(doc, QUAKE_GEOJSON).alias("d")).select("d.*")
    return readers.explode_quake_documents(docs).withColumn(
        "fecha_evento", F.date_format("fecha_evento", "yyyy-MM-dd HH:mm:ss")
    )


QUERIES = {
    f.__name__: f
    for f in (
        rain_windows, rain_windows_overlapping, rain_risk, rain_ranked, quake_ranked, conform_rain, conform_quakes,
        rain_at_risk, rain_levels, rain_cumulative, publish_rain,
        rain_timeline, rain_json, quake_bbox, quake_newest, quake_nearest, quake_nearest_sliced, quake_metrics,
        publish_quakes, quake_counters, geo_json,
    )
}


def _r2(x: str) -> str:
    """Two decimals nearest to the exact binary value."""
    return f"CAST(printf('%.2f', {x}) AS DOUBLE)"


def _scaled(x: str) -> str:
    """Two decimals by scaling and rounding to even."""
    return f"round_even({x} * 100, 0) / 100"


def _windows(start: str, end: str, years: int) -> str:
    return f"""
windows AS (
  SELECT CAST(k AS INTEGER) AS k, CAST(DATE '{start}' - to_years(CAST(k AS INTEGER)) AS DATE) AS ini,
         CAST(DATE '{end}' - to_years(CAST(k AS INTEGER)) AS DATE) AS fin FROM range(0, {years + 1}) t(k)
),
totals AS (
  SELECT d.estado, w.k, sum(d.mm) AS total FROM daily d JOIN windows w ON d.fecha BETWEEN w.ini AND w.fin GROUP BY d.estado, w.k
)
"""


def _risk_sql(start: str, end: str) -> str:
    return f"""
WITH {RAIN_SQL}, {STATES_SQL}, {_windows(start, end, RAIN_YEARS)},
base AS (
  SELECT estado, coalesce(max(total) FILTER (WHERE k = 0), 0.0) AS acumulado,
         {_r2('median(total) FILTER (WHERE k > 0)')} AS normal, count(*) FILTER (WHERE k > 0) AS anios
  FROM totals GROUP BY estado
),
ratio AS (
  SELECT s.estado, s.capital, b.*, greatest(normal, {FLOOR_MM}::DOUBLE) AS eff,
         {_r2(f'acumulado / greatest(normal, {FLOOR_MM}::DOUBLE)')} AS r
  FROM states s JOIN base b ON s.estado = b.estado WHERE anios > 0
),
risk AS (
  SELECT estado, capital, {_r2('acumulado')} AS acumulado, normal AS normal_historico, anios AS anios_historicos_usados,
         CASE WHEN r >= 2.2 THEN 'ROJO' WHEN r >= 1.7 THEN 'NARANJA' WHEN r >= 1.25 THEN 'AMARILLO' ELSE 'VERDE' END AS alerta,
         CASE WHEN r >= 2.2 THEN 4 WHEN r >= 1.7 THEN 3 WHEN r >= 1.25 THEN 2 ELSE 1 END AS prioridad,
         {_r2('r * 100')} AS saturacion, {_r2('eff * 1.25')} AS umbral_amarillo, {_r2('eff * 1.7')} AS umbral_naranja,
         {_r2('eff * 2.2')} AS umbral_rojo
  FROM ratio
)
"""


_RISK = _risk_sql("2001-06-15", "2001-07-15")

_METRICS = f"""
stats AS (
  SELECT estado, count(*) AS n, max(magnitud) AS maxima, avg(magnitud) AS media, avg(profundidad_km) AS prof
  FROM assigned WHERE estado IS NOT NULL GROUP BY estado
),
limits AS (
  SELECT n_name AS estado, CASE WHEN n_regionkey = 1 THEN 6.0 ELSE 6.25 END AS a,
         CASE WHEN n_regionkey = 1 THEN 6.5 ELSE 6.6 END AS b, CASE WHEN n_regionkey = 1 THEN 6.75 ELSE 6.8 END AS c FROM nation
),
metrics AS (
  SELECT lower(s.estado) AS estado, CAST(30 AS INTEGER) AS ventana_dias, CAST(coalesce(n, 0) AS INTEGER) AS n_sismos,
         coalesce({_scaled('maxima')}, 0.0) AS magnitud_maxima, coalesce({_scaled('media')}, 0.0) AS magnitud_promedio,
         coalesce({_scaled('prof')}, 0.0) AS profundidad_promedio_km,
         CASE WHEN maxima >= c THEN 'rojo' WHEN maxima >= b THEN 'naranja' WHEN maxima >= a THEN 'amarillo' ELSE 'verde' END AS nivel_alerta
  FROM states s LEFT JOIN stats t ON s.estado = t.estado JOIN limits l ON s.estado = l.estado
)
"""

_QUAKE_BASE = f"WITH {QUAKES_SQL}, {STATES_SQL}, {NEAREST_SQL}"

ORACLES = {
    "rain_windows": f"WITH {RAIN_SQL}, {_windows('2001-06-15', '2001-07-15', RAIN_YEARS)} SELECT estado, k, total FROM totals",
    "rain_windows_overlapping": f"WITH {RAIN_SQL}, {_windows('2000-06-15', '2001-07-15', 3)} SELECT estado, k, total FROM totals",
    "rain_risk": f"{_RISK} SELECT * FROM risk",
    "rain_ranked": f"{_RISK} SELECT row_number() OVER (ORDER BY prioridad DESC, saturacion DESC, estado) - 1 AS orden, estado FROM risk",
    "quake_ranked": f"WITH {QUAKES_SQL} SELECT row_number() OVER (ORDER BY fecha_evento DESC, id_evento) - 1 AS orden, id_evento FROM quakes",
    "rain_at_risk": f"{_RISK} SELECT estado, alerta, prioridad FROM risk WHERE prioridad > 1",
    "rain_levels": f"{_RISK} SELECT alerta AS nivel, count(*) AS n FROM risk GROUP BY alerta",
    "rain_cumulative": f"""WITH {RAIN_SQL},
        days AS (SELECT estado, fecha, sum(mm) AS mm FROM daily WHERE fecha BETWEEN DATE '2001-06-15' AND DATE '2001-07-15' GROUP BY ALL)
        SELECT estado, strftime(fecha, '%Y-%m-%d') AS fecha, mm, sum(mm) OVER (PARTITION BY estado ORDER BY fecha) AS acumulado_mm FROM days""",
    "publish_rain": f"""{_RISK} SELECT '2024-02-01T06:30:15.250000' AS fecha_calculo, lower(estado) AS estado, capital,
        acumulado AS precipitacion_30dias, saturacion, lower(alerta) AS nivel_alerta, umbral_amarillo, umbral_naranja, umbral_rojo FROM risk""",
    "rain_timeline": f"""SELECT * FROM ({_risk_sql('2001-05-16', '2001-06-15')} SELECT '2001-06-15' AS dia, count(*) AS n, sum(acumulado) AS mm FROM risk)
        UNION ALL SELECT * FROM ({_RISK} SELECT '2001-07-15' AS dia, count(*) AS n, sum(acumulado) AS mm FROM risk)""",
    "rain_json": """SELECT concat('e', o_orderkey) AS estado, strftime(o_orderdate, '%Y-%m-%d') AS fecha, o_totalprice AS mm FROM orders
        UNION ALL SELECT concat('e', o_orderkey), strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d'), 0.0 FROM orders""",
    "quake_bbox": f"""WITH {QUAKES_SQL} SELECT id_evento FROM quakes WHERE lat BETWEEN 0.5 AND 13.0 AND lon BETWEEN -73.5 AND -59.5
        AND magnitud >= 4.5 AND fecha_evento BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'""",
    "quake_newest": f"WITH {QUAKES_SQL} SELECT id_evento, magnitud FROM quakes",
    "quake_nearest": f"{_QUAKE_BASE} SELECT id_evento, estado FROM assigned",
    "quake_nearest_sliced": f"{_QUAKE_BASE} SELECT id_evento, estado FROM assigned",
    "quake_metrics": f"{_QUAKE_BASE}, {_METRICS} SELECT * FROM metrics",
    "publish_quakes": f"""WITH {QUAKES_SQL.replace('quakes AS', 'all_quakes AS')},
        quakes AS (SELECT * FROM all_quakes WHERE lat BETWEEN 0.5 AND 13.0 AND lon BETWEEN -73.5 AND -59.5 AND magnitud >= 2.5
                   AND fecha_evento BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31'),
        {STATES_SQL}, {NEAREST_SQL}, {_METRICS}
        SELECT '2024-02-01T06:30:15.250000' AS fecha_calculo, * FROM metrics""",
    "quake_counters": f"{_QUAKE_BASE} SELECT count(*) AS sismos, count(*) FILTER (WHERE estado IS NULL) AS fuera_de_radio FROM assigned",
    "geo_json": """SELECT concat(event_id, s) AS id_evento, strftime(make_timestamp(event_id * 1000000), '%Y-%m-%d %H:%M:%S') AS fecha_evento,
        value AS magnitud, value AS profundidad_km, CASE s WHEN 'a' THEN event_type ELSE '' END AS lugar,
        (event_id % 45) / 4.0::DOUBLE AS lat, (event_id % 90) / 2.0::DOUBLE AS lon, '' AS url_detalle
        FROM events CROSS JOIN (VALUES ('a'), ('b')) t(s)""",
}
for _name in ("rain", "quakes"):
    ORACLES[f"conform_{_name}"] = f"SELECT * REPLACE ('2024-02-01 06:30:15' AS fecha_calculo) FROM ({ORACLES[f'publish_{_name}']})"
