"""How the test tables stand in for news, rain, earthquakes and dimensions.

Each stand-in has a Spark form and a SQL form with the same definition.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


NOW = datetime(2024, 1, 20, 12, 0)
HOURS = 72
# A window that covers the whole events table.
LATEST = datetime(2024, 2, 1, 0, 0)
ALL_HOURS = 24 * 40
SITUATIONS = ["lluvias", "sismo", "huracan"]

RAIN_START, RAIN_END, RAIN_YEARS = date(2001, 6, 15), date(2001, 7, 15), 6


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def strings(*values: str) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def news(spark: SparkSession, sf: str, read: Callable[[SparkSession, str, str], DataFrame] = table) -> DataFrame:
    """Events as processed news: dated, tagged reports with a source, a state and flags."""
    e = read(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    k = F.col("k")
    site = F.when(k % 3 == 0, "https://www.s").when(k % 3 == 1, "https://s").otherwise("HTTP://WWW.S")
    kind = F.col("event_type")
    words = (
        F.when(kind == "view", strings("sismo", "replica"))
        .when(kind == "click", strings("lluvi", "aguacero", "sismo"))
        .when(kind == "purchase", strings(" sequia", "huracan"))
        .when(kind == "signup", strings(" inund", "desconocido"))
        .otherwise(strings("desconocido"))
    )

    def flag(test: Column, word: str) -> Column:
        return F.when(test, strings(word)).otherwise(strings())

    day = F.when(F.col("event_id") % 77 != 0, F.to_date("ts"))
    return e.select(
        "event_id",
        F.concat_ws(" ", F.lit("Reporte"), kind, F.col("event_id")).alias("title"),
        F.when(
            F.col("event_id") % 50 != 0,
            F.concat(site, k.cast("string"), F.lit(".example.com/n/"), F.expr("event_id div 2").cast("string")),
        ).alias("url"),
        day.alias("fecha_dt"),
        F.when(F.col("user_id") % 40 != 0, F.concat(F.lit("NATION_"), (F.col("user_id") % 25).cast("string"))).alias("estado"),
        words.alias("eventos"),
        flag(F.col("value") > 150, "victima").alias("victimas"),
        flag(F.col("value").between(120, 130), " rescat").alias("rescate"),
        flag(F.col("value").between(100, 102), "escombro").alias("daños"),
        kind.alias("criterio_busqueda"),
    )


NEWS_SQL = r"""
news AS (
  SELECT event_id,
         concat_ws(' ', 'Reporte', event_type, event_id) AS title,
         CASE WHEN event_id % 50 <> 0 THEN
           concat(CASE k % 3 WHEN 0 THEN 'https://www.s' WHEN 1 THEN 'https://s' ELSE 'HTTP://WWW.S' END,
                  k, '.example.com/n/', event_id // 2) END AS url,
         CASE WHEN event_id % 77 <> 0 THEN CAST(ts AS DATE) END AS fecha_dt,
         CASE WHEN user_id % 40 <> 0 THEN concat('NATION_', user_id % 25) END AS estado,
         event_type AS criterio_busqueda,
         value > 150 AS v, value BETWEEN 120 AND 130 AS r, value BETWEEN 100 AND 102 AS d
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
),
kinds(event_type, tipo) AS (
  VALUES ('view', 'sismo'), ('click', 'lluvias'), ('click', 'sismo'),
         ('purchase', 'huracan'), ('purchase', 'sequia'), ('signup', 'lluvias')
),
src AS (
  SELECT *, regexp_replace(regexp_extract(lower(url), '^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)', 1), '^www\.', '') AS dominio
  FROM news
),
exploded AS (
  SELECT s.*, k.tipo AS tipo_evento FROM src s JOIN kinds k ON s.criterio_busqueda = k.event_type
  WHERE s.estado IS NOT NULL
)
"""


def metrics_sql(start: str, end: str, name: str = "metrics") -> str:
    """CTE with the alert metrics of ``exploded`` between two days."""
    return f"""
{name} AS (
  SELECT estado, tipo_evento, count(*) AS n_noticias, count(DISTINCT dominio) AS n_fuentes_distintas,
         bool_or(v) AS tiene_victimas, bool_or(r) AS tiene_rescate_activo, bool_or(d) AS tiene_danios_estructurales,
         max(fecha_dt) AS fecha_mas_reciente,
         CASE WHEN bool_or(v) AND count(DISTINCT dominio) FILTER (WHERE v) >= 2 THEN 'Rojo'
              WHEN bool_or(r) OR bool_or(d) THEN 'Naranja'
              WHEN count(*) >= 2 THEN 'Amarillo' ELSE 'Verde' END AS nivel_alerta,
         coalesce(string_agg(DISTINCT url, ' | ' ORDER BY url), '') AS urls_relacionadas
  FROM exploded WHERE fecha_dt BETWEEN DATE '{start}' AND DATE '{end}'
  GROUP BY estado, tipo_evento
)
"""


WINDOW_72H = ("2024-01-18", "2024-01-20")
WINDOW_ALL = ("2023-12-23", "2024-02-01")


def states(spark: SparkSession, sf: str) -> DataFrame:
    """Nations as states with a capital and coordinates."""
    n = F.col("n_nationkey")
    return table(spark, sf, "nation").select(
        F.col("n_name").alias("estado"),
        F.concat(F.lit("Capital "), n.cast("string")).alias("capital"),
        ((n * 7) % 25 * 0.45 + 1.5).alias("lat"),
        ((n * 11) % 25 * 0.55 - 73.0).alias("lon"),
        n.alias("ord"),
    )


STATES_SQL = """
states AS (
  SELECT n_name AS estado, concat('Capital ', n_nationkey) AS capital,
         (n_nationkey * 7) % 25 * 0.45::DOUBLE + 1.5::DOUBLE AS lat,
         (n_nationkey * 11) % 25 * 0.55::DOUBLE - 73.0::DOUBLE AS lon, n_nationkey AS ord
  FROM nation
)
"""


def thresholds(spark: SparkSession, sf: str) -> DataFrame:
    """Thresholds of nations of region 1, and the default row."""
    n = table(spark, sf, "nation").where("n_regionkey = 1")
    own = n.select(F.col("n_name").alias("estado"), F.lit(6.0).alias("a"), F.lit(6.5).alias("b"), F.lit(6.75).alias("c"))
    default = spark.createDataFrame([("_default", 6.25, 6.6, 6.8)], "estado string, a double, b double, c double")
    return own.union(default).toDF("estado", "umbral_amarillo", "umbral_naranja", "umbral_rojo")


def rain_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Orders of a nation's customers as its rain; amounts are quarters, so sums are exact."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("estado"),
        F.to_date("o_orderdate").alias("fecha"),
        (F.floor(F.col("o_totalprice") / 1000) / 4.0).alias("mm"),
    )


RAIN_SQL = """
daily AS (
  SELECT concat('NATION_', c_nationkey) AS estado, CAST(o_orderdate AS DATE) AS fecha,
         floor(o_totalprice / 1000) / 4.0::DOUBLE AS mm
  FROM orders JOIN customer ON o_custkey = c_custkey
)
"""


def quakes(spark: SparkSession, sf: str) -> DataFrame:
    """Events as earthquakes; magnitudes and depths are eighths, so sums are exact."""
    i = F.col("event_id")
    return table(spark, sf, "events").select(
        i.cast("string").alias("id_evento"),
        F.col("ts").alias("fecha_evento"),
        ((i * 13) % 40 / 8.0 + 2.0).alias("magnitud"),
        ((i * 29) % 800 / 8.0).alias("profundidad_km"),
        ((i * 37) % 1500 / 100.0 - 0.5).alias("lat"),
        ((i * 53) % 1700 / 100.0 - 75.0).alias("lon"),
    )


QUAKES_SQL = """
quakes AS (
  SELECT CAST(event_id AS VARCHAR) AS id_evento, ts AS fecha_evento,
         (event_id * 13) % 40 / 8.0::DOUBLE + 2.0::DOUBLE AS magnitud,
         (event_id * 29) % 800 / 8.0::DOUBLE AS profundidad_km,
         (event_id * 37) % 1500 / 100.0::DOUBLE - 0.5::DOUBLE AS lat,
         (event_id * 53) % 1700 / 100.0::DOUBLE - 75.0::DOUBLE AS lon
  FROM events
)
"""

NEAREST_SQL = """
pairs AS (
  SELECT q.id_evento, s.estado, s.ord,
         round(2 * 6371.0::DOUBLE * asin(sqrt(pow(sin(radians(s.lat - q.lat) / 2), 2)
           + cos(radians(q.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lon - q.lon) / 2), 2))), 6) AS km
  FROM quakes q CROSS JOIN states s
),
best AS (
  SELECT id_evento, estado, km, row_number() OVER (PARTITION BY id_evento ORDER BY km, ord) AS pos FROM pairs
),
assigned AS (
  SELECT q.*, CASE WHEN b.km <= 150 THEN b.estado END AS estado
  FROM quakes q JOIN best b ON q.id_evento = b.id_evento AND b.pos = 1
)
"""


def choices(spark: SparkSession, sf: str) -> DataFrame:
    """Choice lists with the nations as states."""
    from regionpulse.sources.dimensions import canonical_dim, choices_dim, distinct_event_types

    return choices_dim(states(spark, sf), distinct_event_types(canonical_dim(spark)))



def joined(name: str) -> Column:
    """An array column as text, for comparison."""
    return F.array_join(name, ";").alias(name)


def day_text(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd").alias(name)
