"""Alerts, selection, ledgers, deduplication and publication over the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionpulse.operators import alerts as A
from regionpulse.operators import classify as C
from regionpulse.operators import contracts as K
from regionpulse.operators import dedupe as D
from regionpulse.operators import filters as R
from regionpulse.operators import quality as Q
from regionpulse.operators import searchgrid as G
from regionpulse.operators import selection as S
from regionpulse.session import scratch_path, stage
from regionpulse.sources import ledgers, sinks
from workload.standins import (
    ALL_HOURS,
    HOURS,
    LATEST,
    NEWS_SQL,
    NOW,
    SITUATIONS,
    WINDOW_72H,
    WINDOW_ALL,
    choices,
    day_text,
    joined,
    metrics_sql,
    news,
    table,
)

METRIC_COLUMNS = """estado, tipo_evento, n_noticias, n_fuentes_distintas, tiene_victimas, tiene_rescate_activo,
  tiene_danios_estructurales, strftime(fecha_mas_reciente, '%Y-%m-%d') AS fecha_mas_reciente, nivel_alerta,
  urls_relacionadas"""


def _metrics(df: DataFrame) -> DataFrame:
    return df.drop("ventana_horas", "fecha_calculo").withColumn("fecha_mas_reciente", day_text("fecha_mas_reciente"))


def alert_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _metrics(A.sort_alerts(A.alert_metrics(news(spark, sf), ALL_HOURS, LATEST, urls=True)))


def alert_metrics_72h(spark: SparkSession, sf: str) -> DataFrame:
    return _metrics(A.sort_alerts(A.alert_metrics(news(spark, sf), HOURS, NOW, urls=True)))


def alert_metrics_situation(spark: SparkSession, sf: str) -> DataFrame:
    return _metrics(A.alert_metrics(news(spark, sf), ALL_HOURS, LATEST, situation=["lluvias", "sequia"], urls=True))


def alerts_ranked(spark: SparkSession, sf: str) -> DataFrame:
    return A.rank_alerts(A.alert_metrics(news(spark, sf), ALL_HOURS, LATEST)).select("orden", "estado", "tipo_evento")


def tagged_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Hits of two searches, each with its query."""
    hits = table(spark, sf, "events").select("event_id", "user_id")
    one, two = (G.tag_hits(hits.where(f"event_id % 2 = {i}"), q) for i, q in enumerate(("lluvia site:ve", 'sismo "zona"')))
    return one.unionByName(two)


def alert_urls(spark: SparkSession, sf: str) -> DataFrame:
    return A.alert_urls(news(spark, sf), ALL_HOURS, LATEST)


def alert_url_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The URLs of each alert in parts of two kilobytes."""
    parts = A.alert_url_parts(news(spark, sf), ALL_HOURS, LATEST, part_bytes=2000)
    return parts.withColumn("parte", F.col("parte").cast("long"))


def alert_url_ordered(spark: SparkSession, sf: str) -> DataFrame:
    """The whole text of the URLs of each alert, in order, in parts of two kilobytes."""
    return A.alert_url_ordered(news(spark, sf), ALL_HOURS, LATEST, part_bytes=2000)


def explode_events(spark: SparkSession, sf: str) -> DataFrame:
    return A.explode_events(news(spark, sf)).withColumn("fecha_dt", day_text("fecha_dt"))


def alert_window_filter(spark: SparkSession, sf: str) -> DataFrame:
    return R.filter_alert_window(news(spark, sf), NOW, HOURS).select("event_id", day_text("fecha_dt"))


def date_window(spark: SparkSession, sf: str) -> DataFrame:
    kept = R.filter_date_window(news(spark, sf), "2024-01-05", "2024-01-25")
    return kept.select("event_id", day_text("fecha_dt"))


def canonical_events(spark: SparkSession, sf: str) -> DataFrame:
    events = C.canonical_events(F.col("eventos"))
    tagged = news(spark, sf).select("event_id", events.alias("tipos"))
    chosen = C.filter_situation(F.col("tipos"), ["lluvias", "huracan"])
    return tagged.withColumn("activos", chosen).select("event_id", joined("tipos"), joined("activos"))


def has_situation(spark: SparkSession, sf: str) -> DataFrame:
    df = news(spark, sf).withColumn("tipos_evento_canonico", C.canonical_events(F.col("eventos")))
    return C.has_situation(df, "lluvias").select("event_id")


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    df = news(spark, sf)
    return S.enrich_with_alert(df, A.alert_metrics(df, HOURS, NOW))


def most_severe_match(spark: SparkSession, sf: str) -> DataFrame:
    return _enriched(spark, sf).select("event_id", "estado", "tipo_evento", "nivel_alerta_asociado")


def topk_per_situation(spark: SparkSession, sf: str) -> DataFrame:
    top = S.select_top(S.explode_situations(_enriched(spark, sf), SITUATIONS), 10)
    return top.withColumn("orden", F.col("orden").cast("long")).select("situacion", "orden", "event_id", "nivel_alerta_asociado", day_text("fecha_dt"), "url")


def topk_merge(spark: SparkSession, sf: str) -> DataFrame:
    df = news(spark, sf)
    sent = df.where("criterio_busqueda = 'signup'").select("url")
    chosen = S.select_news(df, A.alert_metrics(df, HOURS, NOW), sent, SITUATIONS, k=25)
    return chosen.select("situacion", F.col("orden").cast("long").alias("orden"), "event_id", "url")


def publish_news(spark: SparkSession, sf: str) -> DataFrame:
    return K.prepare_news(_enriched(spark, sf), "event_id")


def publish_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return K.prepare_metrics(A.alert_metrics(news(spark, sf), HOURS, NOW, urls=True))


def conform_metrics(spark: SparkSession, sf: str) -> DataFrame:
    rows = K.conform_output(K.prepare_metrics(A.alert_metrics(news(spark, sf), HOURS, NOW, urls=True)), "metrics")
    return rows.select(
        "estado", "tipo_evento", "n_noticias", "tiene_victimas", "nivel_alerta",
        F.date_format("fecha_calculo", "yyyy-MM-dd HH:mm").alias("fecha_calculo"),
        F.date_format("fecha_mas_reciente", "yyyy-MM-dd HH:mm").alias("fecha_mas_reciente"),
    )


def conform_news(spark: SparkSession, sf: str) -> DataFrame:
    """The load date, which is today's, aside."""
    rows = K.conform_output(K.prepare_news(_enriched(spark, sf), "event_id"), "news")
    return rows.drop("fecha_carga").withColumn("fecha", F.date_format("fecha", "yyyy-MM-dd"))


def choice_violations(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "events").select(
        F.concat(F.lit("nation_"), (F.col("user_id") % 30).cast("string")).alias("estado"),
        F.when(F.col("value") > 20, "sismo").otherwise(F.col("event_type")).alias("tipo_evento"),
        F.when(F.col("value") > 20, "rojo").otherwise("azul").alias("nivel_alerta_asociado"),
    )
    return K.choice_violations(rows, "news", choices(spark, sf))


def submission_xml(spark: SparkSession, sf: str) -> DataFrame:
    rows = K.prepare_news(_enriched(spark, sf), "event_id")
    sent = K.submission_xml(rows, "avisos", "f-1", [c for c in rows.columns if c != "event_id"])
    flat = F.regexp_replace(F.regexp_replace("xml", r">\s+<", "><"), "uuid:[0-9a-f-]{36}", "uuid:x")
    return sent.select("event_id", F.trim(flat).alias("xml"))


def alert_keys_new(spark: SparkSession, sf: str) -> DataFrame:
    keyed = S.with_alert_key(A.alert_metrics(news(spark, sf), HOURS, NOW))
    sent = keyed.where("nivel_alerta = 'Naranja'").select("clave")
    return S.not_in_ledger(keyed, sent, "clave").select("clave", "n_noticias")


def ledger_anti_url(spark: SparkSession, sf: str) -> DataFrame:
    df = news(spark, sf)
    sent = df.where("criterio_busqueda = 'signup'").select("url")
    return S.not_in_ledger(df, sent, "url").select("event_id", "url")


def ledger_update(spark: SparkSession, sf: str) -> DataFrame:
    df = news(spark, sf).where("url IS NOT NULL")
    return ledgers.ledger_union(df.where("criterio_busqueda = 'signup'"), df, "url")


def ledger_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of all event types recorded, the last one twice, then compacted."""
    df = news(spark, sf).where("url IS NOT NULL")
    path, compact = scratch_path(spark, "ledger"), scratch_path(spark, "ledger")
    ledgers.record_batch(df.where("criterio_busqueda = 'view'"), "url", path, 1)
    for _ in range(2):
        ledgers.record_batch(df.where("criterio_busqueda <> 'view'"), "url", path, 2)
    ledgers.compact_ledger(spark, path, compact, "url")
    return ledgers.read_sent_ledger(spark, compact)


def publish_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows sent through a sink that rejects some; only accepted ones remain."""

    def deliver(batch):
        return [(500, "rejected") if url.endswith("7") else (201, "") for url in batch["enlace"]]

    rows = K.prepare_news(_enriched(spark, sf), "event_id")
    outcomes = sinks.publish(rows, "event_id", deliver, scratch_path(spark, "outcomes"))
    return sinks.sent_rows(rows, "event_id", outcomes).select("event_id", "enlace")


def publish_retry(spark: SparkSession, sf: str) -> DataFrame:
    """One batch published three times, partly rejected at first; how often the ledger holds each accepted URL."""
    rows = K.prepare_news(_enriched(spark, sf), "event_id").where("enlace <> ''").select("enlace", "titulo").dropDuplicates(["enlace"])
    rows = rows.withColumn("url", F.col("enlace"))
    ledger, accepted = scratch_path(spark, "ledger"), []
    for refused in ("7", "3", ""):
        def deliver(batch, refused=refused):
            return [(500, "") if refused and url.endswith(refused) else (201, "") for url in batch["enlace"]]

        fresh = stage(S.not_in_ledger(rows, ledgers.read_sent_ledger(spark, ledger), "url"))
        outcomes = sinks.publish(fresh, "url", deliver, scratch_path(spark, "outcomes"))
        sent = stage(sinks.sent_rows(fresh, "url", outcomes).select("url"))
        ledgers.record_batch(sent, "url", ledger, "b1")
        accepted.append(sent)
    every = accepted[0].unionAll(accepted[1]).unionAll(accepted[2])
    kept = ledgers.read_sent_ledger(spark, ledger)
    return kept.join(every.groupBy("url").agg(F.count("*").alias("veces")), "url", "left")


def append_increment(spark: SparkSession, sf: str) -> DataFrame:
    """A table that grew by two overlapping increments, by key."""
    df = news(spark, sf).select("event_id", "url")
    path = scratch_path(spark, "increment")
    for kinds in (["view", "click"], ["click", "purchase", "signup", "error"]):
        part = news(spark, sf).where(F.col("criterio_busqueda").isin(kinds)).select("event_id", "url")
        sinks.append_increment(part, path, "event_id")
    return spark.read.schema(df.schema).parquet(path)


def _hits(spark: SparkSession, sf: str) -> DataFrame:
    """Events as raw hits with repeated and missing URLs."""
    return table(spark, sf, "events").select(
        F.when(
            F.col("event_id") % 50 != 0,
            F.concat_ws("/", F.lit("https://e.example.com"), F.col("user_id").cast("string"), "event_type"),
        ).alias("url"),
        "event_id",
        "value",
        F.lit("x").alias("displayed_url"),
        F.lit("y").alias("rich_type"),
    )


HITS_SQL = """
hits AS (
  SELECT CASE WHEN event_id % 50 <> 0 THEN concat('https://e.example.com/', user_id, '/', event_type) END AS url,
         event_id, value FROM events
)
"""


def dedupe_first(spark: SparkSession, sf: str) -> DataFrame:
    return D.merge_parts(_hits(spark, sf), ["event_id"])


def dedupe_social(spark: SparkSession, sf: str) -> DataFrame:
    social = _hits(spark, sf).withColumnRenamed("url", "source_url").withColumn("profile_url", F.lit("p"))
    return D.merge_parts(social.withColumn("likes", F.lit("3")), ["event_id"])


def dedupe_topk_large(spark: SparkSession, sf: str) -> DataFrame:
    """First 1,500 rows per event type: more than the per-task limit covers."""
    df = table(spark, sf, "events").select("event_type", "event_id", "value")
    top = D.first_per_group(df, ["event_type"], [F.desc("value"), "event_id"], k=1500, rank="orden", by=-F.col("value"))
    return top.withColumn("orden", F.col("orden").cast("long"))


def _runs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    old = table(spark, sf, "supplier").select(
        F.concat(F.lit("u"), (F.col("s_suppkey") % 70).cast("string")).alias("url"),
        F.col("s_name").alias("title"), F.col("s_suppkey").alias("pos"),
    )
    new = table(spark, sf, "customer").select(
        F.concat(F.lit("u"), (F.col("c_custkey") % 900).cast("string")).alias("url"),
        F.col("c_name").alias("title"), F.col("c_custkey").alias("pos"),
        F.col("c_mktsegment").alias("segmento"),
    )
    return old, new


RUNS_SQL = """
old AS (SELECT concat('u', s_suppkey % 70) AS url, s_name AS title, s_suppkey AS pos, NULL::VARCHAR AS segmento FROM supplier),
new AS (SELECT concat('u', c_custkey % 900) AS url, c_name AS title, c_custkey AS pos, c_mktsegment AS segmento FROM customer)
"""


def dedupe_runs(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _runs(spark, sf)
    return D.accumulate(old, new, ["pos"])


def dedupe_increment(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _runs(spark, sf)
    return D.increment(old, D.keep_first(new, "url", ["pos"]), "url")


def union_missing(spark: SparkSession, sf: str) -> DataFrame:
    return D.union_by_name(*_runs(spark, sf))


def quality_counters(spark: SparkSession, sf: str) -> DataFrame:
    return Q.count_news(news(spark, sf))


def dedupe_counters(spark: SparkSession, sf: str) -> DataFrame:
    return Q.dedupe_counters(_hits(spark, sf), "url")


def ledger_counters(spark: SparkSession, sf: str) -> DataFrame:
    df = news(spark, sf)
    return Q.ledger_counters(df, df.where("criterio_busqueda = 'signup'").select("url"), "url")


QUERIES = {
    f.__name__: f
    for f in (
        alert_metrics, alert_metrics_72h, alert_metrics_situation, alerts_ranked, tagged_hits, conform_news, alert_urls, alert_url_parts, alert_url_ordered, explode_events,
        alert_window_filter, date_window, canonical_events, has_situation, most_severe_match,
        topk_per_situation, topk_merge, publish_news, publish_metrics, conform_metrics, choice_violations,
        submission_xml, alert_keys_new, ledger_anti_url, ledger_update, ledger_batches, publish_outcomes,
        publish_retry, append_increment, dedupe_first, dedupe_social, dedupe_topk_large, dedupe_runs, dedupe_increment,
        union_missing, quality_counters, dedupe_counters, ledger_counters,
    )
}

_SEV = "CASE nivel WHEN 'Rojo' THEN 0 WHEN 'Naranja' THEN 1 WHEN 'Amarillo' THEN 2 WHEN 'Verde' THEN 3 ELSE 9 END"

_ENRICHED = f"""
WITH {NEWS_SQL}, {metrics_sql(*WINDOW_72H)},
ranked AS (
  SELECT e.event_id, e.tipo_evento, m.nivel_alerta AS nivel,
         row_number() OVER (PARTITION BY e.event_id ORDER BY
           CASE m.nivel_alerta WHEN 'Rojo' THEN 0 WHEN 'Naranja' THEN 1 WHEN 'Amarillo' THEN 2 WHEN 'Verde' THEN 3 ELSE 99 END,
           e.tipo_evento) AS pos
  FROM exploded e LEFT JOIN metrics m ON e.estado = m.estado AND e.tipo_evento = m.tipo_evento
),
enriched AS (
  SELECT s.*, r.tipo_evento, coalesce(r.nivel, 'Verde') AS nivel
  FROM src s JOIN ranked r ON s.event_id = r.event_id AND r.pos = 1
)
"""

_SITUATIONS = """
situaciones(pos, nombre) AS (VALUES (0, 'lluvias'), (1, 'sismo'), (2, 'huracan')),
"""


def _topk(source: str, k: int) -> str:
    return f"""
{_SITUATIONS}
tops AS (
  SELECT * FROM (
    SELECT t.pos AS situacion_pos, t.nombre AS situacion, e.*,
           row_number() OVER (PARTITION BY t.pos ORDER BY {_SEV}, e.fecha_dt DESC NULLS LAST, e.url NULLS FIRST, e.title) AS orden
    FROM {source} e JOIN kinds k ON k.event_type = e.criterio_busqueda JOIN situaciones t ON t.nombre = k.tipo
  ) WHERE orden <= {k}
)
"""


_CHOICE = "replace(lower(estado), ' ', '_')"

ORACLES = {
    "alert_metrics": f"WITH {NEWS_SQL}, {metrics_sql(*WINDOW_ALL)} SELECT {METRIC_COLUMNS} FROM metrics",
    "alert_metrics_72h": f"WITH {NEWS_SQL}, {metrics_sql(*WINDOW_72H)} SELECT {METRIC_COLUMNS} FROM metrics",
    "alert_metrics_situation": f"""WITH {NEWS_SQL}, {metrics_sql(*WINDOW_ALL)}
        SELECT {METRIC_COLUMNS} FROM metrics WHERE tipo_evento IN ('lluvias', 'sequia')""",
    "alerts_ranked": f"""WITH {NEWS_SQL}, {metrics_sql(*WINDOW_ALL)} SELECT row_number() OVER (ORDER BY {_SEV.replace("nivel", "nivel_alerta", 1)},
        n_noticias DESC, estado, tipo_evento) - 1 AS orden, estado, tipo_evento FROM metrics""",
    "tagged_hits": """SELECT event_id, user_id, CASE event_id % 2 WHEN 0 THEN 'lluvia site:ve' ELSE 'sismo "zona"' END AS criterio_busqueda FROM events""",
    "alert_urls": f"""WITH {NEWS_SQL} SELECT DISTINCT estado, tipo_evento, url FROM exploded
        WHERE url IS NOT NULL AND fecha_dt IS NOT NULL""",
    "alert_url_parts": f"""WITH {NEWS_SQL},
        u AS (SELECT DISTINCT estado, tipo_evento, url FROM exploded WHERE fecha_dt IS NOT NULL),
        s AS (SELECT estado, tipo_evento, greatest(CAST(ceil(coalesce(sum(strlen(url) + 3), 0) / 2000.0) AS BIGINT), 1) AS n FROM u GROUP BY ALL)
        SELECT estado, tipo_evento, coalesce(('0x' || substr(md5(url), 1, 8))::BIGINT % n, 0) AS parte,
               coalesce(string_agg(url, ' | ' ORDER BY url), '') AS urls FROM u JOIN s USING (estado, tipo_evento) GROUP BY ALL""",
    "alert_url_ordered": f"""WITH {NEWS_SQL},
        u AS (SELECT DISTINCT estado, tipo_evento, url FROM exploded WHERE fecha_dt IS NOT NULL AND url IS NOT NULL),
        s AS (SELECT *, coalesce(sum(strlen(url) + 3) OVER (PARTITION BY estado, tipo_evento ORDER BY url
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT // 2000 AS parte FROM u)
        SELECT estado, tipo_evento, parte, string_agg(url, ' | ' ORDER BY url) AS urls FROM s GROUP BY ALL""",
    "explode_events": f"""WITH {NEWS_SQL} SELECT estado, tipo_evento, url, strftime(fecha_dt, '%Y-%m-%d') AS fecha_dt,
        v AS victimas, r AS rescate, d AS danios FROM exploded""",
    "alert_window_filter": f"""WITH {NEWS_SQL} SELECT event_id, strftime(fecha_dt, '%Y-%m-%d') AS fecha_dt FROM news
        WHERE CAST(fecha_dt AS TIMESTAMP) BETWEEN TIMESTAMP '2024-01-17 12:00:00' AND TIMESTAMP '2024-01-20 12:00:00'""",
    "date_window": f"""WITH {NEWS_SQL} SELECT event_id, strftime(fecha_dt, '%Y-%m-%d') AS fecha_dt FROM news
        WHERE fecha_dt BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'""",
    "canonical_events": f"""WITH {NEWS_SQL}
        SELECT n.event_id, coalesce(string_agg(k.tipo, ';' ORDER BY k.tipo), '') AS tipos,
               coalesce(string_agg(k.tipo, ';' ORDER BY k.tipo) FILTER (WHERE k.tipo IN ('lluvias', 'huracan')), '') AS activos
        FROM news n LEFT JOIN kinds k ON n.criterio_busqueda = k.event_type GROUP BY n.event_id""",
    "has_situation": f"""WITH {NEWS_SQL} SELECT DISTINCT n.event_id FROM news n
        JOIN kinds k ON n.criterio_busqueda = k.event_type WHERE k.tipo = 'lluvias'""",
    "most_severe_match": f"""{_ENRICHED}
        SELECT event_id, estado, tipo_evento, nivel AS nivel_alerta_asociado FROM enriched""",
    "topk_per_situation": f"""{_ENRICHED}, {_topk('enriched', 10)}
        SELECT situacion, orden, event_id, nivel AS nivel_alerta_asociado,
               strftime(fecha_dt, '%Y-%m-%d') AS fecha_dt, url FROM tops""",
    "topk_merge": f"""{_ENRICHED},
        fresh AS (SELECT * FROM enriched e WHERE NOT EXISTS
          (SELECT 1 FROM news n WHERE n.criterio_busqueda = 'signup' AND n.url = e.url)),
        {_topk('fresh', 25)}
        SELECT situacion, orden, event_id, url FROM (
          SELECT *, row_number() OVER (PARTITION BY url ORDER BY situacion_pos, orden) AS pos FROM tops) WHERE pos = 1""",
    "publish_news": f"""{_ENRICHED}
        SELECT event_id, coalesce(strftime(fecha_dt, '%Y-%m-%d'), '') AS fecha, title AS titulo,
               coalesce(url, '') AS enlace, {_CHOICE} AS estado, tipo_evento, coalesce(dominio, '') AS medio,
               lower(nivel) AS nivel_alerta_asociado, criterio_busqueda FROM enriched""",
    "publish_metrics": f"""WITH {NEWS_SQL}, {metrics_sql(*WINDOW_72H)}
        SELECT '2024-01-20T12:00:00' AS fecha_calculo, {_CHOICE} AS estado, tipo_evento, 72 AS ventana_horas,
               CAST(n_noticias AS INTEGER) AS n_noticias, CAST(n_fuentes_distintas AS INTEGER) AS n_fuentes_distintas,
               CASE WHEN tiene_victimas THEN 'si' ELSE 'no' END AS tiene_victimas,
               CASE WHEN tiene_rescate_activo THEN 'si' ELSE 'no' END AS tiene_rescate_activo,
               CASE WHEN tiene_danios_estructurales THEN 'si' ELSE 'no' END AS tiene_danios_estructurales,
               strftime(fecha_mas_reciente, '%Y-%m-%dT00:00:00') AS fecha_mas_reciente,
               lower(nivel_alerta) AS nivel_alerta, urls_relacionadas FROM metrics""",
    "conform_metrics": f"""WITH {NEWS_SQL}, {metrics_sql(*WINDOW_72H)}
        SELECT {_CHOICE} AS estado, tipo_evento, CAST(n_noticias AS INTEGER) AS n_noticias,
               CASE WHEN tiene_victimas THEN 'si' ELSE 'no' END AS tiene_victimas, lower(nivel_alerta) AS nivel_alerta,
               '2024-01-20 12:00' AS fecha_calculo,
               strftime(fecha_mas_reciente, '%Y-%m-%d 00:00') AS fecha_mas_reciente FROM metrics""",
    "choice_violations": """
        WITH rows AS (
          SELECT concat('nation_', user_id % 30) AS estado, CASE WHEN value > 20 THEN 'sismo' ELSE event_type END AS tipo,
                 CASE WHEN value > 20 THEN 'rojo' ELSE 'azul' END AS nivel FROM events),
        cells AS (
          SELECT 'estado' AS campo, 'estados' AS list_name, estado AS valor FROM rows
          UNION ALL SELECT 'tipo_evento', 'tipos_evento', tipo FROM rows
          UNION ALL SELECT 'nivel_alerta_asociado', 'niveles_alerta', nivel FROM rows)
        SELECT campo, list_name, valor, count(*) AS n FROM cells
        WHERE NOT (list_name = 'estados' AND valor IN (SELECT lower(n_name) FROM nation))
          AND NOT (list_name = 'tipos_evento' AND valor IN ('sismo', 'lluvias', 'sequia', 'huracan'))
          AND NOT (list_name = 'niveles_alerta' AND valor IN ('rojo', 'naranja', 'amarillo', 'verde'))
        GROUP BY ALL""",
    "submission_xml": f"""{_ENRICHED}
        SELECT event_id, concat('<avisos id="avisos"><formhub><uuid>f-1</uuid></formhub>',
          CASE WHEN fecha_dt IS NULL THEN '' ELSE concat('<fecha>', strftime(fecha_dt, '%Y-%m-%d'), '</fecha>') END,
          '<titulo>', title, '</titulo>',
          CASE WHEN url IS NULL THEN '' ELSE concat('<enlace>', url, '</enlace>') END,
          '<estado>', {_CHOICE}, '</estado><tipo_evento>', tipo_evento, '</tipo_evento>',
          CASE WHEN url IS NULL THEN '' ELSE concat('<medio>', dominio, '</medio>') END,
          '<nivel_alerta_asociado>', lower(nivel), '</nivel_alerta_asociado><criterio_busqueda>', criterio_busqueda,
          '</criterio_busqueda><meta><instanceID>uuid:x</instanceID></meta></avisos>') AS xml FROM enriched""",
    "alert_keys_new": f"""WITH {NEWS_SQL}, {metrics_sql(*WINDOW_72H)}
        SELECT concat(estado, '|', tipo_evento, '|2024-01-20|', nivel_alerta) AS clave, n_noticias FROM metrics
        WHERE nivel_alerta <> 'Naranja'""",
    "ledger_anti_url": f"""WITH {NEWS_SQL} SELECT event_id, url FROM news e WHERE NOT EXISTS
        (SELECT 1 FROM news n WHERE n.criterio_busqueda = 'signup' AND n.url = e.url)""",
    "ledger_update": f"WITH {NEWS_SQL} SELECT DISTINCT url FROM news WHERE url IS NOT NULL",
    "ledger_batches": f"""WITH {NEWS_SQL} SELECT DISTINCT url FROM news
        WHERE url IS NOT NULL AND criterio_busqueda IS NOT NULL""",
    "publish_retry": f"""{_ENRICHED} SELECT DISTINCT url, 1 AS veces FROM enriched WHERE coalesce(url, '') <> ''""",
    "publish_outcomes": f"""{_ENRICHED} SELECT event_id, coalesce(url, '') AS enlace FROM enriched
        WHERE coalesce(url, '') NOT LIKE '%7'""",
    "append_increment": f"WITH {NEWS_SQL} SELECT event_id, url FROM news",
    "dedupe_first": f"""WITH {HITS_SQL} SELECT url, event_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY url ORDER BY event_id) AS pos FROM hits) WHERE pos = 1""",
    "dedupe_social": f"""WITH {HITS_SQL} SELECT url AS source_url, event_id, value, '3' AS likes, '' AS comments FROM (
        SELECT *, row_number() OVER (PARTITION BY url ORDER BY event_id) AS pos FROM hits) WHERE pos = 1""",
    "dedupe_topk_large": """SELECT event_type, event_id, value, orden FROM (
        SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS orden FROM events)
        WHERE orden <= 1500""",
    "dedupe_runs": f"""WITH {RUNS_SQL}, both_runs AS (SELECT 0 AS run, * FROM old UNION ALL SELECT 1, * FROM new)
        SELECT url, title, pos, segmento FROM (
          SELECT *, row_number() OVER (PARTITION BY url ORDER BY run, pos) AS rn FROM both_runs) WHERE rn = 1""",
    "dedupe_increment": f"""WITH {RUNS_SQL} SELECT url, title, pos, segmento FROM (
          SELECT *, row_number() OVER (PARTITION BY url ORDER BY pos) AS rn FROM new) n
        WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM old o WHERE o.url = n.url)""",
    "union_missing": f"WITH {RUNS_SQL} SELECT * FROM old UNION ALL SELECT * FROM new",
    "quality_counters": f"""WITH {NEWS_SQL} SELECT count(*) AS filas, count(*) FILTER (WHERE estado IS NULL) AS sin_estado,
        count(*) FILTER (WHERE fecha_dt IS NULL) AS sin_fecha FROM news""",
    "dedupe_counters": f"""WITH {HITS_SQL} SELECT count(*) AS antes,
        count(DISTINCT url) + max(CASE WHEN url IS NULL THEN 1 ELSE 0 END) AS despues FROM hits""",
    "ledger_counters": f"""WITH {NEWS_SQL} SELECT count(*) AS filas, count(*) FILTER (WHERE url IN
        (SELECT url FROM news WHERE criterio_busqueda = 'signup' AND url IS NOT NULL)) AS omitidas FROM news""",
}
ORACLES["conform_news"] = f"SELECT * EXCLUDE (event_id, fecha), nullif(fecha, '') AS fecha FROM ({ORACLES['publish_news']})"
