"""Versions, indexed ledgers, files cut by many tasks, and counters of running jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionpulse.operators.quality import Counters
from regionpulse.plans.news import publish_news, run_news
from regionpulse.session import scratch_path
from regionpulse.sources import key_index, readers, sinks, split_files, versions
from regionpulse.streaming import ledger as SL
from workload import sensors, streams, texts
from workload.standins import NEWS_SQL, day_text, news, table


def version_commit(spark: SparkSession, sf: str) -> DataFrame:
    """A table through a writer that fails and two that meet: each reader sees a whole version, and nothing is lost."""
    rows = news(spark, sf).select("event_id", "url", "criterio_busqueda")
    root = scratch_path(spark, "versions")
    base = versions.commit_version(rows.where("criterio_busqueda = 'view'"), root)
    # This writer ends before it commits: its rows are never seen.
    sinks.write_version(rows, root)
    versions.commit_version(versions.read_version(spark, root, rows.schema).unionAll(rows.where("criterio_busqueda = 'click'")), root, base)
    late = rows.where("criterio_busqueda = 'purchase'")
    try:
        versions.commit_version(versions.read_version(spark, root, rows.schema, base).unionAll(late), root, base)
    except versions.Conflict:
        versions.commit_version(versions.read_version(spark, root, rows.schema).unionAll(late), root)
    return versions.read_version(spark, root, rows.schema).withColumn("version", F.lit(versions.latest(spark, root)[0]))


def ledger_probe(spark: SparkSession, sf: str) -> DataFrame:
    """Reports whose URL no earlier batch has recorded, by the filters of an indexed ledger."""
    rows = news(spark, sf).select("event_id", "url", "criterio_busqueda")
    root = scratch_path(spark, "ledger")
    key_index.create(spark, root, 16)
    for kind in ("signup", "purchase"):
        key_index.record(rows.where(F.col("criterio_busqueda") == kind), "url", root, kind)
    return key_index.unseen(rows, "url", root).select("event_id", "url")


def stream_ledger_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """URLs recorded once by a stream over an indexed ledger, which is started twice."""
    path, checkpoint = scratch_path(spark, "ledger"), scratch_path(spark, "checkpoint")
    urls = streams._news(spark, sf).select("url")
    for _ in range(2):
        SL.start_indexed_stream(urls, "url", path, checkpoint, ["url"]).awaitTermination()
    return key_index.read_keys(spark, path).withColumnRenamed("clave", "url")


def raw_parts_split(spark: SparkSession, sf: str) -> DataFrame:
    """The parts of :func:`workload.texts.raw_parts`, read in splits."""
    folder = texts.write_parts(spark, sf)
    return texts.merged_parts(split_files.read_split_parts(spark, folder, "*.csv"))


def geo_file(spark: SparkSession, sf: str) -> DataFrame:
    """Landed features of all events: half of them one a line, the others in collections that span lines."""
    folder = scratch_path(spark, "geo")
    feature = F.to_json(F.col("feature"))
    rows = sensors.features(spark, sf)
    rows.where("event_id % 2 = 0").select(feature).write.text(f"{folder}/lines")
    spread = rows.where("event_id % 2 = 1").select((F.col("event_id") % 16).alias("file"), F.col("event_id").alias("at"), F.concat(F.replace(feature, F.lit('"properties"'), F.lit('\n "properties"')), F.lit(",")).alias("line"))
    ends = spark.range(16).select(F.col("id").alias("file"), F.explode(F.array(
        F.struct(F.lit(-1).cast("long").alias("at"), F.lit('{"type": "FeatureCollection", "features": [').alias("line")),
        F.struct(F.lit((1 << 62)).alias("at"), F.lit("{}\n]}").alias("line")),
    )).alias("e")).select("file", "e.*")
    spread.unionByName(ends).repartition("file").sortWithinPartitions("file", "at").select("line").write.text(f"{folder}/collections")
    found = split_files.read_split_geojson(spark, folder, "*.txt")
    return found.withColumn("fecha_evento", F.date_format("fecha_evento", "yyyy-MM-dd HH:mm:ss"))


def rain_file(spark: SparkSession, sf: str) -> DataFrame:
    """Landed weather documents, one a line."""
    folder = scratch_path(spark, "rain")
    sensors.rain_documents(spark, sf).write.text(folder)
    return readers.read_rain_json(spark, folder).withColumn("fecha", day_text("fecha"))


def job_counters(spark: SparkSession, sf: str) -> DataFrame:
    """Counters that the news job and its publication gather while they run."""
    counters, work = Counters(), scratch_path(spark, "news")
    processed, alerts = run_news(texts._raw(spark, sf), texts.JOB, texts.REF, work, "2026-05-20", "2026-07-04", counters=counters)
    urls, keys = scratch_path(spark, "ledger"), scratch_path(spark, "ledger")
    processed.where("length(url) % 2 = 0").select("url").distinct().write.parquet(f"{urls}/batch_id=before")
    accept = lambda batch: [(201, "")] * len(batch)
    publish_news(processed, alerts, texts.JOB, urls, keys, "b1", accept, accept, work, counters)
    return counters.table(spark)


QUERIES = {
    f.__name__: f for f in (version_commit, ledger_probe, stream_ledger_indexed, raw_parts_split, geo_file, rain_file, job_counters)
}

ORACLES = {
    "version_commit": f"WITH {NEWS_SQL} SELECT event_id, url, criterio_busqueda, 3 AS version FROM news WHERE criterio_busqueda IN ('view', 'click', 'purchase')",
    "ledger_probe": f"""WITH {NEWS_SQL} SELECT event_id, url FROM news n WHERE NOT EXISTS
        (SELECT 1 FROM news k WHERE k.criterio_busqueda IN ('signup', 'purchase') AND k.url = n.url)""",
    "stream_ledger_indexed": f"WITH {NEWS_SQL} SELECT DISTINCT url FROM news WHERE url IS NOT NULL",
    "raw_parts_split": texts.ORACLES["raw_parts"],
    "geo_file": """SELECT concat(event_id, 'a') AS id_evento, strftime(make_timestamp(event_id * 1000000), '%Y-%m-%d %H:%M:%S') AS fecha_evento,
        value AS magnitud, value AS profundidad_km, event_type AS lugar,
        (event_id % 45) / 4.0::DOUBLE AS lat, (event_id % 90) / 2.0::DOUBLE AS lon, '' AS url_detalle FROM events""",
    "rain_file": sensors.ORACLES["rain_json"],
    "job_counters": f"""WITH {texts._RAW_SQL},
        p AS (SELECT url, concat(title_clean, ' ', snippet_clean) AS texto FROM cleaned WHERE {texts._any(texts.JOB.gazetteer, 'snippet_clean')}),
        q AS (SELECT url, {texts._longest(texts.STATES)} AS estado, {texts._any(list(texts.TYPES))} AS tipos FROM p)
        SELECT 'crudas' AS paso, 'filas' AS contador, count(*) AS valor FROM documents
        UNION ALL SELECT 'procesadas', 'filas', count(*) FROM q
        UNION ALL SELECT 'procesadas', 'sin_estado', count(*) FILTER (WHERE estado IS NULL) FROM q
        UNION ALL SELECT 'procesadas', 'sin_fecha', 0
        UNION ALL SELECT 'candidatas', 'filas', count(*) FROM q WHERE estado IS NOT NULL AND tipos
        UNION ALL SELECT 'nuevas', 'filas', count(*) FROM q WHERE estado IS NOT NULL AND tipos AND length(url) % 2 = 1""",
}
