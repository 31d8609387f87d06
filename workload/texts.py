"""Text normalisation, tagging, dates in text, places and the whole news processing over documents."""

from __future__ import annotations

from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionpulse.functions import dates, text
from regionpulse.operators import classify as C
from regionpulse.operators import entities as E
from regionpulse.operators import filters as R
from regionpulse.plans.news import NewsSettings, merge_raw, process_news, run_news
from regionpulse.session import scratch_path, spread
from regionpulse.sources import readers, sinks
from workload.standins import day_text, joined, strings, table

REF = datetime(2026, 7, 4, 10, 30)

# Words of the test documents in the role of a lexicon: prefixes of each other,
# leading spaces, repeats and a word that never occurs.
LEXICON = {
    "eventos": ["ering", "tion", " tionth", "tion", "quement", "cion", "schung", "zzz"],
    "victimas": [" the", "there", "thereon", "ung", " heit", "ement"],
    # The last three go on from a state name without being one.
    "daños": ["eauou", "tionou", "onnt", " para", "ungen", "quea", "thereonth"],
}
VOCABULARY = [k for words in LEXICON.values() for k in words]
STATES = ["the", "there", "thereon", "que", "quement", "cion", "ung", "schung", "para"]
GAZETTEER = ["thereon", "quement", "onthe.", "schung", "cionpara", "eauou", "nation_3", "thereonth"]
FOREIGN = ["schlich", "tiontion", "ouleau", "ciondo"]
ALIASES = {"red ring": "red bolt", "small ring": "ring", "blue widget": "widgets"}
BLACKLIST = ["green gear", "bolt", "economy"]


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents"))


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", "lang", text.normalize_text(F.col("text")).alias("texto"))


CLEAN = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  strip_accents(replace(lower({c}), 'ß', 'ss')), '[^\x00-\x7F]', '', 'g'), '[@#\-_"!?()/|*]', ' ', 'g'),
  '[.,]', '', 'g'), '\s+', ' ', 'g'))"""

CLEAN_SQL = f"clean AS (SELECT doc_id, lang, {CLEAN.format(c='text')} AS texto FROM documents)"


def _list(words: list[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _found(words: list[str], column: str = "texto") -> str:
    return f"list_filter({_list(words)}, lambda k: contains({column}, k))"


def _any(words: list[str], column: str = "texto") -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


def _longest(names: list[str], column: str = "texto") -> str:
    ordered = sorted(names, key=len, reverse=True)
    return "CASE " + " ".join(f"WHEN contains(lower({column}), '{n}') THEN '{n}'" for n in ordered) + " END"


def normalize_documents(spark: SparkSession, sf: str) -> DataFrame:
    return clean(spark, sf).select("doc_id", "texto")


def unaccent_documents(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", text.unaccent(F.col("text")).alias("texto"))


def choice_names(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select("doc_id", text.choice_name(F.col("text")).alias("nombre"))


def match_keywords(spark: SparkSession, sf: str) -> DataFrame:
    tagged = C.tag_categories(clean(spark, sf), LEXICON, "texto")
    return tagged.select("doc_id", *[joined(c) for c in LEXICON])


def category_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return C.category_coverage(C.tag_categories(clean(spark, sf), LEXICON, "texto"), list(LEXICON))


FREQUENCY_GROUPS = {"sufijos": ["tion", "cion", "ering"], "aleman": ["schung"]}


def keyword_frequencies(spark: SparkSession, sf: str) -> DataFrame:
    return C.keyword_frequencies(C.tag_categories(clean(spark, sf), LEXICON, "texto"), "eventos", FREQUENCY_GROUPS)


def gazetteer_filter(spark: SparkSession, sf: str) -> DataFrame:
    return R.filter_gazetteer(clean(spark, sf), GAZETTEER, "texto").select("doc_id")


def gazetteer_join(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows with the terms as a table."""
    terms = spark.createDataFrame([(t,) for t in [*GAZETTEER, "qqqqzz", None, ""]], "term string")
    return R.filter_gazetteer_table(clean(spark, sf), terms, "texto").select("doc_id")


def gazetteer_join_alike(spark: SparkSession, sf: str) -> DataFrame:
    """Terms that all begin with what most texts hold; some also occur nowhere."""
    terms = table(spark, sf, "part").select(F.concat(F.lit("tion"), F.substring("p_name", 1, 2)).alias("term"))
    return R.filter_gazetteer_table(clean(spark, sf), terms, "texto").select("doc_id")


def strict_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates in forms that are a date and forms that are none."""
    day, key = F.date_format("o_orderdate", "yyyy-M-d"), F.col("o_orderkey")
    form = F.when(key % 4 == 0, day).when(key % 4 == 1, F.concat(day, F.lit(" 10:00"))).when(key % 4 == 2, "2026-13-01").otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    return table(spark, sf, "orders").select("o_orderkey", F.date_format(dates.strict_date(form), "yyyy-MM-dd").alias("dia"))


def news_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Processed documents written by publication date, as a version and as an accumulated table, and read back."""
    path, accumulated = scratch_path(spark, "processed"), scratch_path(spark, "accumulated")
    rows = table(spark, sf, "documents").select(
        F.concat(F.lit("https://d.example.com/"), F.col("doc_id").cast("string")).alias("url"),
        F.date_add(F.lit("2026-01-01").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("fecha_dt"),
        F.array(F.col("lang"), F.col("source")).alias("eventos"),
    )
    sinks.write_news(rows, path)
    first = readers.read_processed(spark, path, rows.schema)
    version = sinks.write_version(first.where("url NOT LIKE '%7'"), accumulated)
    kept = readers.read_accumulated(spark, version, rows.schema)
    return kept.select("url", day_text("fecha_dt"), joined("eventos"))


def export_table(spark: SparkSession, sf: str) -> DataFrame:
    """Parts exported as CSV and read back."""
    path = scratch_path(spark, "export")
    rows = table(spark, sf, "part").select("p_partkey", "p_name", F.concat(F.lit('a "b", c; '), "p_brand").alias("marca"))
    sinks.export_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


def exclude_terms(spark: SparkSession, sf: str) -> DataFrame:
    return R.exclude_terms(clean(spark, sf), FOREIGN, "texto").select("doc_id")


def extract_state_longest(spark: SparkSession, sf: str) -> DataFrame:
    return C.tag_state(clean(spark, sf), STATES, "texto").select("doc_id", "estado")


def classification_text(spark: SparkSession, sf: str) -> DataFrame:
    t = text.classification_text(text.normalize_text(F.col("source")), text.normalize_text(F.col("text")))
    return docs(spark, sf).select("doc_id", t.alias("texto"))


def empty_snippets(spark: SparkSession, sf: str) -> DataFrame:
    """Texts of all languages, some of them blank, ``nan`` or missing."""
    i = F.col("doc_id")
    text_of = F.when(i % 7 == 0, "  ").when(i % 7 == 1, "nan").when(i % 7 == 2, F.lit(None).cast("string")).otherwise(F.col("text"))
    return R.filter_empty_snippet(docs(spark, sf).select("doc_id", text_of.alias("snippet_full"))).select("doc_id")


def snippet_validity(spark: SparkSession, sf: str) -> DataFrame:
    t = F.when(F.col("lang") == "de", F.concat(F.col("text"), F.lit(" Bloquea este sitio"))).otherwise(F.col("text"))
    return docs(spark, sf).where(R.valid_snippet(t)).select("doc_id")


# -- dates written into texts -----------------------------------------------------

_MONTHS_ES = ["enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "set.", "octubre", "noviembre", "diciembre"]
_MONTHS_EN = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]


def snippets(spark: SparkSession, sf: str) -> DataFrame:
    """Order dates written in sixteen forms, some with leading zeros, large numbers or Unicode spaces."""
    d, n = F.col("o_orderdate"), (F.col("o_orderkey") % 400).cast("string")
    padded = F.when(F.col("o_orderkey") % 3 == 0, F.lpad(n, 9, "0")).otherwise(n)
    many = (F.col("o_orderkey") % 400 + F.when(F.col("o_orderkey") % 3 == 1, 1_000_000).otherwise(0)).cast("string")
    day, year = F.dayofmonth(d).cast("string"), F.year(d).cast("string")
    es = F.element_at(strings(*_MONTHS_ES), F.month(d))
    en = F.element_at(strings(*_MONTHS_EN), F.month(d))
    short = F.substring(es, 1, 3)
    forms = [
        F.concat(F.lit("  Hace "), padded, F.lit(" díasTexto")),
        F.concat(n, F.lit(" weeks ago. text")),
        F.lit("Ayer hubo lluvia"),
        F.lit("hoy, texto"),
        F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" texto")),
        F.concat(day, F.lit(" de "), F.regexp_replace(es, r"\.", ""), F.lit(" de "), year),
        F.concat(day, F.lit("\u202f"), F.upper(short), F.lit(".\u2009"), year, F.lit("Caracas.- Autoridades")),
        F.concat(day, F.lit(" "), es, F.lit(" de "), year),
        F.concat(F.substring(en, 1, 3), F.lit(" "), F.date_format(d, "dd"), F.lit(", "), year),
        F.concat(en, F.lit(". "), day, F.lit(" "), year, F.lit(" text")),
        F.concat(day, F.lit(" de "), es, F.lit(" "), year),
        F.concat(year, F.lit("-13-"), F.date_format(d, "dd")),
        F.concat(F.lit("31 feb "), year),
        F.concat(F.lit("sin fecha "), n),
        F.concat(F.lit("hace "), many, F.lit(" horas")),
        F.concat(F.lit("hace "), n, F.lit(" meses")),
    ]
    form = F.col("o_orderkey") % 16
    text_of_form = F.coalesce(*[F.when(form == i, f) for i, f in enumerate(forms)])
    return spread(table(spark, sf, "orders")).select("o_orderkey", text_of_form.alias("snippet_full"))


def snippet_dates(spark: SparkSession, sf: str) -> DataFrame:
    return dates.with_snippet_date(snippets(spark, sf), "snippet_full", "fecha", REF).select("o_orderkey", "fecha")


def leading_date(spark: SparkSession, sf: str) -> DataFrame:
    return R.filter_leading_date(snippets(spark, sf)).select("o_orderkey")


def relative_dates(spark: SparkSession, sf: str) -> DataFrame:
    n = (F.col("o_orderkey") % 400).cast("string")
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    forms = F.array(
        F.concat(F.lit("Hace "), n, F.lit(" dias")), F.concat(F.lit("publicado hace "), n, F.lit(" horas")),
        F.lit("hace un momento"), iso, F.concat(F.lit("hace "), n, F.lit(" días")), F.concat(iso, F.lit(" texto")),
    )
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.element_at(forms, (F.col("o_orderkey") % 6 + 1).cast("int")).alias("fecha")
    )
    return C.resolve_dates(rows, REF).select("o_orderkey", "fecha", day_text("fecha_dt"))


def shifted_years(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    moved = dates.shift_years(F.to_date("o_orderdate"), (F.col("o_orderkey") % 7).cast("int"))
    return o.select("o_orderkey", F.date_format(moved, "yyyy-MM-dd").alias("dia"))


# -- places -----------------------------------------------------------------------


def _places(spark: SparkSession, sf: str) -> DataFrame:
    name, kind = F.col("p_name"), F.col("p_type")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.array(
            F.concat(F.lit(" Estado "), F.upper(name)), F.concat(name, F.lit(" Vénezuela ")),
            F.concat(F.lit("#"), kind, F.lit(" #")), name, kind, F.lit("!!??"), F.concat(F.lit("EDO "), F.col("p_brand")),
            F.concat(F.lit("edo "), F.substring(name, 1, 3)),
        ).alias("lugares"),
        F.array(kind, F.col("p_brand")).alias("autoridades_actores"),
    )


def place_cleaning(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = C.clean_places(F.col("lugares"), ALIASES, BLACKLIST).alias("lugares_clean")
    return _places(spark, sf).select("p_partkey", cleaned).select("p_partkey", joined("lugares_clean"))


def _frequencies(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = C.clean_places(F.col("lugares"), ALIASES, BLACKLIST)
    return C.mention_frequencies(_places(spark, sf).withColumn("lugares_clean", cleaned), "lugares_clean")


def top_places(spark: SparkSession, sf: str) -> DataFrame:
    return C.top_places(_frequencies(spark, sf), ["promo", "standard"], 20)


def top_states(spark: SparkSession, sf: str) -> DataFrame:
    return C.top_states(_frequencies(spark, sf), ["promo", "standard", "small"], 16)


def top_actors(spark: SparkSession, sf: str) -> DataFrame:
    return C.top_actors(_places(spark, sf))


def total_mentions(spark: SparkSession, sf: str) -> DataFrame:
    return C.total_mentions(_places(spark, sf), "lugares")


def list_literals(spark: SparkSession, sf: str) -> DataFrame:
    name, key = F.col("p_name"), F.col("p_partkey")
    cell = (
        F.when(key % 5 == 0, F.concat(F.lit("['"), name, F.lit("', '"), F.col("p_brand"), F.lit("']")))
        .when(key % 5 == 1, F.concat(F.lit("[\"d'"), name, F.lit("\"]")))
        .when(key % 5 == 2, F.concat(F.lit("['"), name))
        .when(key % 5 == 3, "")
    )
    values = readers.parse_list_literal(cell)
    return table(spark, sf, "part").select("p_partkey", F.array_join(values, ";").alias("valores"), F.size(values).alias("n"))


# -- entities ------------------------------------------------------------------------


def match_entities(spark: SparkSession, sf: str) -> DataFrame:
    found = E.match_entities(clean(spark, sf), GAZETTEER, STATES, "texto")
    return found.select("doc_id", joined("lugares"), joined("autoridades_actores"))


def extract_entities(spark: SparkSession, sf: str) -> DataFrame:
    """The same through the hook for models, with a stand-in for the model."""

    def make_extractor():
        def extract(values: pd.Series) -> list[tuple[list[str], list[str]]]:
            return [([w for w in GAZETTEER if w in v], [w for w in STATES if w in v]) for v in values]

        return extract

    found = E.extract_entities(clean(spark, sf), make_extractor, "texto")
    return found.select("doc_id", joined("lugares"), joined("autoridades_actores"))


# -- the whole processing ---------------------------------------------------------------


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as raw hits: most snippets start with a date, some sites are excluded."""
    i = F.col("doc_id")
    site = F.when(i % 9 == 0, "https://www.netflix.com/").when(i % 9 == 1, "https://eltiempo.com/").otherwise(F.concat(F.lit("https://www."), F.col("source"), F.lit(".example.com/")))
    lead = (
        F.when(i % 5 == 0, "3 jul 2026").when(i % 5 == 1, F.concat(F.lit("hace "), (i % 90).cast("string"), F.lit(" días ")))
        .when(i % 5 == 2, "14 mayo. 2026 ").when(i % 5 == 3, "Hace 5 minutos ").otherwise("sin fecha ")
    )
    fecha = F.when(i % 5 == 0, "2026-07-03").when(i % 5 == 1, F.concat(F.lit("hace "), (i % 90).cast("string"), F.lit(" dias"))).when(i % 5 == 3, "hace poco")
    return docs(spark, sf).select(
        F.lit(0).alias("page_number"),
        (i % 20).cast("int").alias("rank"),
        F.concat_ws(" ", F.lit(" Título:"), "source", "lang").alias("title"),
        F.concat(site, F.col("source"), F.lit("/"), i.cast("string")).alias("url"),
        F.lit("d").alias("displayed_url"),
        fecha.alias("fecha"),
        F.lit("s").alias("snippet"),
        F.concat(lead, F.col("text")).alias("snippet_full"),
        F.lit("r").alias("rich_type"),
        F.concat(F.lit("consulta "), F.col("source")).alias("criterio_busqueda"),
    )


SETTINGS = NewsSettings(lexicon=LEXICON, gazetteer=GAZETTEER, states=STATES)


def _processed(df: DataFrame) -> DataFrame:
    return df.select(
        "url", "title", "title_clean", "texto_clasificacion", day_text("fecha_dt"), "red_social", "estado",
        *[joined(c) for c in LEXICON],
    )


def news_processed(spark: SparkSession, sf: str) -> DataFrame:
    return _processed(process_news(_raw(spark, sf), SETTINGS, REF, "2026-05-20", "2026-07-04"))


# The test lexicon's event words by type; one is left out on purpose.
TYPES = {"ering": "sismo", "tion": "lluvias", " tionth": "lluvias", "cion": "huracan", "schung": "huracan"}


JOB = NewsSettings(
    lexicon={**LEXICON, "rescate": [" ouier"]}, gazetteer=[*GAZETTEER, "tion", "ment"], states=STATES, window_hours=72, canonical=TYPES
)


def news_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """The news job from raw hits to alerts, through its stage tables."""
    _, alerts = run_news(_raw(spark, sf), JOB, REF, scratch_path(spark, "news"), "2026-06-20", "2026-07-04")
    return alerts.drop("fecha_calculo", "ventana_horas").withColumn("fecha_mas_reciente", day_text("fecha_mas_reciente"))


def write_parts(spark: SparkSession, sf: str) -> str:
    """Orders and customers written as CSV parts with different columns."""
    folder = scratch_path(spark, "parts")
    o = table(spark, sf, "orders").select(
        (F.col("o_orderkey") % 20).cast("int").alias("page_number"), F.lit(1).alias("rank"),
        F.concat(F.lit('Orden "'), "o_orderpriority", F.lit('",\nlínea ñ')).alias("title"),
        F.concat(F.lit("https://a.example.com/"), F.col("o_custkey").cast("string")).alias("url"),
        F.col("o_orderstatus").alias("rich_type"), F.col("o_orderkey").cast("string").alias("criterio_busqueda"),
    )
    c = table(spark, sf, "customer").select(
        F.concat(F.lit("https://b.example.com/"), (F.col("c_custkey") % 700).cast("string")).alias("url"),
        F.col("c_name").alias("title"),
    )
    for df, name in ((o, "a"), (c, "b")):
        df.write.option("header", True).option("escape", '"').csv(f"{folder}/{name}")
    return folder


def merged_parts(parts: DataFrame) -> DataFrame:
    """Parts merged to one row per URL."""
    return merge_raw(parts).groupBy(F.col("url").alias("url")).agg(
        F.count("*").alias("n"), F.count("page_number").alias("con_pagina"),
        F.max(F.regexp_extract("title", r"\n(.*)$", 1)).alias("cola"),
    )


def raw_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The parts read back and merged."""
    folder = write_parts(spark, sf)
    paths = [p for name in ("a", "b") for p in readers.find_parts(spark, f"{folder}/{name}", "*.csv")]
    return merged_parts(readers.read_raw_parts(spark, paths))


QUERIES = {
    f.__name__: f
    for f in (
        normalize_documents, unaccent_documents, choice_names, match_keywords, category_coverage,
        keyword_frequencies, gazetteer_filter, exclude_terms, extract_state_longest, classification_text,
        gazetteer_join, gazetteer_join_alike, strict_dates, news_tables, export_table,
        empty_snippets, snippet_validity, snippet_dates, leading_date, relative_dates, shifted_years,
        place_cleaning, top_places, top_states, top_actors, total_mentions, list_literals, match_entities,
        extract_entities, news_processed, news_alerts, raw_parts,
    )
}

_TAGS_SQL = ", ".join(f"array_to_string({_found(words)}, ';') AS \"{c}\"" for c, words in LEXICON.items())

_SNIPPETS_SQL = f"""
parts AS (
  SELECT o_orderkey, o_orderdate AS d, o_orderkey % 400 AS n, o_orderkey % 16 AS form, o_orderkey FROM orders
)
"""

_NAMES_SQL = r"""
raw_places AS (
  SELECT p_partkey, unnest([
    concat(' Estado ', upper(p_name)), concat(p_name, ' Vénezuela '), concat('#', p_type, ' #'), p_name, p_type, '!!??',
    concat('EDO ', p_brand), concat('edo ', substr(p_name, 1, 3))]) AS lugar,
    unnest([1, 2, 3, 4, 5, 6, 7, 8]) AS pos
  FROM part
),
s0 AS (SELECT p_partkey, pos, strip_accents(trim(lower(lugar))) AS x FROM raw_places),
s1 AS (SELECT p_partkey, pos, CASE x WHEN 'red ring' THEN 'red bolt' WHEN 'small ring' THEN 'ring'
         WHEN 'blue widget' THEN 'widgets' ELSE x END AS x FROM s0),
s2 AS (SELECT p_partkey, pos, CASE WHEN starts_with(x, 'estado ') THEN replace(x, 'estado ', '') ELSE x END AS x FROM s1),
s3 AS (SELECT p_partkey, pos, CASE WHEN starts_with(x, 'edo ') THEN replace(x, 'edo ', '') ELSE x END AS x FROM s2),
s4 AS (SELECT p_partkey, pos, CASE WHEN ends_with(x, ' venezuela') THEN replace(x, ' venezuela', '') ELSE x END AS x FROM s3),
s5 AS (SELECT p_partkey, pos, CASE WHEN starts_with(x, '#') THEN replace(x, '#', '') ELSE x END AS x FROM s4),
s6 AS (SELECT p_partkey, pos, CASE WHEN ends_with(x, ' #') THEN replace(x, ' #', '') ELSE x END AS x FROM s5),
places AS (
  SELECT p_partkey, pos, concat(upper(substr(trim(x), 1, 1)), lower(substr(trim(x), 2))) AS lugar FROM s6
  WHERE x NOT IN ('green gear', 'bolt', 'economy') AND length(x) > 3 AND NOT regexp_full_match(x, '[^\w\s]+')
),
freq AS (SELECT lugar, count(*) AS n FROM places GROUP BY lugar)
"""

_RAW_SQL = rf"""
raw AS (
  SELECT doc_id AS i, trim(concat(' Título: ', source, ' ', lang)) AS title,
    concat(CASE doc_id % 9 WHEN 0 THEN 'https://www.netflix.com/' WHEN 1 THEN 'https://eltiempo.com/' ELSE concat('https://www.', source, '.example.com/') END,
           source, '/', doc_id) AS url,
    trim(concat(CASE doc_id % 5 WHEN 0 THEN '3 jul 2026' WHEN 1 THEN concat('hace ', doc_id % 90, ' días ')
                WHEN 2 THEN '14 mayo. 2026 ' WHEN 3 THEN 'Hace 5 minutos ' ELSE 'sin fecha ' END, text), ' ' || chr(10) || chr(9) || chr(13)) AS snippet_full,
    CASE doc_id % 5 WHEN 0 THEN DATE '2026-07-03' WHEN 1 THEN DATE '2026-07-04' - CAST(doc_id % 90 AS INTEGER)
         WHEN 3 THEN DATE '2026-07-04' END AS fecha_dt
  FROM documents
),
cleaned AS (
  SELECT *, {CLEAN.format(c='title')} AS title_clean, {CLEAN.format(c='snippet_full')} AS snippet_clean FROM raw
  WHERE i % 5 <> 4 AND i % 9 NOT IN (0, 1) AND fecha_dt BETWEEN DATE '2026-05-20' AND DATE '2026-07-04'
),
processed AS (SELECT *, concat(title_clean, ' ', snippet_clean) AS texto FROM cleaned WHERE {_any(GAZETTEER, 'snippet_clean')})
"""

_ALERTS_SQL = f"""
alert_texts AS (
  SELECT url, fecha_dt, concat(title_clean, ' ', snippet_clean) AS texto FROM cleaned
  WHERE {_any([*GAZETTEER, 'tion', 'ment'], 'snippet_clean') }
),
facts AS (
  SELECT url, fecha_dt, {_longest(STATES)} AS estado, {_any(LEXICON['victimas'])} AS v, contains(texto, ' ouier') AS r,
         {_any(LEXICON['daños'])} AS d, regexp_extract(url, '^https://www.([^/]*)', 1) AS dominio,
         unnest(list_distinct(list_transform({_found(list(TYPES))}, lambda k: CASE WHEN k = 'ering' THEN 'sismo'
           WHEN k IN ('tion', ' tionth') THEN 'lluvias' ELSE 'huracan' END))) AS tipo_evento
  FROM alert_texts WHERE fecha_dt BETWEEN DATE '2026-07-02' AND DATE '2026-07-04'
)
"""

ORACLES = {
    "normalize_documents": f"WITH {CLEAN_SQL} SELECT doc_id, texto FROM clean",
    "unaccent_documents": r"""SELECT doc_id, regexp_replace(strip_accents(replace(text, 'ß', 'ss')), '[^\x00-\x7F]', '', 'g') AS texto
        FROM documents""",
    "choice_names": "SELECT doc_id, replace(trim(lower(strip_accents(text))), ' ', '_') AS nombre FROM documents",
    "match_keywords": f"WITH {CLEAN_SQL} SELECT doc_id, {_TAGS_SQL} FROM clean",
    "category_coverage": f"WITH {CLEAN_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c.capitalize()}' AS categoria, count(*) FILTER (WHERE {_any(words)}) AS n FROM clean"
        for c, words in LEXICON.items()
    ),
    "keyword_frequencies": f"""WITH {CLEAN_SQL},
        words AS (SELECT trim(unnest({_found(LEXICON['eventos'])})) AS w FROM clean),
        labels AS (SELECT CASE WHEN w IN ('tion', 'cion', 'ering') THEN 'sufijos' WHEN w = 'schung' THEN 'aleman' ELSE w END AS w FROM words)
        SELECT concat(upper(substr(w, 1, 1)), substr(w, 2)) AS etiqueta, count(*) AS n FROM labels GROUP BY 1""",
    "gazetteer_filter": f"WITH {CLEAN_SQL} SELECT doc_id FROM clean WHERE {_any(GAZETTEER)}",
    "gazetteer_join_alike": f"""WITH {CLEAN_SQL}, terms AS (SELECT DISTINCT lower('tion' || substr(p_name, 1, 2)) AS t FROM part)
        SELECT DISTINCT doc_id FROM clean JOIN terms ON contains(texto, t)""",
    "gazetteer_join": f"WITH {CLEAN_SQL} SELECT doc_id FROM clean WHERE {_any(GAZETTEER)}",
    "strict_dates": """SELECT o_orderkey, CASE WHEN o_orderkey % 4 IN (0, 3) THEN strftime(o_orderdate, '%Y-%m-%d') END AS dia FROM orders""",
    "news_tables": """SELECT concat('https://d.example.com/', doc_id) AS url,
        strftime(DATE '2026-01-01' + CAST(doc_id % 30 AS INTEGER), '%Y-%m-%d') AS fecha_dt, concat(lang, ';', source) AS eventos
        FROM documents WHERE doc_id % 10 <> 7""",
    "export_table": """SELECT p_partkey, p_name, concat('a "b", c; ', p_brand) AS marca FROM part""",
    "exclude_terms": f"WITH {CLEAN_SQL} SELECT doc_id FROM clean WHERE NOT {_any(FOREIGN)}",
    "extract_state_longest": f"WITH {CLEAN_SQL} SELECT doc_id, {_longest(STATES)} AS estado FROM clean",
    "classification_text": f"WITH {CLEAN_SQL} SELECT c.doc_id, trim(concat(d.source, ' ', c.texto)) AS texto FROM clean c JOIN documents d USING (doc_id)",
    "empty_snippets": "SELECT doc_id FROM documents WHERE doc_id % 7 > 2 AND trim(text) NOT IN ('', 'nan')",
    "snippet_validity": r"SELECT doc_id FROM documents WHERE lang <> 'de' AND length(trim(text, ' ' || chr(10) || chr(9) || chr(13))) > 20",
    "snippet_dates": f"""WITH {_SNIPPETS_SQL}
        SELECT o_orderkey, strftime(CASE
          WHEN form = 0 THEN DATE '2026-07-04' - CAST(n AS INTEGER)
          WHEN form = 1 THEN DATE '2026-07-04' - CAST(7 * n AS INTEGER)
          WHEN form = 2 THEN DATE '2026-07-03' WHEN form = 3 THEN DATE '2026-07-04'
          WHEN form IN (4, 5, 6, 8, 9) THEN CAST(d AS DATE)
          WHEN form = 7 THEN CAST(d AS DATE)
          WHEN form = 14 THEN CAST(TIMESTAMP '2026-07-04 10:30:00' - to_hours(CAST(n + CASE WHEN o_orderkey % 3 = 1 THEN 1000000 ELSE 0 END AS INTEGER)) AS DATE)
          WHEN form = 15 THEN DATE '2026-07-04' - CAST(30 * n AS INTEGER) END, '%Y-%m-%d') AS fecha FROM parts""",
    "leading_date": f"""WITH {_SNIPPETS_SQL} SELECT o_orderkey FROM parts
        WHERE form IN (0, 12, 14) OR (form = 6 AND month(d) <> 9)""",
    "relative_dates": """WITH r AS (
          SELECT o_orderkey, o_orderkey % 6 AS form, CAST(o_orderkey % 400 AS INTEGER) AS n, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM orders),
        f AS (SELECT o_orderkey, form, CASE form WHEN 0 THEN strftime(DATE '2026-07-04' - n, '%Y-%m-%d')
            WHEN 1 THEN strftime(TIMESTAMP '2026-07-04 10:30:00' - to_hours(n), '%Y-%m-%d')
            WHEN 3 THEN iso WHEN 5 THEN concat(iso, ' texto') ELSE '2026-07-04' END AS fecha FROM r)
        SELECT o_orderkey, fecha, CASE WHEN form <> 5 THEN fecha END AS fecha_dt FROM f""",
    "shifted_years": """SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) - to_years(CAST(o_orderkey % 7 AS INTEGER)), '%Y-%m-%d') AS dia
        FROM orders""",
    "place_cleaning": f"""WITH {_NAMES_SQL} SELECT p.p_partkey, coalesce(string_agg(l.lugar, ';' ORDER BY l.pos), '') AS lugares_clean
        FROM part p LEFT JOIN places l USING (p_partkey) GROUP BY p.p_partkey""",
    "top_places": f"""WITH {_NAMES_SQL} SELECT lugar, n FROM (SELECT * FROM freq ORDER BY n DESC, lugar LIMIT 20)
        WHERE lower(lugar) NOT IN ('promo', 'standard')""",
    "top_states": f"""WITH {_NAMES_SQL} SELECT lugar, n FROM (SELECT * FROM freq ORDER BY n DESC, lugar LIMIT 16)
        WHERE lower(lugar) IN ('promo', 'standard', 'small')""",
    "top_actors": """SELECT actor, count(*) AS n FROM (SELECT p_type AS actor FROM part UNION ALL SELECT p_brand FROM part)
        GROUP BY actor ORDER BY n DESC, actor LIMIT 15""",
    "total_mentions": "SELECT 8 * count(*) AS total FROM part",
    "list_literals": """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN concat(p_name, ';', p_brand) WHEN 1 THEN concat('d''', p_name) ELSE '' END AS valores,
        CASE p_partkey % 5 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS n FROM part""",
    "match_entities": f"""WITH {CLEAN_SQL} SELECT doc_id, array_to_string({_found(GAZETTEER)}, ';') AS lugares,
        array_to_string({_found(STATES)}, ';') AS autoridades_actores FROM clean""",
    "news_processed": f"""WITH {_RAW_SQL} SELECT url, title, title_clean, texto AS texto_clasificacion,
        strftime(fecha_dt, '%Y-%m-%d') AS fecha_dt, 'web' AS red_social, {_longest(STATES)} AS estado, {_TAGS_SQL} FROM processed""",
    "raw_parts": """SELECT concat('https://a.example.com/', o_custkey) AS url, CAST(1 AS BIGINT) AS n, CAST(1 AS BIGINT) AS con_pagina, 'línea ñ' AS cola FROM orders GROUP BY o_custkey
        UNION ALL SELECT DISTINCT concat('https://b.example.com/', c_custkey % 700), 1, 0, '' FROM customer""",
}
ORACLES["news_alerts"] = f"""WITH {_RAW_SQL}, {_ALERTS_SQL}
    SELECT estado, tipo_evento, count(*) AS n_noticias, count(DISTINCT dominio) AS n_fuentes_distintas, bool_or(v) AS tiene_victimas,
           bool_or(r) AS tiene_rescate_activo, bool_or(d) AS tiene_danios_estructurales, strftime(max(fecha_dt), '%Y-%m-%d') AS fecha_mas_reciente,
           CASE WHEN bool_or(v) AND count(DISTINCT dominio) FILTER (WHERE v) >= 2 THEN 'Rojo' WHEN bool_or(r) OR bool_or(d) THEN 'Naranja'
                WHEN count(*) >= 2 THEN 'Amarillo' ELSE 'Verde' END AS nivel_alerta,
           string_agg(DISTINCT url, ' | ' ORDER BY url) AS urls_relacionadas
    FROM facts WHERE estado IS NOT NULL GROUP BY estado, tipo_evento"""
ORACLES["extract_entities"] = ORACLES["match_entities"]
