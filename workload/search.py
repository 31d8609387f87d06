"""URLs, links of stored pages and search query grids."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionpulse.functions import urls
from regionpulse.operators import filters as R
from regionpulse.operators import links as L
from regionpulse.operators import searchgrid as G
from regionpulse.session import spread
from regionpulse.sources import dimensions
from workload.standins import choices, states, table

PATTERNS = [r"example\.org", r"spam-farm\.", r"utm_source=feed"]


def domains(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", urls.domain(F.col("url")).alias("dominio"))


def domain_counts(spark: SparkSession, sf: str) -> DataFrame:
    return domains(spark, sf).groupBy("dominio").agg(F.count("*").alias("n"))


def domain_excluded(spark: SparkSession, sf: str) -> DataFrame:
    return R.filter_excluded_domains(table(spark, sf, "pages"), PATTERNS).select("page_id")


def domain_excluded_host(spark: SparkSession, sf: str) -> DataFrame:
    return R.filter_excluded_domains(table(spark, sf, "pages"), [r"example\.org", r"feed"], match="host").select("page_id")


def _social_urls(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("page_id") % 8
    prefix = (
        F.when(i == 0, "https://www.FaceBook.com/").when(i == 1, "https://netflix.com/").when(i == 2, "https://m.YouTube.com/x.com/")
        .when(i == 3, "https://threads.net/").when(i == 4, "https://instagram.com/tiktok/").otherwise("")
    )
    return table(spark, sf, "pages").select("page_id", F.when(i != 7, F.concat(prefix, "url")).alias("url"))


def social_network(spark: SparkSession, sf: str) -> DataFrame:
    return _social_urls(spark, sf).select("page_id", urls.social_network(F.col("url")).alias("red_social"))


def excluded_fixed_domains(spark: SparkSession, sf: str) -> DataFrame:
    return R.filter_excluded_domains(_social_urls(spark, sf)).select("page_id")


def redirect_targets(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("page_id") % 3
    link = F.when(i == 0, F.concat(F.lit("https://g.example/url?q="), "url", F.lit("&sa=U"))).when(i == 1, F.col("url"))
    return table(spark, sf, "pages").select("page_id", urls.clean_redirect(link).alias("destino"))


def valid_hits(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").where(R.valid_hit(F.col("url"))).select("page_id")


def page_links(spark: SparkSession, sf: str) -> DataFrame:
    return L.extract_links(spread(table(spark, sf, "pages"))).withColumn("rank", F.col("rank").cast("long"))


def page_results(spark: SparkSession, sf: str) -> DataFrame:
    """Documents laid out as result blocks of three kinds with nested elements, two per page, read back as hits."""
    d = spread(table(spark, sf, "documents"))
    body = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", "&", "&amp;"), "<", "&lt;"), ">", "&gt;")
    kind = F.col("doc_id") % 3
    opening = F.when(kind == 0, '<article data-testid="result">').when(kind == 1, '<ul><li data-layout="organic">').otherwise('<div class="x" data-testid="result">')
    closing = F.when(kind == 0, "</article>").when(kind == 1, "</li></ul>").otherwise("</div>")
    block = F.concat(
        opening, F.lit('<div><h2><a href="https://a.example.com/'), F.col("source"), F.lit("/"),
        F.col("doc_id").cast("string"), F.lit('?a=1&amp;b=2"> <b>Nota</b> &ntilde;&#233;&#xF3; '), F.col("lang"),
        F.lit('</a></h2><div data-result="snippet">corto</div></div><div data-result="snippet"><div>3 jul 2026</div> <div>'), body,
        F.lit("</div></div>"), closing,
    )
    pages = d.select(
        "doc_id", F.concat(F.lit("https://search.example/"), F.col("doc_id").cast("string")).alias("url"),
        F.concat(F.lit("<html><body>"), block, block, F.lit('<article data-testid="result"><p>sin enlace</p></article></body></html>')).alias("html"),
    )
    found = L.extract_results(pages, datetime(2026, 7, 4))
    return found.select("doc_id", "rank", "title", "url", "fecha", F.length("snippet_full").cast("long").alias("largo"))


def page_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Hits of whole pages: these have no result blocks, so their plain links count."""
    found = L.page_hits(spread(table(spark, sf, "pages")), datetime(2026, 7, 4))
    return found.select("page_id", "pagina", F.col("rank").cast("long").alias("rank"), "title", "url")


def _media(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_name").alias("medio"), F.col("c_custkey").alias("ord"))


CLAUSE = ["sismo", "huracan"]


def query_grid(spark: SparkSession, sf: str) -> DataFrame:
    return G.query_grid(_media(spark, sf), G.merge_clauses(CLAUSE), dates=("2026-07-01", "2026-07-04"))


def query_grid_sites(spark: SparkSession, sf: str) -> DataFrame:
    return G.query_grid(_media(spark, sf), G.merge_clauses("sequia"), sites=["ve", "com.ve"])


def query_days(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(F.col("c_name").alias("estado"))
    grid = G.query_days(c, ["instagram.com", "tiktok.com"], date(2024, 2, 28), date(2024, 3, 1))
    return grid.withColumn("fecha", F.date_format("fecha", "yyyy-MM-dd"))


def query_round_robin(spark: SparkSession, sf: str) -> DataFrame:
    grid = G.query_grid(_media(spark, sf), G.merge_clauses("sequia"), sites=["ve", "com.ve"])
    return G.assign_workers(grid, 4).select("ord", "worker")


def choice_list(spark: SparkSession, sf: str) -> DataFrame:
    return choices(spark, sf)


def state_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return states(spark, sf)


def unmapped_keywords(spark: SparkSession, sf: str) -> DataFrame:
    """Event types of the events table that the canonical map does not know."""
    lexicon = table(spark, sf, "events").select(
        F.lit("eventos").alias("category"),
        F.when(F.col("event_type") == "view", "sismo").otherwise(F.col("event_type")).alias("keyword"),
    ).distinct()
    return dimensions.unmapped_keywords(lexicon, dimensions.canonical_dim(spark)).select("category", "keyword")


QUERIES = {
    f.__name__: f
    for f in (
        domains, domain_counts, domain_excluded, domain_excluded_host, social_network, excluded_fixed_domains,
        redirect_targets, valid_hits, page_links, page_results, page_hits, query_grid, query_grid_sites, query_days,
        query_round_robin, choice_list, state_dimension, unmapped_keywords,
    )
}

_DOMAIN = r"regexp_replace(regexp_extract(lower(url), '^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)', 1), '^www\.', '')"

_SOCIAL = """
social AS (
  SELECT page_id, CASE WHEN page_id % 8 <> 7 THEN concat(CASE page_id % 8 WHEN 0 THEN 'https://www.FaceBook.com/'
    WHEN 1 THEN 'https://netflix.com/' WHEN 2 THEN 'https://m.YouTube.com/x.com/' WHEN 3 THEN 'https://threads.net/'
    WHEN 4 THEN 'https://instagram.com/tiktok/' ELSE '' END, url) END AS url FROM pages
)
"""

_SISMO_HURACAN = (
    '(sismo OR terremoto OR temblor OR temblando OR replica OR "escala de richter" OR huracan OR "tormenta tropical" OR '
    'ciclon OR "onda tropical" OR huracanados OR "fuertes vientos")'
)
_SEQUIA = (
    '(sequia OR "escasez de agua" OR "racionamiento de agua" OR "nivel de embalse" OR "nivel del embalse" OR '
    '"cosechas perdidas" OR "incendios forestales")'
)
_EXCLUDED = " -filetype:pdf -filetype:doc -filetype:xls -scribd"

ORACLES = {
    "domains": f"SELECT page_id, {_DOMAIN} AS dominio FROM pages",
    "domain_counts": f"SELECT {_DOMAIN} AS dominio, count(*) AS n FROM pages GROUP BY 1",
    "domain_excluded": """SELECT page_id FROM pages WHERE url NOT ILIKE '%example.org%' AND url NOT ILIKE '%spam-farm.%'
        AND url NOT ILIKE '%utm_source=feed%'""",
    "domain_excluded_host": f"SELECT page_id FROM pages WHERE NOT ({_DOMAIN} = 'example.org' OR {_DOMAIN} LIKE '%.example.org')",
    "social_network": f"""WITH {_SOCIAL} SELECT page_id,
        lower(coalesce(nullif(regexp_extract(url, '(facebook|instagram|x.com|tiktok|threads|youtube)', 1, 'i'), ''), 'web')) AS red_social
        FROM social""",
    "excluded_fixed_domains": "SELECT page_id FROM pages WHERE page_id % 8 IN (3, 5, 6, 7)",
    "redirect_targets": r"""SELECT page_id, CASE page_id % 3 WHEN 0 THEN split_part(url, '&', 1) WHEN 1 THEN
        CASE WHEN contains(url, 'url?q=') THEN regexp_extract(url, 'url\?q=([^&]+)', 1) ELSE url END END AS destino FROM pages""",
    "valid_hits": """SELECT page_id FROM pages WHERE url <> '' AND NOT contains(url, '#') AND NOT contains(url, 'javascript:')
        AND NOT contains(url, 'duckduckgo.com') AND NOT contains(url, '/settings') AND NOT contains(url, '/maps')""",
    "page_links": r"""
        WITH anchors AS (
          SELECT page_id, url AS pagina, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 1)) AS href,
                 unnest(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 2)) AS title,
                 unnest(range(len(regexp_extract_all(html, '(?is)<a\s[^>]*?href\s*=\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 1)))) AS i
          FROM pages),
        decoded AS (
          SELECT page_id, pagina, i,
            CASE WHEN starts_with(href, '/') THEN concat(regexp_extract(pagina, '^([A-Za-z]+://[^/?#]*)', 1), replace(href, '&amp;', '&'))
                 ELSE replace(href, '&amp;', '&') END AS url,
            trim(regexp_replace(replace(regexp_replace(title, '<[^>]*>', '', 'g'), '&amp;', '&'), '\s+', ' ', 'g')) AS title
          FROM anchors),
        valid AS (
          SELECT *, row_number() OVER (PARTITION BY page_id, url ORDER BY i) AS seen FROM decoded
          WHERE length(title) > 10 AND contains(url, 'http') AND NOT contains(url, '#') AND NOT contains(url, 'javascript:')
            AND NOT contains(url, 'duckduckgo.com'))
        SELECT page_id, pagina, row_number() OVER (PARTITION BY page_id ORDER BY i) AS rank, title, url FROM valid WHERE seen = 1""",
    "page_results": r"""SELECT doc_id, 1 AS rank, concat('Nota ñéó ', lang) AS title,
        concat('https://a.example.com/', source, '/', doc_id, '?a=1&b=2') AS url,
        CASE WHEN length(shown) > 20 THEN '2026-07-03' END AS fecha, CASE WHEN length(shown) > 20 THEN length(shown) ELSE 0 END AS largo
        FROM (SELECT *, trim(regexp_replace(concat('3 jul 2026 ', text), '\s+', ' ', 'g')) AS shown FROM documents)""",
    "query_grid": f"""SELECT c_custkey AS ord, c_name AS medio,
        concat('venezuela "', c_name, '" {_SISMO_HURACAN}{_EXCLUDED} after:2026-07-01 before:2026-07-04') AS criterio_busqueda FROM customer""",
    "query_grid_sites": f"""SELECT row_number() OVER (ORDER BY c_custkey, i) - 1 AS ord, c_name AS medio,
        concat('venezuela "', c_name, '" {_SEQUIA}{_EXCLUDED} site:', site) AS criterio_busqueda
        FROM customer CROSS JOIN (VALUES (0, 've'), (1, 'com.ve')) s(i, site)""",
    "query_days": """SELECT sitio, c_name AS estado, strftime(dia, '%Y-%m-%d') AS fecha,
        concat('site:', sitio, ' venezuela vzla venzolan ', c_name, ' after:', strftime(dia, '%Y-%m-%d'), ' before:',
               strftime(dia + INTERVAL 1 DAY, '%Y-%m-%d')) AS criterio_busqueda
        FROM customer CROSS JOIN (VALUES ('instagram.com'), ('tiktok.com')) s(sitio)
        CROSS JOIN (VALUES (DATE '2024-02-28'), (DATE '2024-02-29'), (DATE '2024-03-01')) d(dia)""",
    "query_round_robin": """SELECT ord, CAST(ord % 4 AS INTEGER) AS worker FROM (
        SELECT row_number() OVER (ORDER BY c_custkey, i) - 1 AS ord FROM customer CROSS JOIN (VALUES (0), (1)) s(i))""",
    "choice_list": """SELECT 'estados' AS list_name, lower(n_name) AS name, concat('N', lower(substr(n_name, 2))) AS label FROM nation
        UNION ALL SELECT 'tipos_evento', t, concat(upper(substr(t, 1, 1)), substr(t, 2)) FROM (VALUES ('sismo'), ('lluvias'), ('sequia'), ('huracan')) x(t)
        UNION ALL SELECT 'niveles_alerta', t, concat(upper(substr(t, 1, 1)), substr(t, 2)) FROM (VALUES ('rojo'), ('naranja'), ('amarillo'), ('verde')) y(t)
        UNION ALL SELECT 'si_no', 'si', 'Sí' UNION ALL SELECT 'si_no', 'no', 'No'""",
    "state_dimension": """SELECT n_name AS estado, concat('Capital ', n_nationkey) AS capital,
        (n_nationkey * 7) % 25 * 0.45::DOUBLE + 1.5::DOUBLE AS lat, (n_nationkey * 11) % 25 * 0.55::DOUBLE - 73.0::DOUBLE AS lon,
        n_nationkey AS ord FROM nation""",
    "unmapped_keywords": """SELECT DISTINCT 'eventos' AS category, event_type AS keyword FROM events WHERE event_type <> 'view'""",
}
ORACLES["page_hits"] = ORACLES["page_links"]
