"""Search queries built from media, situations, sites and days."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keyword clause of each situation, and the exclusions.
SITUATION_CLAUSES = {
    "lluvias": (
        "(lluvia OR crecida OR inundacion OR deslizamiento OR desbord OR aguacero OR "
        "precipitacion OR vaguada OR tormenta)"
    ),
    "sismo": '(sismo OR terremoto OR temblor OR temblando OR replica OR "escala de richter")',
    "sequia": (
        '(sequia OR "escasez de agua" OR "racionamiento de agua" OR "nivel de embalse" OR '
        '"nivel del embalse" OR "cosechas perdidas" OR "incendios forestales")'
    ),
    "huracan": (
        '(huracan OR "tormenta tropical" OR ciclon OR "onda tropical" OR '
        'huracanados OR "fuertes vientos")'
    ),
}
EXCLUSIONS = " -filetype:pdf -filetype:doc -filetype:xls -scribd"
COUNTRY = "venezuela"
DAILY_COUNTRY_WORDS = "venezuela vzla venzolan"


def merge_clauses(situations: str | Sequence[str], clauses: Mapping[str, str] = SITUATION_CLAUSES) -> str:
    """Clauses of several situations as one; an unknown situation is an error."""
    names = [situations] if isinstance(situations, str) else list(situations)
    unknown = [n for n in names if n not in clauses]
    if unknown:
        raise ValueError(f"unknown situation {unknown}; valid: {sorted(clauses)}")
    return "(" + " OR ".join(clauses[n].strip().removeprefix("(").removesuffix(")") for n in names) + ")"


def query_grid(
    media: DataFrame,
    clause: str,
    exclusions: str = EXCLUSIONS,
    sites: Sequence[str] | None = None,
    dates: tuple[str, str] | None = None,
    country: str = COUNTRY,
) -> DataFrame:
    """``(ord, medio, criterio_busqueda)``: one query per medium, or per medium and site.

    ``media`` has ``medio`` and its position ``ord``.  The clause, the sites
    and the date range are settings, so each medium expands in place; ``ord``
    of a query follows from the position of its medium and site.
    """
    suffix = f" after:{dates[0]} before:{dates[1]}" if dates else ""
    base = F.concat(F.lit(f'{country} "'), F.col("medio"), F.lit(f'" {clause}{exclusions}'))
    if sites is None:
        return media.select(F.col("ord").cast("long").alias("ord"), "medio", F.concat(base, F.lit(suffix)).alias("criterio_busqueda"))
    options = F.posexplode(F.array(*map(F.lit, sites)))
    return media.select("medio", "ord", options.alias("_i", "_site")).select(
        (F.col("ord") * len(sites) + F.col("_i")).cast("long").alias("ord"),
        "medio",
        F.concat(base, F.lit(" site:"), F.col("_site"), F.lit(suffix)).alias("criterio_busqueda"),
    )


def query_days(states: DataFrame, sites: Sequence[str], start: date, end: date) -> DataFrame:
    """``(sitio, estado, fecha, criterio_busqueda)``: one query per site, state and day."""
    days = F.explode(F.sequence(F.lit(start), F.lit(end)))
    per_site = states.select("estado", F.explode(F.array(*map(F.lit, sites))).alias("sitio"))
    day = F.date_format("fecha", "yyyy-MM-dd")
    following = F.date_format(F.date_add("fecha", 1), "yyyy-MM-dd")
    return per_site.select("sitio", "estado", days.alias("fecha")).withColumn(
        "criterio_busqueda",
        F.concat(
            F.lit("site:"), F.col("sitio"), F.lit(f" {DAILY_COUNTRY_WORDS} "), F.col("estado"),
            F.lit(" after:"), day, F.lit(" before:"), following,
        ),
    )


def assign_workers(queries: DataFrame, workers: int) -> DataFrame:
    """``worker``: round robin over the position ``ord`` of each query."""
    return queries.withColumn("worker", F.pmod("ord", F.lit(workers)).cast("int"))


def tag_hits(hits: DataFrame, query: str) -> DataFrame:
    """Hits with the query that produced them."""
    return hits.withColumn("criterio_busqueda", F.lit(query))
