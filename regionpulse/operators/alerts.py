"""Alert metrics per state and event type."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionpulse.functions.levels import news_level, severity
from regionpulse.functions.urls import domain
from regionpulse.operators.classify import Situation, canonical_events, filter_situation, tag_state
from regionpulse.operators.filters import filter_alert_window
from regionpulse.operators.ordering import numbered, running
from regionpulse.sources.dimensions import CANONICAL_EVENTS

GROUP = ["estado", "tipo_evento"]
URL_SEPARATOR = " | "

# Size of one part of a group's URL list.
PART_BYTES = 1024 * 1024


def _has_items(c: str) -> Column:
    return F.coalesce(F.size(c) > 0, F.lit(False))


def explode_events(
    df: DataFrame,
    situation: Situation = None,
    states: Sequence[str] | None = None,
    mapping: Mapping[str, str] = CANONICAL_EVENTS,
) -> DataFrame:
    """One row per report and canonical event type; rows without state or event go.

    The state is read from the text when ``states`` is given, else taken from
    the column.
    """
    if states is not None:
        df = tag_state(df, states)
    events = filter_situation(canonical_events(F.col("eventos"), mapping), situation)
    exploded = df.where(F.col("estado").isNotNull()).select(
        "estado",
        F.explode_outer(events).alias("tipo_evento"),
        "url",
        "fecha_dt",
        _has_items("victimas").alias("victimas"),
        _has_items("rescate").alias("rescate"),
        _has_items("daños").alias("danios"),
    )
    return exploded.where(F.col("tipo_evento").isNotNull())


# Columns every combining step carries.
_COMBINED = ["n", "victimas", "rescate", "danios", "fecha_dt"]


def _combine(df: DataFrame, keys: list[str], *extra: Column) -> DataFrame:
    """Counts and flags per key; combines rows or already combined rows."""
    count = F.sum("n") if "n" in df.columns else F.count("*")
    return df.groupBy(*keys).agg(
        count.alias("n"),
        *[F.bool_or(c).alias(c) for c in ("victimas", "rescate", "danios")],
        F.max("fecha_dt").alias("fecha_dt"),
        *extra,
    )


def alert_urls(
    df: DataFrame,
    hours: int,
    now: datetime,
    situation: Situation = None,
    states: Sequence[str] | None = None,
    mapping: Mapping[str, str] = CANONICAL_EVENTS,
) -> DataFrame:
    """``(estado, tipo_evento, url)``: every distinct URL behind each alert, one row each."""
    events = explode_events(filter_alert_window(df, now, hours), situation, states, mapping)
    return events.where(F.col("url").isNotNull()).select(*GROUP, "url").distinct()


def _count_groups(rows: DataFrame) -> DataFrame:
    """Reports, or reports combined per URL, -> per source -> per group."""
    per_source = _combine(
        rows.withColumn("dominio", domain(F.col("url"))),
        [*GROUP, "dominio"],
        F.sum(F.octet_length("url") + len(URL_SEPARATOR)).alias("bytes"),
    )
    return _combine(
        per_source,
        GROUP,
        F.count("dominio").alias("fuentes"),
        F.count_if(F.col("dominio").isNotNull() & F.col("victimas")).alias("fuentes_victimas"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
    )


def _list_urls(per_url: DataFrame, groups: DataFrame, part_bytes: int | None) -> DataFrame:
    """Groups with their URLs as text in numbered parts, sorted inside each part; no URL is left out.

    Without ``part_bytes`` a group is one part, whatever its size.

    A checksum deals a group's URLs out to as many parts as its size asks for, so no task gets a whole large group.
    The per-URL rows feed the counts and the lists.  The listed rows keep every
    column, so both branches read one shuffle and the reports are scanned once.
    """
    row = F.struct("url", *[F.col(c).alias(f"_{c}") for c in _COMBINED])
    parts = F.lit(1) if part_bytes is None else F.greatest(F.ceil(F.col("bytes") / part_bytes), F.lit(1))
    number = F.conv(F.substring(F.md5("_fila.url"), 1, 8), 16, 10).cast("long")
    return (
        per_url.select(*GROUP, row.alias("_fila"))
        .join(groups, GROUP)
        .withColumn("parte", F.coalesce(F.pmod(number, parts), F.lit(0)))
        .groupBy(*groups.columns, "parte")
        .agg(F.collect_list(F.when(F.col("_fila.url").isNotNull(), F.col("_fila"))).alias("_filas"))
        .withColumn("urls", F.array_join(F.array_sort("_filas")["url"], URL_SEPARATOR))
    )


def alert_url_parts(
    df: DataFrame,
    hours: int,
    now: datetime,
    situation: Situation = None,
    states: Sequence[str] | None = None,
    mapping: Mapping[str, str] = CANONICAL_EVENTS,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``(estado, tipo_evento, parte, urls)``: the URLs of each alert as text, in parts of about ``part_bytes``."""
    events = explode_events(filter_alert_window(df, now, hours), situation, states, mapping)
    per_url = _combine(events, [*GROUP, "url"])
    return _list_urls(per_url, _count_groups(per_url), part_bytes).select(*GROUP, "parte", "urls")


def alert_url_ordered(
    df: DataFrame,
    hours: int,
    now: datetime,
    situation: Situation = None,
    states: Sequence[str] | None = None,
    mapping: Mapping[str, str] = CANONICAL_EVENTS,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """``(estado, tipo_evento, parte, urls)``: the whole sorted text of each alert's URLs, cut into parts in order.

    The parts of a group, joined by the separator in the order of ``parte``, are its text.  A part begins with the
    first URL whose place in the text is in the next stretch of ``part_bytes``; numbers of parts may have gaps behind
    a longer URL.  Places are sums over a sort in ranges, so a group of any size is many tasks.
    """
    found = alert_urls(df, hours, now, situation, states, mapping)
    sized = found.withColumn("_bytes", F.octet_length("url") + len(URL_SEPARATOR))
    placed = running(sized, GROUP, ["url"], "_bytes", "_inicio")
    return (
        placed.groupBy(*GROUP, F.floor(F.col("_inicio") / part_bytes).alias("parte"))
        .agg(F.array_join(F.array_sort(F.collect_list("url")), URL_SEPARATOR).alias("urls"))
    )


def alert_metrics(
    df: DataFrame,
    hours: int,
    now: datetime,
    situation: Situation = None,
    states: Sequence[str] | None = None,
    mapping: Mapping[str, str] = CANONICAL_EVENTS,
    urls: bool = False,
    part_bytes: int | None = None,
) -> DataFrame:
    """Counts, sources, flags, latest date and level per state and event type.

    Reports are combined per URL, then per source, then per group.  Each step
    combines inside the tasks first, so one group or source with most of the
    reports does not pile up in one task, and distinct sources need no set.

    There is one row per group, with null in ``urls_relacionadas``, and no step per URL.  ``urls`` asks for the text
    that is published: all URLs of the group, sorted; a text beyond Spark's limit of 2 GB a value fails, and
    :func:`alert_url_ordered` has the same text in parts.  A caller that names ``part_bytes`` gets a row for each part
    of the URLs instead (:func:`alert_url_parts` numbers these), which repeats the counts.
    """
    events = explode_events(filter_alert_window(df, now, hours), situation, states, mapping)
    if urls or part_bytes is not None:
        per_url = _combine(events, [*GROUP, "url"])
        groups = _list_urls(per_url, _count_groups(per_url), part_bytes)
    else:
        groups = _count_groups(events).withColumn("urls", F.lit(None).cast("string"))
    return groups.select(
        *GROUP,
        F.lit(hours).cast("int").alias("ventana_horas"),
        F.lit(now.isoformat(sep=" ")).cast("timestamp").alias("fecha_calculo"),
        F.col("n").cast("long").alias("n_noticias"),
        F.col("fuentes").alias("n_fuentes_distintas"),
        F.col("victimas").alias("tiene_victimas"),
        F.col("rescate").alias("tiene_rescate_activo"),
        F.col("danios").alias("tiene_danios_estructurales"),
        F.col("fecha_dt").alias("fecha_mas_reciente"),
        news_level(
            F.col("victimas"), F.col("fuentes_victimas"), F.col("rescate"), F.col("danios"), F.col("n")
        ).alias("nivel_alerta"),
        F.col("urls").alias("urls_relacionadas"),
    )


def _alert_order() -> list[str | Column]:
    return [severity(F.col("nivel_alerta")), F.desc("n_noticias"), *GROUP]


def sort_alerts(df: DataFrame) -> DataFrame:
    """Most severe first, then most reports, then group."""
    return df.orderBy(*_alert_order())


def rank_alerts(df: DataFrame, rank: str = "orden") -> DataFrame:
    """The place of each alert in the order of :func:`sort_alerts`, from 0."""
    return numbered(df, _alert_order(), rank)
