"""News job: raw parts -> accumulated -> processed -> alerts and selection -> publication."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regionpulse.functions.urls import social_network
from regionpulse.operators.alerts import alert_metrics, sort_alerts
from regionpulse.operators.classify import (
    Situation,
    category_coverage,
    clean_texts,
    keyword_frequencies,
    mention_frequencies,
    resolve_dates,
    tag_text,
    top_actors,
    top_places,
    top_states,
    total_mentions,
)
from regionpulse.operators.contracts import prepare_metrics, prepare_news
from regionpulse.operators.dedupe import (
    accumulate,
    dedupe_key,
    drop_redundant,
    increment,
    merge_parts,
    union_by_name,
)
from regionpulse.operators.filters import (
    EXCLUDED_DOMAINS,
    exclude_terms,
    filter_date_window,
    filter_empty_snippet,
    filter_excluded_domains,
    filter_gazetteer,
    filter_leading_date,
)
from regionpulse.operators.quality import Counters, news_counters
from regionpulse.operators.selection import not_in_ledger, select_news, with_alert_key
from regionpulse.session import stage
from regionpulse.sources import ledgers, readers, sinks
from regionpulse.sources.dimensions import CANONICAL_EVENTS
from regionpulse.sources.schemas import IMPACT_CATEGORIES, ZONE_CATEGORIES


Deliver = Callable[[pd.DataFrame], list[tuple[int, str]]]


@dataclass
class NewsSettings:
    """Vocabularies and parameters of the news job."""

    lexicon: Mapping[str, Sequence[str]]
    gazetteer: Sequence[str]
    states: Sequence[str]
    situation: Situation = None
    window_hours: int = 48
    per_situation: int = 10
    excluded_domains: Sequence[str] = field(default_factory=lambda: list(EXCLUDED_DOMAINS))
    foreign_terms: Sequence[str] = ()
    canonical: Mapping[str, str] = field(default_factory=lambda: dict(CANONICAL_EVENTS))


def collect_raw(
    spark: SparkSession,
    paths: Sequence[str],
    accumulated: DataFrame | None = None,
    accumulated_is_unique: bool = False,
) -> DataFrame:
    """CSV parts -> one row per key, merged after the rows of earlier runs; see :func:`merge_raw`."""
    return merge_raw(readers.read_raw_parts(spark, paths), accumulated, accumulated_is_unique)


def merge_raw(parts: DataFrame, accumulated: DataFrame | None = None, accumulated_is_unique: bool = False) -> DataFrame:
    """Rows of parts -> one row per key, merged after the rows of earlier runs.

    ``parts`` come with their order, from :func:`readers.read_raw_parts` or :func:`split_files.read_split_parts`.
    ``accumulated_is_unique`` promises that the earlier rows are a result of
    this function.  Then only their keys are shuffled, to find what is new, and
    the earlier rows themselves pass through.
    """
    merged = merge_parts(parts, [readers.SOURCE_ORDER])
    if accumulated is None:
        result = merged
    elif accumulated_is_unique:
        result = union_by_name(accumulated, increment(accumulated, merged, dedupe_key(merged)))
    else:
        result = accumulate(accumulated, merged, [readers.SOURCE_ORDER])
    return result.drop(readers.SOURCE_ORDER)


def process_news(
    raw: DataFrame,
    settings: NewsSettings,
    now: datetime,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Cleaned, filtered and tagged news.

    The filters are independent of each other and run from cheap to costly,
    before the tagging: domain, date window, empty snippet, leading date, then
    the place names in the cleaned text.
    """
    df = filter_excluded_domains(raw, settings.excluded_domains)
    df = filter_date_window(resolve_dates(df, now), start, end)
    df = filter_leading_date(filter_empty_snippet(df))
    df = filter_gazetteer(clean_texts(df), settings.gazetteer)
    if settings.foreign_terms:
        df = exclude_terms(df, settings.foreign_terms)
    df = df.withColumn("red_social", social_network(F.col("url")))
    return drop_redundant(tag_text(df, settings.lexicon, settings.states))


def publish_news(
    processed: DataFrame,
    alerts: DataFrame,
    settings: NewsSettings,
    url_ledger: str,
    alert_ledger: str,
    batch_id: str,
    deliver_news: Deliver,
    deliver_alerts: Deliver,
    work: str,
    counters: Counters | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Send new alerts and the selected news, and record what was accepted.

    ``counters`` gathers the news that can be sent (``candidatas``) and those that the ledger does not hold (``nuevas``).

    Rows to send are written first; outcomes and ledger entries then refer to
    that written outbox, so a failed row is never marked as sent.
    """
    spark = processed.sparkSession
    sent_alerts = ledgers.read_alert_ledger(spark, alert_ledger)
    fresh = stage(not_in_ledger(with_alert_key(alerts), sent_alerts, "clave"), f"{work}/outbox_alertas")
    sent_urls = ledgers.read_sent_ledger(spark, url_ledger)
    chosen = stage(
        select_news(
            processed, alerts, sent_urls, settings.situation, settings.per_situation, mapping=settings.canonical,
            watch=counters.watch if counters else None,
        ),
        f"{work}/outbox_noticias",
    )

    def send(rows: DataFrame, payload: DataFrame, key: str, deliver: Deliver, ledger: str, name: str) -> DataFrame:
        outcomes = sinks.publish(payload, key, deliver, f"{work}/{name}")
        accepted = sinks.sent_rows(rows, key, outcomes).where(F.col(key).isNotNull())
        ledgers.record_batch(accepted, key, ledger, batch_id)
        return outcomes

    return (
        send(chosen, prepare_news(chosen, "url"), "url", deliver_news, url_ledger, "envio_noticias"),
        send(fresh, prepare_metrics(fresh, "clave"), "clave", deliver_alerts, alert_ledger, "envio_alertas"),
    )


def run_news(
    raw: DataFrame,
    settings: NewsSettings,
    now: datetime,
    out: str,
    start: str | None = None,
    end: str | None = None,
    counters: Counters | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Processed news and sorted alerts, both written under ``out``.

    The processed table feeds the alerts and the selection; it is written once
    and read back, so later steps scan only the columns they need.  ``counters``
    gathers the rows that come in (``crudas``) and the quality of what is written
    (``procesadas``) in the run that writes them.
    """
    rows = process_news(counters.watch(raw, "crudas") if counters else raw, settings, now, start, end)
    if counters:
        rows = counters.watch(rows, "procesadas", news_counters())
    processed = stage(rows, f"{out}/procesadas")
    alerts = sort_alerts(
        alert_metrics(processed, settings.window_hours, now, settings.situation, mapping=settings.canonical, urls=True)
    )
    return processed, stage(alerts, f"{out}/alertas")


def news_summaries(
    processed: DataFrame, frequency_groups: Mapping[str, Mapping[str, Sequence[str]]] | None = None
) -> dict[str, DataFrame]:
    """Exploratory counts: zones, impact, care places and event types.

    ``frequency_groups`` maps a keyword column to its labels and their keywords.
    """
    groups = frequency_groups or {}
    return {
        "zonas_afectadas": category_coverage(processed, ZONE_CATEGORIES),
        "nivel_afectacion": category_coverage(processed, IMPACT_CATEGORIES),
        "centros_atencion": keyword_frequencies(processed, "atencion", groups.get("atencion")),
        "tipos_eventos": keyword_frequencies(processed, "eventos", groups.get("eventos")),
    }


def place_summaries(
    processed: DataFrame, states: Sequence[str], places: int = 100, actors: int = 15
) -> dict[str, DataFrame]:
    """Totals and most frequent places, states and actors of news with entities."""
    frequencies = mention_frequencies(processed, "lugares_clean")
    return {
        "total_lugares": total_mentions(processed, "lugares_clean"),
        "top_estados": top_states(frequencies, states),
        "top_destinos": top_places(frequencies, states, places),
        "total_actores": total_mentions(processed, "autoridades_actores"),
        "top_actores": top_actors(processed, n=actors),
    }
