"""Which alerts and news are new, and which news to publish."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionpulse.functions.levels import UNKNOWN_WHEN_MATCHING, severity
from regionpulse.operators.classify import Situation, canonical_events, filter_situation, situation_list, tag_state
from regionpulse.operators.dedupe import first_per_group
from regionpulse.operators.filters import located_with_events
from regionpulse.sources.dimensions import CANONICAL_EVENTS, event_types


def alert_key(state: Column, event: Column, calculated: Column, level: Column) -> Column:
    """``estado|tipo|yyyy-MM-dd|nivel``: one alert level of one group on one day."""
    return F.concat_ws("|", state, event, F.date_format(calculated, "yyyy-MM-dd"), level)


def with_alert_key(alerts: DataFrame) -> DataFrame:
    """Alerts with their ledger key in ``clave``."""
    return alerts.withColumn(
        "clave",
        alert_key(F.col("estado"), F.col("tipo_evento"), F.col("fecha_calculo"), F.col("nivel_alerta")),
    )


def not_in_ledger(df: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Rows whose key the ledger does not hold; rows without a key are kept.

    A ledger only grows, so it is never forced into a broadcast: adaptive
    execution picks one when it is small and splits skewed keys otherwise.
    Rows without a key match nothing; they get scattered stand-in keys, so that
    many of them do not meet in one task.
    """
    others = [f.name for f in df.schema if f.name != key and not isinstance(f.dataType, T.MapType)]
    scattered = F.concat(F.lit("\u0000"), F.xxhash64(F.lit(0), *others).cast("string"))
    sent = ledger.select(F.col(key).alias("_sent"))
    return df.join(sent, F.coalesce(F.col(key), scattered) == F.col("_sent"), "left_anti")


def enrich_with_alert(
    news: DataFrame,
    alerts: DataFrame,
    states: Sequence[str] | None = None,
    mapping: Mapping[str, str] = CANONICAL_EVENTS,
) -> DataFrame:
    """News with a state and an event, plus the most severe alert level among its events.

    Ties go to the first event in alphabetical order; news outside every alert
    gets its first event and ``Verde``.  The alerts become one row per state
    with a level column per event type, so each article meets one row and is
    neither multiplied nor regrouped.  Its size is known when it is made, and
    adaptive execution broadcasts it if it is small.
    """
    types = event_types(mapping)
    if states is not None:
        given = news.withColumnRenamed("estado", "_dado")
        news = tag_state(given, states).withColumn("estado", F.coalesce("_dado", "estado")).drop("_dado")
    news = located_with_events(
        news.withColumn("tipos_evento_canonico", canonical_events(F.col("eventos"), mapping))
    )
    level = F.col("nivel_alerta")
    by_state = alerts.groupBy(F.col("estado").alias("_estado")).agg(
        *[
            F.min_by(
                F.when(F.col("tipo_evento") == t, level),
                F.when(F.col("tipo_evento") == t, severity(level, UNKNOWN_WHEN_MATCHING)),
            ).alias(f"_nivel_{t}")
            for t in types
        ]
    )
    joined = news.join(by_state, F.col("estado") == F.col("_estado"), "left")
    candidates = [
        F.when(
            F.array_contains("tipos_evento_canonico", t) & F.col(f"_nivel_{t}").isNotNull(),
            F.struct(
                severity(F.col(f"_nivel_{t}"), UNKNOWN_WHEN_MATCHING).alias("sev"),
                F.lit(i).alias("pos"),
                F.lit(t).alias("tipo"),
                F.col(f"_nivel_{t}").alias("nivel"),
            ),
        )
        for i, t in enumerate(types)
    ]
    best = F.least(*candidates) if len(candidates) > 1 else candidates[0]
    return (
        joined.withColumn("_best", best)
        .withColumns(
            {
                "tipo_evento": F.coalesce("_best.tipo", F.get("tipos_evento_canonico", F.lit(0))),
                "nivel_alerta_asociado": F.coalesce("_best.nivel", F.lit("Verde")),
            }
        )
        .drop("_best", "_estado", *[f"_nivel_{t}" for t in types])
    )


def explode_situations(
    news: DataFrame, situation: Situation, events: str = "tipos_evento_canonico"
) -> DataFrame:
    """One row per article and active situation it belongs to, with the situation's position."""
    options = []
    for i, name in enumerate(situation_list(situation)):
        label = F.struct(F.lit(i).alias("pos"), F.lit(name).cast("string").alias("nombre"))
        belongs = F.lit(True) if name is None else F.size(filter_situation(F.col(events), name)) > 0
        options.append(F.when(belongs, F.array(label)).otherwise(F.array().cast("array<struct<pos:int,nombre:string>>")))
    return (
        news.withColumn("_sit", F.explode(F.concat(*options)))
        .withColumns({"situacion_pos": F.col("_sit.pos"), "situacion": F.col("_sit.nombre")})
        .drop("_sit")
    )


def select_top(news: DataFrame, k: int, group: Sequence[str] = ("situacion_pos",)) -> DataFrame:
    """At most ``k`` news per situation: most severe first, then latest, undated last.

    Ties end with the URL, the title and the query, so the choice does not
    depend on the layout of the input.  ``orden`` is the position inside the
    situation.
    """
    ties = [c for c in ("url", "title", "criterio_busqueda") if c in news.columns]
    order = [severity(F.col("nivel_alerta_asociado")), F.desc_nulls_last("fecha_dt"), *ties]
    return first_per_group(news, list(group), order, k=k, rank="orden")


def merge_selections(selected: DataFrame) -> DataFrame:
    """Selections of all situations, one row per URL, earlier situations winning."""
    return first_per_group(selected, ["url"], ["situacion_pos", "orden"])


def select_news(
    news: DataFrame,
    alerts: DataFrame,
    sent: DataFrame,
    situation: Situation,
    k: int = 10,
    states: Sequence[str] | None = None,
    mapping: Mapping[str, str] = CANONICAL_EVENTS,
    watch: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """News to publish: new, enriched, the top of each situation, each URL once.

    ``watch`` is shown the rows before and after the ledger, as ``candidatas`` and ``nuevas``.
    """
    watch = watch or (lambda df, step: df)
    fresh = not_in_ledger(watch(enrich_with_alert(news, alerts, states, mapping), "candidatas"), sent, "url")
    fresh = watch(fresh, "nuevas")
    return merge_selections(select_top(explode_situations(fresh, situation), k))
