"""Dimension tables and the fixed vocabularies of the alert rules.

Lexicons, gazetteers, aliases and region lists are inputs: a table or a JSON
file supplied by the caller.  Only the values the rules themselves depend on
are written here.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regionpulse.functions.text import capitalize, choice_name, normalize_term, normalize_text
from regionpulse.sources.schemas import (
    ALIAS_DIM,
    CANONICAL_DIM,
    CHOICES,
    GAZETTEER_DIM,
    LEXICON_DIM,
    QUAKE_THRESHOLDS,
    STATES_DIM,
)

# Event keyword -> canonical event type.
CANONICAL_EVENTS = {
    "sismo": "sismo", "terremoto": "sismo", " tembl": "sismo", "replica": "sismo",
    "escala de richter": "sismo", "derrumb": "sismo",
    " inund": "lluvias", " aneg": "lluvias", "desbord": "lluvias", "crecida": "lluvias",
    "deslave": "lluvias", "deslizamiento": "lluvias", " alud": "lluvias", "aguacero": "lluvias",
    "tormenta": "lluvias", "precipitaciones": "lluvias", "vaguada": "lluvias", "lluvi": "lluvias",
    "onda tropical": "lluvias", "chuvasco": "lluvias", "llovizna": "lluvias",
    " sequia": "sequia", "racionamiento": "sequia", "escasez de agua": "sequia",
    "estres hidrico": "sequia", "deshidrata": "sequia", "desiert": "sequia", "desertic": "sequia",
    "embalses bajos": "sequia", "nivel del embalse": "sequia", "nivel de los embalses": "sequia",
    "huracan": "huracan", "ciclon": "huracan", "marejada": "huracan",
}

# Canonical event types each situation lets through.
SITUATION_EVENTS = {
    "lluvias": ["lluvias"], "sismo": ["sismo"], "sequia": ["sequia"], "huracan": ["huracan"],
}

# Levels and yes/no choices of the output contracts.
ALERT_LEVELS = ["rojo", "naranja", "amarillo", "verde"]
YES_NO = {"si": "Sí", "no": "No"}

# Lists compiled into expressions live in the plan, so their size is bounded.
MAX_PLAN_TERMS = 200_000


def plan_values(df: DataFrame, *columns: str, limit: int = MAX_PLAN_TERMS) -> list:
    """Rows of a small dimension as Python values, refusing anything above ``limit``.

    A longer gazetteer stays a table: ``filters.filter_gazetteer_table`` joins it.
    """
    rows = df.select(*columns).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"dimension has more than {limit} rows and cannot be part of a plan")
    return [row[0] for row in rows] if len(columns) == 1 else [tuple(row) for row in rows]


def states_dim(spark: SparkSession, states: Mapping[str, Mapping]) -> DataFrame:
    """``{estado: {capital, lat, lon}}`` -> one row per state; ``ord`` keeps the given order."""
    rows = [
        (name, info["capital"], float(info["lat"]), float(info["lon"]), i)
        for i, (name, info) in enumerate(states.items())
    ]
    return spark.createDataFrame(rows, STATES_DIM)


def thresholds_dim(spark: SparkSession, thresholds: Mapping[str, Mapping]) -> DataFrame:
    """``{estado: {umbral_*}}`` with a ``_default`` entry -> threshold rows."""
    names = QUAKE_THRESHOLDS.fieldNames()[1:]
    rows = [(state, *(float(values[n]) for n in names)) for state, values in thresholds.items()]
    return spark.createDataFrame(rows, QUAKE_THRESHOLDS)


def lexicon_dim(spark: SparkSession, lexicon: Mapping[str, Sequence[str]]) -> DataFrame:
    """``{category: [keyword, ...]}`` -> ``(category, keyword, ord)``."""
    rows = [(c, k, i) for c, keywords in lexicon.items() for i, k in enumerate(keywords)]
    return spark.createDataFrame(rows, LEXICON_DIM)


def load_lexicon(dim: DataFrame, normalize: bool = True) -> dict[str, list[str]]:
    """Lexicon rows as ordered keyword lists.

    ``normalize`` brings terms to the form they have in cleaned text, so an
    accented keyword can match.
    """
    lexicon: dict[str, list[str]] = {}
    for category, keyword, _ in sorted(plan_values(dim, "category", "keyword", "ord"), key=lambda r: (r[0], r[2])):
        lexicon.setdefault(category, []).append(normalize_term(keyword) if normalize else keyword)
    return lexicon


def load_mapping(dim: DataFrame, key: str, value: str) -> dict[str, str]:
    """Two columns of a dimension as a dict."""
    return dict(plan_values(dim, key, value))


def gazetteer_dim(terms: DataFrame, normalize: bool = True) -> DataFrame:
    """``(term, kind)`` rows of a gazetteer of any size, once each, in the form terms have in cleaned text."""
    term = normalize_text(F.col("term")) if normalize else F.col("term")
    return terms.select(term.alias("term"), "kind").where("term <> ''").distinct().to(GAZETTEER_DIM)


def load_aliases(aliases: DataFrame, blacklist: DataFrame | None = None) -> tuple[dict[str, str], list[str]]:
    """Place aliases ``(raw, clean)`` and excluded terms, as the settings of the place cleaning."""
    return dict(plan_values(aliases.to(ALIAS_DIM), "raw", "clean")), plan_values(blacklist, "term") if blacklist else []


def canonical_dim(spark: SparkSession, mapping: Mapping[str, str] = CANONICAL_EVENTS) -> DataFrame:
    return spark.createDataFrame(list(mapping.items()), CANONICAL_DIM)


def event_types(mapping: Mapping[str, str] = CANONICAL_EVENTS) -> list[str]:
    """Distinct canonical types in alphabetical order."""
    return sorted(set(mapping.values()))


def distinct_event_types(dim: DataFrame) -> DataFrame:
    """Distinct canonical types of a map table in alphabetical order."""
    return dim.select("tipo_evento").distinct().orderBy("tipo_evento")


def unmapped_keywords(lexicon: DataFrame, canonical: DataFrame, category: str = "eventos") -> DataFrame:
    """Event keywords that no canonical type covers, so they can never raise an alert."""
    return lexicon.where(F.col("category") == category).join(canonical, "keyword", "left_anti")


def choices_dim(
    states: DataFrame, event_types: DataFrame, levels: Sequence[str] = ALERT_LEVELS
) -> DataFrame:
    """``(list_name, name, label)`` for states, event types, levels and yes/no."""

    def rows(df: DataFrame, list_name: str, value: str, name: Column) -> DataFrame:
        return df.select(
            F.lit(list_name).alias("list_name"), name.alias("name"), capitalize(F.col(value)).alias("label")
        )

    fixed = [("niveles_alerta", v, v.capitalize()) for v in levels]
    fixed += [("si_no", name, label) for name, label in YES_NO.items()]
    return (
        rows(states, "estados", "estado", choice_name(F.col("estado")))
        .unionByName(rows(event_types, "tipos_evento", "tipo_evento", F.col("tipo_evento")))
        .unionByName(states.sparkSession.createDataFrame(fixed, CHOICES))
    )


def is_small(df: DataFrame, rows: int) -> bool:
    """Whether a table has at most ``rows`` rows; reads no more than that."""
    return df.limit(rows + 1).count() <= rows
