"""Cleaning and tagging of news, and the summaries over the tags."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionpulse.functions.dates import resolve_relative_date, strict_date
from regionpulse.functions.text import (
    capitalize,
    classification_text,
    empty_strings,
    keyword_hits,
    keywords_from_hits,
    longest_from_hits,
    normalize_text,
    strip,
    unaccent,
)
from regionpulse.sources.dimensions import CANONICAL_EVENTS, SITUATION_EVENTS

Situation = str | Sequence[str] | None


def clean_texts(df: DataFrame) -> DataFrame:
    """Trim title and snippet and add their cleaned forms and the text to classify."""
    df = df.withColumns({c: strip(F.col(c)) for c in ("title", "snippet_full")})
    # A generator of one row stands between cleaning and what reads it: a filter on a cleaned text is not moved
    # below it, and the text is not cleaned again for every use.
    cleaned = F.struct(
        F.coalesce(normalize_text(F.col("title")), F.lit("")).alias("title"),
        normalize_text(F.col("snippet_full")).alias("snippet_full"),
    )
    df = df.drop("title_clean", "snippet_full_clean").withColumn("_limpio", F.explode(F.array(cleaned)))
    df = df.withColumns({"title_clean": F.col("_limpio.title"), "snippet_full_clean": F.col("_limpio.snippet_full")}).drop("_limpio")
    return df.withColumn(
        "texto_clasificacion", classification_text(F.col("title_clean"), F.col("snippet_full_clean"))
    )


def resolve_dates(df: DataFrame, now: datetime) -> DataFrame:
    """Relative dates to days, then ``fecha_dt`` as a real date (null if unreadable)."""
    df = df.withColumn("fecha", resolve_relative_date(F.col("fecha"), now))
    return df.withColumn("fecha_dt", strict_date(F.col("fecha")))


def tag_text(
    df: DataFrame,
    lexicon: Mapping[str, Sequence[str]],
    states: Sequence[str] = (),
    text: str = "texto_clasificacion",
) -> DataFrame:
    """One ``array<string>`` column per category with its keywords, and ``estado`` if states are given.

    The text, expected in lower case, is searched once for all terms together;
    the hits are a column of their own that the categories and the state are
    read from.
    """
    vocabulary = [k for keywords in lexicon.values() for k in keywords] + list(states)
    if not vocabulary:
        return df.withColumns({c: empty_strings() for c in lexicon})
    hits = F.col("_hits")
    found = {c: keywords_from_hits(hits, keywords) for c, keywords in lexicon.items()}
    if states:
        found["estado"] = longest_from_hits(hits, states)
    return (
        df.withColumn("_hits", keyword_hits(F.col(text), vocabulary)).withColumns(found).drop("_hits")
    )


def tag_categories(
    df: DataFrame, lexicon: Mapping[str, Sequence[str]], text: str = "texto_clasificacion"
) -> DataFrame:
    """One ``array<string>`` column per category with the keywords found."""
    return tag_text(df, lexicon, text=text)


def tag_state(df: DataFrame, states: Sequence[str], text: str = "texto_clasificacion") -> DataFrame:
    """``estado``: the longest state name in the text, or null."""
    lowered = "_low"
    return tag_text(df.withColumn(lowered, F.lower(text)), {}, states, lowered).drop(lowered)


def canonical_events(c: Column, mapping: Mapping[str, str] = CANONICAL_EVENTS) -> Column:
    """Distinct canonical types of an event keyword array, sorted; unmapped ones dropped."""
    keywords: dict[str, list[str]] = {}
    for keyword, kind in mapping.items():
        keywords.setdefault(kind, []).append(keyword)
    found = [
        F.when(F.arrays_overlap(c, F.array(*map(F.lit, keywords[kind]))), F.array(F.lit(kind))).otherwise(
            empty_strings()
        )
        for kind in sorted(keywords)
    ]
    return F.concat(*found)


def situation_list(situation: Situation) -> list[str | None]:
    """A situation as a list; none stands for 'all'."""
    if situation is None:
        return [None]
    return [situation] if isinstance(situation, str) else list(situation)


def allowed_events(situation: Situation, groups: Mapping[str, Sequence[str]] = SITUATION_EVENTS) -> list[str]:
    """Event types the active situations let through; an unknown situation adds none."""
    return sorted({e for s in situation_list(situation) if s is not None for e in groups.get(s, ())})


def filter_situation(
    c: Column, situation: Situation, groups: Mapping[str, Sequence[str]] = SITUATION_EVENTS
) -> Column:
    """Canonical events that belong to the situation, order kept."""
    if not situation:
        return c
    allowed = allowed_events(situation, groups)
    return F.array_intersect(c, F.array(*map(F.lit, allowed)) if allowed else empty_strings())


def has_situation(df: DataFrame, situation: str | None, events: str = "tipos_evento_canonico") -> DataFrame:
    """Rows with at least one event of the situation; none keeps every row."""
    if situation is None:
        return df
    return df.where(F.size(filter_situation(F.col(events), situation)) > 0)


def keyword_frequencies(
    df: DataFrame, column: str, groups: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """``(etiqueta, n)`` of a keyword column, most frequent first.

    With ``groups`` (label -> exact keywords) the keywords count under their
    label.
    """
    word = F.lower(F.trim(F.col("_word")))
    label = word
    if groups:
        pairs = {k: name for name, keywords in groups.items() for k in keywords}
        table = F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])
        label = F.coalesce(F.try_element_at(table, word), word)
    return (
        df.select(F.explode_outer(column).alias("_word"))
        .groupBy(label.alias("_label"))
        .agg(F.count("*").alias("n"))
        .where(F.col("_label") != "")
        .select(capitalize(F.col("_label")).alias("etiqueta"), "n")
        .orderBy(F.desc("n"), "etiqueta")
    )


def category_coverage(df: DataFrame, categories: Sequence[str]) -> DataFrame:
    """``(categoria, n)``: rows that have a keyword of each category, most first."""
    counts = df.agg(*[F.count_if(F.size(F.col(c)) > 0).alias(c) for c in categories])
    return (
        counts.unpivot([], list(categories), "categoria", "n")
        .select(capitalize(F.col("categoria")).alias("categoria"), "n")
        .orderBy(F.desc("n"), "categoria")
    )


# Tokens removed from a place name that starts (True) or ends with them, in order.
PLACE_REMOVALS = [
    ("estado ", True), ("edo ", True), (" venezuela", False), (" vzla", False), ("#", True), (" #", False),
]


def clean_places(c: Column, aliases: Mapping[str, str], blacklist: Sequence[str]) -> Column:
    """Place names of an array in a common form, noise removed.

    Order matters: alias first, then state prefixes, country suffixes and hash
    signs, then the blacklist and the length check on the untrimmed name.
    """
    alias_map = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair]) if aliases else None

    def removal(token: str, at_start: bool) -> Callable[[Column], Column]:
        def apply(name: Column) -> Column:
            fires = name.startswith(token) if at_start else name.endswith(token)
            return F.when(fires, F.replace(name, F.lit(token), F.lit(""))).otherwise(name)

        return apply

    def canonical(place: Column) -> Column:
        name = unaccent(F.trim(F.lower(place)))
        return F.coalesce(F.try_element_at(alias_map, name), name) if alias_map is not None else name

    names = F.transform(c, canonical)
    for token, at_start in PLACE_REMOVALS:
        names = F.transform(names, removal(token, at_start))
    banned = F.array(*map(F.lit, blacklist)) if blacklist else empty_strings()
    kept = F.filter(
        names,
        lambda n: ~F.array_contains(banned, n) & (F.length(n) > 3) & ~n.rlike(r"(?U)^[^\w\s]+$"),
    )
    return F.coalesce(F.transform(kept, lambda n: capitalize(F.trim(n))), empty_strings())


def mention_frequencies(df: DataFrame, column: str) -> DataFrame:
    """``(lugar, n)`` of an array column, most frequent first."""
    return (
        df.select(F.explode_outer(column).alias("lugar"))
        .groupBy("lugar")
        .agg(F.count("*").alias("n"))
        .where(F.col("lugar").isNotNull())
        .orderBy(F.desc("n"), "lugar")
    )


def total_mentions(df: DataFrame, column: str) -> DataFrame:
    """One row with the number of mentions in an array column."""
    return df.agg(F.coalesce(F.sum(F.size(column)), F.lit(0)).cast("long").alias("total"))


def top_places(frequencies: DataFrame, states: Sequence[str], n: int = 100) -> DataFrame:
    """Places among the ``n`` most frequent that are not states."""
    return frequencies.limit(n).where(~F.lower("lugar").isin(*states))


def top_states(frequencies: DataFrame, states: Sequence[str], n: int = 16) -> DataFrame:
    """States among the ``n`` most frequent places; the capital city also counts for its district."""
    head = frequencies.limit(n)
    low = F.lower("lugar")
    named = F.array_compact(
        F.array(
            F.when(low == "caracas", F.lit("Distrito capital")), F.when(low.isin(*states), F.col("lugar"))
        )
    )
    return head.select(F.explode_outer(named).alias("lugar"), "n").where(F.col("lugar").isNotNull()).orderBy(F.desc("n"), "lugar")


def top_actors(df: DataFrame, column: str = "autoridades_actores", n: int = 15) -> DataFrame:
    """Most mentioned actors."""
    return mention_frequencies(df, column).withColumnRenamed("lugar", "actor").limit(n)
