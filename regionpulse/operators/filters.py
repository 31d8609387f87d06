"""Row filters for news and search hits."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from datetime import date, datetime, timedelta

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regionpulse.functions.text import contains_any, strip, unaccent
from regionpulse.functions.urls import LINK_NOISE, TITLE_LINK_NOISE, contains_none, domain
from regionpulse.session import stage, text_batches

# Fixed value: dates a kept snippet may start with, after transliteration.
LEADING_DATE = (
    r"(?i)^\s*(?:"
    r"\d{1,2}\s+(?:ene|feb|mar|abr|may|jun|jul|ago|sep|oct|nov|dic)[a-z]*\.?\s+\d{4}|"
    r"hace\s+\d+\s+(?:dia|hora|minuto)s?|"
    r"hace\s+un\s+(?:momento|instante))"
)

# Domains excluded from the news.
EXCLUDED_DOMAINS = [
    r"npr\.org", r"surfer\.com", r"weawow\.com", r"tiktok\.com", r"youtube\.com",
    r"instagram\.com", r"facebook\.com", r"x\.com", r"tiempo\.com", r"eltiempoen\.com",
    r"meteoblue\.com", r"meteored\.com", r"es\.weather-forecast\.com", r"weather-atlas\.com",
    r"microsoft\.com", r"chiletrabajos\.",
]

# Interface phrases that are never a snippet.
INTERFACE_PHRASES = [
    "Incluir solo resultados", "Rehacer la búsqueda", "Bloquea este sitio", "Compartir comentarios",
]


def filter_leading_date(df: DataFrame, column: str = "snippet_full") -> DataFrame:
    """Rows whose text starts with a recognised date; null text is dropped."""
    return df.where(unaccent(F.col(column)).rlike(LEADING_DATE))


def is_excluded_domain(
    url: Column, patterns: Sequence[str] = EXCLUDED_DOMAINS, match: str = "substring"
) -> Column:
    """Whether a URL is on an excluded domain; null URLs are not.

    ``substring`` finds the pattern anywhere in the URL; ``host`` only as the
    end of the host name.
    """
    joined = "|".join(patterns)
    if match == "substring":
        found = url.rlike(f"(?i)(?:{joined})")
    elif match == "host":
        host = F.regexp_replace(domain(url), r":\d+$", "")
        found = host.rlike(rf"(?:^|\.)(?:{joined})(?:$|(?<=\.))")
    else:
        raise ValueError(f"unknown match mode {match!r}")
    return F.coalesce(found, F.lit(False))


def filter_excluded_domains(
    df: DataFrame, patterns: Sequence[str] = EXCLUDED_DOMAINS, match: str = "substring", column: str = "url"
) -> DataFrame:
    """Rows whose URL is on none of the excluded domains."""
    return df.where(~is_excluded_domain(F.col(column), patterns, match))


def filter_empty_snippet(df: DataFrame, column: str = "snippet_full") -> DataFrame:
    """Rows with a snippet left after trimming."""
    text = strip(F.col(column))
    return df.where(text.isNotNull() & ~text.isin("", "nan"))


def _day_bound(df: DataFrame, column: str, day: date) -> Column:
    kind = "date" if isinstance(df.schema[column].dataType, T.DateType) else "timestamp_ntz"
    return F.lit(day.isoformat()).cast(kind)


def filter_date_window(
    df: DataFrame, start: str | None = None, end: str | None = None, column: str = "fecha_dt"
) -> DataFrame:
    """Rows dated inside ``[start, end]``, whole days; undated rows go once a bound is set."""
    if start is None and end is None:
        return df
    keep = F.col(column).isNotNull()
    if start is not None:
        keep = keep & (F.col(column) >= _day_bound(df, column, date.fromisoformat(start)))
    if end is not None:
        after = date.fromisoformat(end) + timedelta(days=1)
        keep = keep & (F.col(column) < _day_bound(df, column, after))
    return df.where(keep)


def filter_alert_window(
    df: DataFrame, now: datetime, hours: int, column: str = "fecha_dt"
) -> DataFrame:
    """Rows dated in the last ``hours`` before ``now``, both ends included.

    Dates count as midnight.  The bounds are literals of the column's own type
    so that the scan can use them.
    """
    start = now - timedelta(hours=hours)
    if isinstance(df.schema[column].dataType, T.DateType):
        first = start.date() if start == datetime.combine(start.date(), datetime.min.time()) else start.date() + timedelta(days=1)
        low, high = (F.lit(d.isoformat()).cast("date") for d in (first, now.date()))
    else:
        low, high = (F.lit(t.isoformat(sep=" ")).cast(df.schema[column].dataType) for t in (start, now))
    return df.where(F.col(column).between(low, high))


def held(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``value`` as a column that is computed once a row, also where filters and lambdas read it.

    A filter repeats the expression behind a column in every place that reads it, so a text that is cleaned in the
    same plan would be cleaned many times; a generator of one row stands between.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def filter_gazetteer(df: DataFrame, terms: Sequence[str], column: str = "snippet_full_clean") -> DataFrame:
    """Rows whose text contains a place term, as a substring and ignoring case."""
    return held(df, "_texto", F.col(column)).where(contains_any(F.col("_texto"), terms)).drop("_texto")


# Bytes of the piece of a term that texts and terms are joined by.
ANCHOR_BYTES = 6
# Bits of the table that tells tasks which pieces no term has: so many a piece, as a power of two between these.
BITS_PER_PIECE, FEWEST_BITS, MOST_BITS = 32, 16, 26


def _pieces(text: bytes, lengths: Sequence[int]) -> np.ndarray:
    """The pieces of a text of some lengths in bytes, as numbers: the length before the bytes."""
    data = np.frombuffer(text, np.uint8).astype(np.int64)
    piece, found = data, []
    for n in range(1, min(max(lengths), len(data)) + 1):
        if n > 1:
            piece = (piece[:-1] << 8) | data[n - 1 :]
        if n in lengths:
            found.append(piece | (n << 8 * ANCHOR_BYTES))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _slots(pieces: np.ndarray, bits: int) -> np.ndarray:
    return (pieces.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per piece of each term; a term that is shorter than a piece is one itself."""
    for batch in batches:
        terms = batch.column(0).to_pylist()
        pieces = [np.unique(_pieces(t, [min(len(t), ANCHOR_BYTES)])) for t in (term.encode() for term in terms)]
        rows = np.repeat(np.arange(len(terms)), [len(p) for p in pieces])
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(np.concatenate(pieces or [np.zeros(0, np.int64)]))], ["_term", "_pieza"])


def _words_of_bits(bits: int):
    """A function that gives the bits of pieces: the word of 64 bits, and the bit in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = _slots(batch.column(0).to_numpy(), bits)
            yield pa.RecordBatch.from_arrays([pa.array((slots >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (slots & np.uint64(63))).view(np.int64))], ["palabra", "bit"])

    return run


def _pieces_of_texts(lengths: Sequence[int], bits: int, table: Broadcast):
    """A function that gives the different pieces of texts whose bit is set, with the key of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.frombuffer(table.value, np.uint64)
        for batch in batches:
            found = []
            for text in batch.column(1):
                pieces = _pieces(text.as_buffer().to_pybytes(), lengths)
                slots = _slots(pieces, bits)
                found.append(np.unique(pieces[(words[slots >> np.uint64(6)] >> (slots & np.uint64(63))) & np.uint64(1) == 1]))
            rows = np.repeat(np.arange(len(found)), [len(p) for p in found])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(np.concatenate(found or [np.zeros(0, np.int64)]))], ["_clave", "_pieza"])

    return run


def filter_gazetteer_table(
    df: DataFrame, terms: DataFrame, column: str = "snippet_full_clean", term: str = "term"
) -> DataFrame:
    """:func:`filter_gazetteer` for a table of terms of any size.

    Texts are cut into pieces, of which those that some term has are kept and counted.  A text meets a term by the
    term's rarest piece, so terms that begin alike, or have common pieces, do not multiply the texts; the whole term
    is then looked for.  The terms are never part of the plan and never on the driver.  A table of bits, of 8 MB at
    most, spares tasks the rows of nearly all pieces that no term has; which ones are some term's is settled by a join.
    """
    spark = df.sparkSession
    listed = stage(terms.select(F.lower(F.col(term)).alias("_term")).where("_term <> ''").distinct())
    lengths = sorted(r[0] for r in listed.select(F.least(F.octet_length("_term"), F.lit(ANCHOR_BYTES))).distinct().collect())
    if not lengths:
        return df.where(F.lit(False))
    # The text is cleaned once; all else reads what is written here.
    rows = held(df.select(F.struct("*").alias("_fila")), "_texto", F.lower(F.col("_fila")[column]))
    rows = stage(rows.select("_fila", F.md5("_texto").alias("_clave"), "_texto"))
    texts = rows.where("_clave IS NOT NULL").select("_clave", "_texto")
    with text_batches(spark):
        anchors = stage(listed.mapInArrow(_anchors, "_term string, _pieza long"))
        pieces = stage(anchors.select("_pieza").distinct())
        bits = min(max((BITS_PER_PIECE * pieces.count()).bit_length(), FEWEST_BITS), MOST_BITS)
        words = np.zeros(1 << bits - 6, np.int64)
        marked = pieces.mapInArrow(_words_of_bits(bits), "palabra long, bit long").groupBy("palabra").agg(F.bit_or("bit").alias("bits")).toPandas()
        words[marked["palabra"].to_numpy(np.int64)] = marked["bits"].to_numpy(np.int64)
        table = spark.sparkContext.broadcast(words.tobytes())
        likely = texts.select("_clave", F.col("_texto").cast("binary")).mapInArrow(_pieces_of_texts(lengths, bits, table), "_clave string, _pieza long")
        present = stage(likely.join(pieces, "_pieza", "left_semi"))
        table.unpersist()
    # A term of which some piece is in no text is itself in none.
    counted = anchors.join(present.groupBy("_pieza").agg(F.count("*").alias("_veces")), "_pieza", "left")
    rarest = counted.groupBy("_term").agg(F.min(F.struct(F.coalesce("_veces", F.lit(0)).alias("_veces"), "_pieza")).alias("_ancla"))
    rarest = rarest.where("_ancla._veces > 0").select("_term", F.col("_ancla._pieza").alias("_pieza"))
    met = stage(present.join(rarest, "_pieza").groupBy("_clave").agg(
        F.collect_set(F.when(F.octet_length("_term") > ANCHOR_BYTES, F.col("_term"))).alias("_terminos"),
        F.bool_or(F.octet_length("_term") <= ANCHOR_BYTES).alias("_entero"),
    ))
    whole = met.where("NOT _entero").join(texts, "_clave").where(F.exists("_terminos", lambda t: F.contains("_texto", t))).select("_clave")
    found = met.where("_entero").select("_clave").unionAll(whole)
    return rows.join(found, "_clave", "left_semi").select("_fila.*")


def exclude_terms(df: DataFrame, terms: Sequence[str], column: str = "snippet_full_clean") -> DataFrame:
    """Rows whose text contains none of the terms; null text is kept."""
    return held(df, "_texto", F.col(column)).where(~F.coalesce(contains_any(F.col("_texto"), terms), F.lit(False))).drop("_texto")


def located_with_events(df: DataFrame, events: str = "tipos_evento_canonico") -> DataFrame:
    """Rows with a state and at least one canonical event."""
    return df.where(F.col("estado").isNotNull() & (F.size(events) > 0))


def valid_hit(url: Column) -> Column:
    """Search hit with a usable link."""
    return (F.coalesce(url, F.lit("")) != "") & contains_none(url, TITLE_LINK_NOISE)


def valid_link(text: Column, href: Column) -> Column:
    """Plain link that may be a result: long enough text and a web address."""
    return (
        (F.length(strip(text)) > 10) & F.contains(href, F.lit("http")) & contains_none(href, LINK_NOISE)
    )


def valid_snippet(text: Column) -> Column:
    """Snippet of more than 20 characters that is not an interface phrase."""
    return (F.length(strip(text)) > 20) & contains_none(text, INTERFACE_PHRASES)


# The functions travel to the executors by value, so that these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
