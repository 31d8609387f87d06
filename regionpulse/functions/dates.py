"""Dates written in text, relative dates, and run date ranges."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionpulse.functions.text import strip_marks

# Month abbreviations.
MONTHS_ES = {
    "ene": 1, "feb": 2, "mar": 3, "abr": 4, "may": 5, "jun": 6,
    "jul": 7, "ago": 8, "sep": 9, "set": 9, "oct": 10, "nov": 11, "dic": 12,
}
MONTHS_EN = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6,
    "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
}

# Days per unit of a relative date, Spanish and English.
UNIT_DAYS = {
    "dia": 1, "semana": 7, "mes": 30, "ano": 365,
    "day": 1, "week": 7, "month": 30, "year": 365,
}

RELATIVE_ES = r"^hace\s+(\d+)\s+(dia|hora|semana|mes|ano)"
RELATIVE_EN = r"^(\d+)\s+(day|hour|week|month|year)s?\s+ago"
ISO_DATE = r"^(\d{4})-(\d{2})-(\d{2})"
DAY_DE_MONTH = r"^(\d{1,2})\s+de\s+([a-z]+)\s+de\s+(\d{4})"
DAY_MONTH = r"^(\d{1,2})\s+([a-z]{3,})\.?\s+(?:de\s+)?(\d{4})"
MONTH_DAY = r"^([a-z]{3,})\.?\s+(\d{1,2}),?\s+(\d{4})"


def _as_timestamp(moment: datetime | Column) -> Column:
    return moment if isinstance(moment, Column) else F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def _date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Date text ``yyyy-MM-dd``, or null when there is no such day."""
    parsed = F.try_to_date(F.concat_ws("-", year, month, day), "y-M-d")
    return F.when(F.year(parsed) >= 1, F.date_format(parsed, "yyyy-MM-dd"))


def _month_number(name: Column, months: dict[str, int]) -> Column:
    numbers = F.create_map(*[F.lit(x) for k, v in months.items() for x in (k, str(v))])
    return F.try_element_at(numbers, F.substring(name, 1, 3))


def _shifted(ref: Column, amount: Column, unit: Column) -> Column:
    """``ref`` minus ``amount`` units as date text; null outside the calendar."""
    n = amount.try_cast("long")
    per_unit = F.try_element_at(F.create_map(*[F.lit(x) for pair in UNIT_DAYS.items() for x in pair]), unit)
    # Ten thousand years take any date out of the calendar; beyond them the numbers would overflow.
    days = F.when(n <= 3_660_000, n * per_unit)
    by_day = F.date_sub(F.to_date(ref), F.when(days <= 3_660_000, days).cast("int"))
    hours = F.when(n <= 87_840_000, n)
    by_hour = F.to_date(ref - F.make_dt_interval(F.floor(hours / 24).cast("int"), (hours % 24).cast("int")))
    moved = F.when(unit.isin("hora", "hour"), by_hour).otherwise(by_day)
    return F.when(F.year(moved) >= 1, F.date_format(moved, "yyyy-MM-dd"))


def date_head(c: Column) -> Column:
    """A snippet in lower case, without marks and leading white space."""
    return F.regexp_replace(strip_marks(F.lower(c)), r"^\s+", "")


def parse_head_date(text: Column, ref: datetime | Column) -> Column:
    """Date at the start of a :func:`date_head` as ``yyyy-MM-dd``, else null."""
    ref = _as_timestamp(ref)

    def group(pattern: str, i: int) -> Column:
        return F.regexp_extract(text, pattern, i)

    def relative(pattern: str) -> Column:
        return _shifted(ref, group(pattern, 1), group(pattern, 2))

    def worded(pattern: str, day: int, month: int, months: dict[str, int]) -> Column:
        return _date_from_parts(group(pattern, 3), _month_number(group(pattern, month), months), group(pattern, day))

    def known(pattern: str, month: int, months: dict[str, int]) -> Column:
        return F.substring(group(pattern, month), 1, 3).isin(*months)

    return (
        F.when(text.rlike(RELATIVE_ES), relative(RELATIVE_ES))
        .when(text.rlike(RELATIVE_EN), relative(RELATIVE_EN))
        .when(text.rlike(r"^ayer\b"), F.date_format(F.date_sub(F.to_date(ref), 1), "yyyy-MM-dd"))
        .when(text.rlike(r"^hoy\b"), F.date_format(F.to_date(ref), "yyyy-MM-dd"))
        .when(
            text.rlike(ISO_DATE),
            _date_from_parts(group(ISO_DATE, 1), group(ISO_DATE, 2), group(ISO_DATE, 3)),
        )
        .when(
            text.rlike(DAY_DE_MONTH),
            F.when(known(DAY_DE_MONTH, 2, MONTHS_ES), worded(DAY_DE_MONTH, 1, 2, MONTHS_ES)),
        )
        .when(
            text.rlike(DAY_MONTH),
            F.when(known(DAY_MONTH, 2, MONTHS_ES), worded(DAY_MONTH, 1, 2, MONTHS_ES)),
        )
        .when(
            text.rlike(MONTH_DAY) & known(MONTH_DAY, 1, MONTHS_EN),
            worded(MONTH_DAY, 2, 1, MONTHS_EN),
        )
    )


def with_snippet_date(df: DataFrame, column: str, target: str, ref: datetime | Column) -> DataFrame:
    """Publication date written at the start of a snippet, as ``yyyy-MM-dd`` or null.

    Accepts relative Spanish and English dates, *ayer* and *hoy*, ISO,
    ``4 de julio de 2026``, ``14 jul. 2025`` and ``Jul 4, 2026``.  The first
    form that matches decides: an impossible day there gives null, while an
    unknown month name lets the later forms try.

    The head of the text is a column of its own, so its many uses do not
    compute it again.
    """
    head = "_date_head"
    return df.withColumn(head, date_head(F.col(column))).withColumn(
        target, parse_head_date(F.col(head), ref)
    ).drop(head)


def resolve_relative_date(c: Column, now: datetime | Column) -> Column:
    """``hace N dia(s)/hora(s)`` -> date text, any other ``hace`` -> today, else unchanged."""
    now = _as_timestamp(now)
    text = F.trim(F.lower(c))
    days = F.regexp_extract(text, r"hace\s+(\d+)\s+dia", 1)
    hours = F.regexp_extract(text, r"hace\s+(\d+)\s+hora", 1)
    return (
        F.when(days != "", _shifted(now, days, F.lit("dia")))
        .when(hours != "", _shifted(now, hours, F.lit("hora")))
        .when(F.contains(text, F.lit("hace")), F.date_format(F.to_date(now), "yyyy-MM-dd"))
        .otherwise(c)
    )


def strict_date(c: Column) -> Column:
    """``yyyy-MM-dd`` text (one-digit month or day allowed) -> date; anything else null."""
    return F.when(c.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(c, "y-M-d"))


def shift_years(c: Column, years: int | Column) -> Column:
    """Same day ``years`` earlier; 29 February becomes 28 February."""
    return F.add_months(c, years * -12)


def run_date_range(
    today: date,
    window_days: int,
    start: str | None = None,
    end: str | None = None,
    enabled: bool = True,
) -> tuple[str | None, str | None]:
    """Date bounds of a run: the fixed pair if both are set, else the last ``window_days``."""
    if not enabled:
        return None, None
    if start and end:
        return start, end
    return (today - timedelta(days=window_days)).isoformat(), today.isoformat()


def iso_timestamp(c: Column) -> Column:
    """ISO text of a timestamp; the fraction is written only when there is one."""
    fraction = F.date_format(c, "SSSSSS")
    return F.when(fraction == "000000", F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
