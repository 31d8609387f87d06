"""Rain of a window against the median of the same window in earlier years."""

from __future__ import annotations

from calendar import monthrange
from collections.abc import Mapping
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from regionpulse.functions.levels import RAIN_RATIOS, rain_level, rain_priority
from regionpulse.functions.numbers import round_exact
from regionpulse.functions.text import choice_name
from regionpulse.operators.ordering import numbered


def years_before(day: date, years: int) -> date:
    """Same calendar day earlier; 29 February becomes 28 February."""
    year = day.year - years
    return date(year, day.month, min(day.day, monthrange(year, day.month)[1]))


def window_bounds(start: date, end: date, years: int) -> list[tuple[int, date, date]]:
    """``(k, first day, last day)`` of the current window (0) and the ``years`` before it."""
    return [(k, years_before(start, k), years_before(end, k)) for k in range(years + 1)]


def rain_windows(daily: DataFrame, start: date, end: date, years: int) -> DataFrame:
    """``(estado, k, total)``: rain inside the window and inside each earlier year's window.

    The bounds are the same for every state, so they are literals: the scan
    gets them as filters and no join is needed.  Years without rows give no row.
    """
    bounds = window_bounds(start, end, years)
    inside = {k: F.col("fecha").between(F.lit(lo), F.lit(hi)) for k, lo, hi in bounds}
    rows = daily.where(reduce(lambda a, b: a | b, inside.values()))
    overlapping = any(
        earlier_end >= start for (_, start, _), (_, _, earlier_end) in zip(bounds, bounds[1:], strict=False)
    )
    if overlapping:
        k = F.explode(F.array_compact(F.array(*[F.when(test, F.lit(i)) for i, test in inside.items()])))
    else:
        k = F.coalesce(*[F.when(test, F.lit(i)) for i, test in inside.items()])
    return rows.select("estado", "mm", k.alias("k")).groupBy("estado", "k").agg(F.sum("mm").alias("total"))


def rain_risk(
    daily: DataFrame,
    states: DataFrame,
    start: date,
    end: date,
    years: int = 10,
    min_normal_mm: float = 15.0,
    ratios: Mapping[str, float] = RAIN_RATIOS,
) -> DataFrame:
    """Rain level per state.

    States without any earlier year, or with nothing to divide by, are left out.
    """
    past = F.when(F.col("k") > 0, F.col("total"))
    per_state = (
        rain_windows(daily, start, end, years)
        .groupBy("estado")
        .agg(
            F.coalesce(F.max(F.when(F.col("k") == 0, F.col("total"))), F.lit(0.0)).alias("acumulado"),
            round_exact(F.median(past)).alias("normal_historico"),
            F.count(past).alias("anios_historicos_usados"),
        )
        .where(F.col("anios_historicos_usados") > 0)
    )
    effective = F.greatest("normal_historico", F.lit(float(min_normal_mm)))
    ratio = F.col("_riesgo")
    return (
        states.select("estado", "capital")
        .join(per_state, "estado")
        .withColumn("_riesgo", round_exact(F.try_divide("acumulado", effective)))
        .where(ratio.isNotNull())
        .select(
            "estado",
            "capital",
            round_exact(F.col("acumulado")).alias("acumulado"),
            "normal_historico",
            "anios_historicos_usados",
            rain_level(ratio, ratios).alias("alerta"),
            rain_priority(rain_level(ratio, ratios)).alias("prioridad"),
            round_exact(ratio * 100).alias("saturacion"),
            *[
                round_exact(effective * ratios[level]).alias(f"umbral_{level}")
                for level in ("amarillo", "naranja", "rojo")
            ],
        )
    )


def sort_rain(df: DataFrame) -> DataFrame:
    """Highest priority first, then the largest share of the normal."""
    return df.orderBy(*_by_priority())


def rank_rain(df: DataFrame, rank: str = "orden") -> DataFrame:
    """The place of each state in the order of :func:`sort_rain`, from 0."""
    return numbered(df, _by_priority(), rank)


def _by_priority() -> list[str | Column]:
    return [F.desc("prioridad"), F.desc("saturacion"), "estado"]


def at_risk(df: DataFrame) -> DataFrame:
    """States above green."""
    return df.where(F.col("prioridad") > 1)


def level_totals(df: DataFrame, level: str = "alerta") -> DataFrame:
    """``(nivel, n)``: number of rows per level."""
    return df.groupBy(F.col(level).alias("nivel")).agg(F.count("*").alias("n"))


def cumulative_rain(daily: DataFrame, start: date, end: date) -> DataFrame:
    """Running rain total per state and day of the window."""
    days = (
        daily.where(F.col("fecha").between(F.lit(start), F.lit(end)))
        .groupBy("estado", "fecha")
        .agg(F.sum("mm").alias("mm"))
    )
    running = W.partitionBy("estado").orderBy("fecha").rowsBetween(W.unboundedPreceding, W.currentRow)
    return days.withColumn("acumulado_mm", F.sum("mm").over(running))


def rain_output(df: DataFrame, calculated: datetime) -> DataFrame:
    """Rain levels under the names the output contract uses."""
    return df.select(
        F.lit(calculated.isoformat(sep=" ")).cast("timestamp").alias("fecha_calculo"),
        choice_name(F.col("estado")).alias("estado"),
        "capital",
        F.col("acumulado").alias("precipitacion_30dias"),
        "saturacion",
        F.lower("alerta").alias("nivel_alerta"),
        "umbral_amarillo",
        "umbral_naranja",
        "umbral_rojo",
    )
