"""Rain job: daily series -> level per state -> timeline."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame

from regionpulse.functions.levels import RAIN_RATIOS
from regionpulse.operators.rain import rain_output, rain_risk, sort_rain
from regionpulse.sources.sinks import append_snapshot


def run_rain(
    daily: DataFrame,
    states: DataFrame,
    today: date,
    calculated: datetime,
    window_days: int = 30,
    years: int = 10,
    min_normal_mm: float = 15.0,
    ratios: Mapping[str, float] = RAIN_RATIOS,
    timeline: str | None = None,
) -> DataFrame:
    """Rain levels of the ``window_days`` before ``today`` in output form, added to the timeline if given."""
    start = today - timedelta(days=window_days)
    risk = rain_risk(daily, states, start, today, years, min_normal_mm, ratios)
    result = rain_output(sort_rain(risk), calculated)
    if timeline:
        append_snapshot(result, timeline)
    return result
