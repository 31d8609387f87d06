"""Earthquake job: events -> nearest state -> metrics per state -> timeline."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame

from regionpulse.operators.quakes import (
    BOUNDING_BOX,
    assign_nearest_state,
    filter_quakes,
    quake_metrics,
)
from regionpulse.sources.sinks import append_snapshot


def run_quakes(
    events: DataFrame,
    states: DataFrame,
    thresholds: DataFrame,
    now: datetime,
    calculated: datetime,
    window_days: int = 30,
    min_magnitude: float = 2.5,
    radius_km: float = 150.0,
    box: dict[str, float] | None = BOUNDING_BOX,
    timeline: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Events with their state, and one metric row per state."""
    recent = filter_quakes(events, min_magnitude, now - timedelta(days=window_days), now, box)
    assigned = assign_nearest_state(recent, states, radius_km)
    metrics = quake_metrics(assigned, states, thresholds, window_days, calculated)
    if timeline:
        append_snapshot(metrics, timeline)
    return assigned, metrics
