"""Earthquakes: nearest region, statistics per region and alert level."""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionpulse.functions.geo import EARTH_RADIUS_KM, haversine_km
from regionpulse.functions.levels import quake_level
from regionpulse.functions.numbers import round_scaled
from regionpulse.functions.text import choice_name
from regionpulse.operators.ordering import numbered
from regionpulse.sources.dimensions import plan_values

# Fixed value: bounding box of the scanned area, with a margin.
BOUNDING_BOX = {"min_lat": 0.5, "max_lat": 13.0, "min_lon": -73.5, "max_lon": -59.5}

# Up to this many capitals per grid cell are compared by generated code.
CAPITALS_UNROLLED = 16

# Capitals per broadcast; a longer list is taken in slices of this size.
CAPITALS_PER_SLICE = 20_000

DEFAULT_STATE = "_default"


def filter_quakes(
    df: DataFrame,
    min_magnitude: float | None = None,
    start: datetime | None = None,
    end: datetime | None = None,
    box: dict[str, float] | None = BOUNDING_BOX,
) -> DataFrame:
    """Events inside the box, the time range and above the magnitude.

    Comparisons of plain columns with literals, so the scan can use them.
    """
    if box:
        df = df.where(F.col("lat").between(box["min_lat"], box["max_lat"]))
        df = df.where(F.col("lon").between(box["min_lon"], box["max_lon"]))
    if min_magnitude is not None:
        df = df.where(F.col("magnitud") >= min_magnitude)
    kind = df.schema["fecha_evento"].dataType
    if start is not None:
        df = df.where(F.col("fecha_evento") >= F.lit(start.isoformat(sep=" ")).cast(kind))
    if end is not None:
        df = df.where(F.col("fecha_evento") <= F.lit(end.isoformat(sep=" ")).cast(kind))
    return df


def sort_quakes(df: DataFrame) -> DataFrame:
    """Newest first."""
    return df.orderBy(*_newest_first())


def rank_quakes(df: DataFrame, rank: str = "orden") -> DataFrame:
    """The place of each earthquake in the order of :func:`sort_quakes`, from 0."""
    return numbered(df, _newest_first(), rank)


def _newest_first() -> list[str | Column]:
    return [F.desc("fecha_evento"), "id_evento"]


def _wrapped(lon: Column) -> Column:
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def _cells_of_capitals(states: DataFrame, radius_km: float, cell_deg: float) -> DataFrame:
    """Grid cells each capital can reach, gathered per cell.

    A capital's cells cover the whole circle around it: the longitude half
    width grows with latitude, and a circle over a pole or the date line is
    covered on both sides.
    """
    reach = radius_km / EARTH_RADIUS_KM
    half_lat = math.degrees(reach) + 1e-6
    over_pole = F.abs("lat") + half_lat >= 90.0
    half_lon = F.when(over_pole, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(F.sin(F.lit(reach)) / F.cos(F.radians("lat")), F.lit(1.0)))) + 1e-6
    )
    def cell(value: Column) -> Column:
        return F.floor(value / cell_deg)

    lon = F.col("lon") + F.col("turn")
    cells = (
        states.select(
            F.col("ord"), F.col("estado"), "lat", _wrapped(F.col("lon")).alias("lon"), half_lon.alias("half"),
            F.explode(F.array(F.lit(-360.0), F.lit(0.0), F.lit(360.0))).alias("turn"),
        )
        .where((lon + F.col("half") >= -180.0) & (lon - F.col("half") <= 180.0))
        .select(
            "ord", "estado", "lat", "lon",
            F.explode(F.sequence(cell(F.col("lat") - half_lat), cell(F.col("lat") + half_lat))).alias("cy"),
            F.sequence(
                cell(F.greatest(lon - F.col("half"), F.lit(-180.0))),
                cell(F.least(lon + F.col("half"), F.lit(180.0))),
            ).alias("cxs"),
        )
        .select("ord", "estado", "lat", "lon", "cy", F.explode("cxs").alias("cx"))
        .distinct()
    )
    return cells.groupBy("cy", "cx").agg(
        F.collect_list(F.struct("ord", "estado", "lat", "lon")).alias("capitals")
    )


def _nearest(capital: Column) -> Column:
    """Distance to a capital, its position and its state; the order of preference."""
    km = haversine_km(F.col("lat"), F.col("lon"), capital["lat"], capital["lon"])
    return F.struct(
        (F.rint(km * 1e6) / 1e6).alias("km"),
        capital["ord"].cast("int").alias("ord"),
        capital["estado"].alias("estado"),
    )


def assign_nearest_state(
    events: DataFrame, states: DataFrame, radius_km: float, slice_size: int = CAPITALS_PER_SLICE
) -> DataFrame:
    """``estado`` of the nearest capital within ``radius_km``, else null.

    Equal distances (to the millimetre) go to the first state of the list.
    Each event meets only the capitals that can reach its grid cell, and it
    stays one row: nothing is shuffled by event.  A long list of capitals is
    taken in slices, each small enough to broadcast, keeping the best so far.
    """
    cell_deg = max(math.degrees(radius_km / EARTH_RADIUS_KM), 0.01)
    slices = max(1, -(-states.count() // slice_size))
    result = events.withColumns(
        {
            "_cy": F.floor(F.col("lat") / cell_deg),
            "_cx": F.floor(_wrapped(F.col("lon")) / cell_deg),
            "_best": F.lit(None).cast("struct<km:double,ord:int,estado:string>"),
        }
    )
    for i in range(slices):
        part = states if slices == 1 else states.where(F.pmod(F.xxhash64("estado", "ord"), F.lit(slices)) == i)
        cells = _cells_of_capitals(part, radius_km, cell_deg)
        most = cells.agg(F.coalesce(F.max(F.size("capitals")), F.lit(0))).first()[0]
        if most <= CAPITALS_UNROLLED:
            found = [_nearest(F.get("capitals", F.lit(j))) for j in range(most)]
            known = [F.when(F.size("capitals") > j, option) for j, option in enumerate(found)]
            best = F.least("_best", *known) if known else F.col("_best")
        else:
            best = F.least("_best", F.array_min(F.transform("capitals", _nearest)))
        near = F.broadcast(cells.select(F.col("cy").alias("_cy"), F.col("cx").alias("_cx"), "capitals"))
        result = result.join(near, ["_cy", "_cx"], "left").withColumn("_best", best).drop("capitals")
    within = F.when(F.col("_best.km") <= radius_km, F.col("_best.estado"))
    return result.withColumn("estado", within).drop("_cy", "_cx", "_best")


def quake_metrics(
    assigned: DataFrame,
    states: DataFrame,
    thresholds: DataFrame,
    window_days: int,
    calculated: datetime,
) -> DataFrame:
    """One row per state: count, magnitudes, depth and level; quiet states get zeros and green."""
    levels = ["umbral_amarillo", "umbral_naranja", "umbral_rojo"]
    default = plan_values(thresholds.where(F.col("estado") == DEFAULT_STATE), "estado", *levels, limit=1)[0]
    stats = (
        assigned.where(F.col("estado").isNotNull())
        .groupBy("estado")
        .agg(
            F.count("*").alias("n"),
            F.max("magnitud").alias("maxima"),
            F.avg("magnitud").alias("media"),
            F.avg("profundidad_km").alias("profundidad"),
        )
    )
    quiet = F.col("n").isNull()
    limits = [F.coalesce(name, F.lit(value)) for name, value in zip(levels, default[1:], strict=True)]

    def or_zero(c: str) -> Column:
        return F.when(quiet, F.lit(0.0)).otherwise(round_scaled(F.col(c)))

    return (
        states.select("estado", "ord")
        .join(stats, "estado", "left")
        .join(thresholds.where(F.col("estado") != DEFAULT_STATE), "estado", "left")
        .orderBy("ord")
        .select(
            F.lit(calculated.isoformat(sep=" ")).cast("timestamp").alias("fecha_calculo"),
            choice_name(F.col("estado")).alias("estado"),
            F.lit(window_days).cast("int").alias("ventana_dias"),
            F.coalesce("n", F.lit(0)).cast("int").alias("n_sismos"),
            or_zero("maxima").alias("magnitud_maxima"),
            or_zero("media").alias("magnitud_promedio"),
            or_zero("profundidad").alias("profundidad_promedio_km"),
            F.lower(quake_level(F.col("maxima"), *limits)).alias("nivel_alerta"),
        )
    )
