from __future__ import annotations

import math
import random
from datetime import date, datetime, timedelta
from statistics import median

from pyspark.sql import functions as F

from regionpulse.operators import quakes as Z
from regionpulse.operators import rain as N
from regionpulse.plans.quakes import run_quakes
from regionpulse.plans.rain import run_rain
from regionpulse.sources import dimensions

# An invented country: capitals on a diagonal, two degrees apart, and thresholds that rise by odd steps.
STATES = {
    "norte": {"capital": "Puerto Norte", "lat": 8.0, "lon": -64.0},
    "alto rio": {"capital": "Villa Alta", "lat": 6.0, "lon": -66.0},
    "sur": {"capital": "Ciudad Sur", "lat": 4.0, "lon": -68.0},
}
THRESHOLDS = {
    "sur": {"umbral_amarillo": 2.7, "umbral_naranja": 3.2, "umbral_rojo": 7.1},
    "_default": {"umbral_amarillo": 3.3, "umbral_naranja": 4.9, "umbral_rojo": 7.7},
}


def series(state, values):
    return [(state, day, float(mm)) for day, mm in values]


def test_window_bounds_clamp_leap_days():
    assert N.window_bounds(date(2024, 2, 29), date(2024, 3, 2), 1) == [
        (0, date(2024, 2, 29), date(2024, 3, 2)), (1, date(2023, 2, 28), date(2023, 3, 2)),
    ]


def test_rain_levels_and_medians(spark):
    end = date(2024, 3, 1)
    start = end - timedelta(days=2)
    days = [start + timedelta(days=i) for i in range(3)]

    def year(k, per_day):
        lo, hi = N.years_before(start, k), N.years_before(end, k)
        return [(lo + timedelta(days=i), per_day) for i in range((hi - lo).days + 1)]

    rows = []
    # 3 days now; even number of earlier years: the median is between two totals
    rows += series("norte", [(d, 20.0) for d in days] + year(1, 10.0) + year(2, 5.0))
    rows += series("alto rio", [(d, 6.0) for d in days] + year(1, 0.0))  # dry normal: the floor applies
    rows += series("sur", [(d, 50.0) for d in days])  # no earlier year
    rows += series("norte", [(start - timedelta(days=1), 999.0), (end + timedelta(days=1), 999.0)])
    daily = spark.createDataFrame(rows, "estado string, fecha date, mm double")
    states = dimensions.states_dim(spark, STATES)
    got = {r.estado: r for r in N.rain_risk(daily, states, start, end, years=3, min_normal_mm=15).collect()}
    assert set(got) == {"norte", "alto rio"}
    totals = [sum(mm for d, mm in year(k, v)) for k, v in ((1, 10.0), (2, 5.0))]
    assert got["norte"].normal_historico == round(median(totals), 2) and got["norte"].anios_historicos_usados == 2
    assert got["norte"].acumulado == 60.0
    ratio = round(60.0 / median(totals), 2)
    assert got["norte"].saturacion == round(ratio * 100, 2)
    alto = got["alto rio"]
    assert (alto.acumulado, alto.normal_historico, alto.saturacion, alto.alerta) == (18.0, 0.0, 120.0, "VERDE")
    assert (alto.umbral_amarillo, alto.umbral_naranja, alto.umbral_rojo) == (18.75, 25.5, 33.0)


def test_ratio_edges_are_inclusive(spark):
    end = date(2023, 7, 1)
    levels = {"a": 125.0, "b": 170.0, "c": 220.0, "d": 124.0}
    rows = [(s, end, mm) for s, mm in levels.items()] + [(s, date(2022, 7, 1), 100.0) for s in levels]
    daily = spark.createDataFrame(rows, "estado string, fecha date, mm double")
    states = dimensions.states_dim(spark, {s: {"capital": s, "lat": 0, "lon": 0} for s in levels})
    risk = N.rain_risk(daily, states, end, end, years=1)
    assert {r.estado: r.alerta for r in risk.collect()} == {"a": "AMARILLO", "b": "NARANJA", "c": "ROJO", "d": "VERDE"}
    assert [r.estado for r in N.sort_rain(risk).collect()] == ["c", "b", "a", "d"]
    assert N.at_risk(risk).count() == 3
    assert {r.nivel: r.n for r in N.level_totals(risk).collect()} == {"AMARILLO": 1, "NARANJA": 1, "ROJO": 1, "VERDE": 1}


def test_nothing_to_divide_by_leaves_the_state_out(spark):
    daily = spark.createDataFrame([("norte", date(2023, 7, 1), 5.0), ("norte", date(2022, 7, 1), 0.0)], "estado string, fecha date, mm double")
    assert N.rain_risk(daily, dimensions.states_dim(spark, STATES), date(2023, 7, 1), date(2023, 7, 1), 1, 0.0).count() == 0


def test_overlapping_windows_match_brute_force(spark):
    rng = random.Random(5)
    rows = [("norte", date(2020, 1, 1) + timedelta(days=rng.randrange(1500)), float(rng.randrange(50))) for _ in range(400)]
    daily = spark.createDataFrame(rows, "estado string, fecha date, mm double")
    start, end = date(2022, 1, 10), date(2023, 6, 1)
    expected = {
        k: sum(mm for _, d, mm in rows if lo <= d <= hi)
        for k, lo, hi in N.window_bounds(start, end, 2) if any(lo <= d <= hi for _, d, _ in rows)
    }
    assert {r.k: r.total for r in N.rain_windows(daily, start, end, 2).collect()} == expected


def test_rain_bounds_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "r")
    spark.createDataFrame([("norte", date(2023, 7, 1), 5.0)], "estado string, fecha date, mm double").write.parquet(path)
    windows = N.rain_windows(spark.read.parquet(path), date(2023, 6, 1), date(2023, 7, 1), 3)
    plan = windows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan


def test_cumulative_and_output(spark):
    rows = [("norte", date(2023, 7, d), float(d)) for d in (1, 2, 2, 3)] + [("norte", date(2022, 7, 2), 4.0)]
    daily = spark.createDataFrame(rows, "estado string, fecha date, mm double")
    got = N.cumulative_rain(daily, date(2023, 7, 1), date(2023, 7, 3)).orderBy("fecha").collect()
    assert [(r.mm, r.acumulado_mm) for r in got] == [(1.0, 1.0), (4.0, 5.0), (3.0, 8.0)]
    out = run_rain(daily, dimensions.states_dim(spark, STATES), date(2023, 7, 3), datetime(2023, 7, 3, 8), window_days=2, years=1)
    assert out.first().asDict() == {
        "fecha_calculo": datetime(2023, 7, 3, 8), "estado": "norte", "capital": "Puerto Norte", "precipitacion_30dias": 8.0,
        "saturacion": 53.0, "nivel_alerta": "verde", "umbral_amarillo": 18.75, "umbral_naranja": 25.5, "umbral_rojo": 33.0,
    }


def distance(a, b):
    (lat1, lon1), (lat2, lon2) = a, b
    dlat, dlon = math.radians(lat2 - lat1), math.radians(lon2 - lon1)
    h = math.sin(dlat / 2) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(dlon / 2) ** 2
    return 6371 * 2 * math.asin(min(1.0, math.sqrt(h)))


def nearest(point, capitals, radius):
    best = min(((round(distance(point, c), 6), i) for i, c in enumerate(capitals)), default=(math.inf, 0))
    return f"s{best[1]}" if best[0] <= radius else None


def check_nearest(spark, points, capitals, radius, **options):
    states = dimensions.states_dim(spark, {f"s{i}": {"capital": "c", "lat": a, "lon": b} for i, (a, b) in enumerate(capitals)})
    events = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(points)], "i int, lat double, lon double")
    got = {r.i: r.estado for r in Z.assign_nearest_state(events, states, radius, **options).collect()}
    for i, p in enumerate(points):
        assert got[i] == nearest(p, capitals, radius), (p, radius)
    assert len(got) == len(points)


def test_nearest_matches_brute_force(spark):
    rng = random.Random(2)
    capitals = [(rng.uniform(0, 13), rng.uniform(-74, -59)) for _ in range(30)]
    points = [(rng.uniform(-2, 15), rng.uniform(-76, -57)) for _ in range(300)]
    check_nearest(spark, points, capitals, 150.0)
    check_nearest(spark, points, capitals, 20.0)
    check_nearest(spark, points, capitals, 2000.0)  # many capitals per cell
    check_nearest(spark, points, capitals, 150.0, slice_size=4)


def test_nearest_at_poles_and_date_line(spark):
    rng = random.Random(4)
    capitals = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(25)]
    capitals += [(89.5, 10.0), (-89.9, 170.0), (0.0, 180.0), (5.0, -180.0), (70.0, 179.9)]
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)]
    points += [(89.9, -170.0), (0.0, -179.9), (5.0, 179.5), (70.0, -179.9), (-90.0, 0.0), (90.0, 0.0), (0.0, 181.0)]
    check_nearest(spark, points, capitals, 500.0)
    check_nearest(spark, points, capitals, 5000.0)


def test_equal_distance_goes_to_the_first_state(spark):
    check_nearest(spark, [(0.0, 0.0)], [(0.0, 1.0), (0.0, -1.0)], 150.0)
    check_nearest(spark, [(0.0, 0.0)], [(0.0, -1.0), (0.0, 1.0)], 150.0)


def quake_rows():
    """Two near the first capital, one near none, one by the second without magnitude, one outside the box, one too old."""
    t = datetime(2026, 7, 1)
    return [
        ("1", t, 4.0, 10.0, "x", 8.2, -64.1, ""), ("2", t, 4.25, 20.0, "x", 7.7, -63.9, ""), ("3", t, 5.0, 1.0, "x", 1.1, -61.0, ""),
        ("4", t, None, 5.0, "x", 6.3, -66.2, ""), ("5", t, 9.0, 5.0, "x", 40.0, -66.2, ""), ("6", datetime(2026, 1, 1), 9.0, 5.0, "x", 6.3, -66.2, ""),
    ]


def test_quake_metrics_cover_every_state(spark):
    events = spark.createDataFrame(quake_rows(), "id_evento string, fecha_evento timestamp, magnitud double, profundidad_km double, lugar string, lat double, lon double, url_detalle string")
    states, thresholds = dimensions.states_dim(spark, STATES), dimensions.thresholds_dim(spark, THRESHOLDS)
    now = datetime(2026, 7, 10)
    assigned, metrics = run_quakes(events, states, thresholds, now, now)
    assert {r.id_evento: r.estado for r in assigned.collect()} == {"1": "norte", "2": "norte", "3": None}
    rows = metrics.collect()
    assert [r.estado for r in rows] == ["norte", "alto_rio", "sur"]
    norte, alto, _ = rows
    assert (norte.n_sismos, norte.magnitud_maxima, norte.magnitud_promedio, norte.profundidad_promedio_km, norte.nivel_alerta) == (2, 4.25, 4.12, 15.0, "amarillo")
    assert (alto.n_sismos, alto.magnitud_maxima, alto.nivel_alerta) == (0, 0.0, "verde")
    # null magnitudes count as events and stay green
    only_null = Z.assign_nearest_state(events.where("id_evento = '4'"), states, 150.0)
    row = Z.quake_metrics(only_null, states, thresholds, 30, now).where(F.col("estado") == "alto_rio").first()
    assert (row.n_sismos, row.magnitud_maxima, row.nivel_alerta) == (1, None, "verde")
    assert Z.quake_metrics(assigned.where("false"), states, thresholds, 30, now).count() == 3


def test_quake_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "q")
    spark.createDataFrame(quake_rows(), "id_evento string, fecha_evento timestamp, magnitud double, profundidad_km double, lugar string, lat double, lon double, url_detalle string").write.parquet(path)
    kept = Z.filter_quakes(spark.read.parquet(path), 2.5, datetime(2026, 6, 1), datetime(2026, 7, 10))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    for part in ("GreaterThanOrEqual(lat", "LessThanOrEqual(lon", "GreaterThanOrEqual(magnitud", "GreaterThanOrEqual(fecha_evento"):
        assert part in plan
