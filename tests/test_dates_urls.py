from __future__ import annotations

from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from regionpulse.functions import dates as D
from regionpulse.functions import numbers as N
from regionpulse.functions import urls as U
from regionpulse.operators import filters as R
from regionpulse.operators import links as L
from regionpulse.operators.classify import resolve_dates

REF = datetime(2026, 7, 10, 8, 0)

SAMPLES = {
    "hace 3 dias": "2026-07-07",
    "  Hace 1 DÍA": "2026-07-09",
    "hace 1 hora": "2026-07-10",
    "hace 9 horas": "2026-07-09",
    "hace 2 semanas": "2026-06-26",
    "hace 2 meses": "2026-05-11",
    "hace 1 año": "2025-07-10",
    "2 months ago": "2026-05-11",
    "5 hours ago": "2026-07-10",
    "1 year ago": "2025-07-10",
    "ayer en Coro": "2026-07-09",
    "ayerr": None,
    "hoy": "2026-07-10",
    "2026-07-04": "2026-07-04",
    "2026-07-04T10:00": "2026-07-04",
    "2026-13-01": None,
    "4 de julio de 2026": "2026-07-04",
    "4 de julio 2026": None,
    "4 julio de 2026": "2026-07-04",
    "14 jul 2025Texto pegado": "2025-07-14",
    "14 jul. 2025": "2025-07-14",
    "4 set 2025": "2025-09-04",
    "31 feb 2026": None,
    "29 feb 2024": "2024-02-29",
    "4 foo 2026": None,
    "Jul 4, 2026": "2026-07-04",
    "July 4 2026": "2026-07-04",
    "Jul. 04, 2026": "2026-07-04",
    "Foo 4, 2026": None,
    "Ene 4, 2026": None,
    "sin fecha": None,
    "hace 99999999 dias": None,
    "hace 0000003 dias": "2026-07-07",
    "hace 1000000 horas": "1912-06-11",
    "hace 99999999999999999999 horas": None,
    "3\u202fjul\u20092026": "2026-07-03",
    "": None,
}


def test_snippet_dates(spark):
    df = spark.createDataFrame([(t,) for t in [*SAMPLES, None]], "t string")
    got = {r.t: r.d for r in D.with_snippet_date(df, "t", "d", REF).collect()}
    assert got == {**SAMPLES, None: None}


def test_relative_dates(spark):
    texts = {
        "hace 3 dias": ("2026-07-07", date(2026, 7, 7)),
        "visto hace 10 horas": ("2026-07-09", date(2026, 7, 9)),
        "hace 3 días": ("2026-07-10", date(2026, 7, 10)),
        "hace poco": ("2026-07-10", date(2026, 7, 10)),
        "2026-07-04": ("2026-07-04", date(2026, 7, 4)),
        "2026-7-4": ("2026-7-4", date(2026, 7, 4)),
        "2026-02-30": ("2026-02-30", None),
        "2026-07-04 10:00": ("2026-07-04 10:00", None),
        "ayer": ("ayer", None),
    }
    df = spark.createDataFrame([(t, t) for t in [*texts, None]], "k string, fecha string")
    got = {r.k: (r.fecha, r.fecha_dt) for r in resolve_dates(df, REF).collect()}
    assert got == {**texts, None: (None, None)}


def test_year_shift_and_ranges(spark):
    day = F.lit("2024-02-29").cast("date")
    row = spark.range(1).select(D.shift_years(day, 1).alias("a"), D.shift_years(day, 4).alias("b")).first()
    assert (row.a, row.b) == (date(2023, 2, 28), date(2020, 2, 29))
    today = date(2026, 7, 10)
    assert D.run_date_range(today, 14) == ("2026-06-26", "2026-07-10")
    assert D.run_date_range(today, 14, "2026-01-01", "2026-01-31") == ("2026-01-01", "2026-01-31")
    assert D.run_date_range(today, 14, "2026-01-01", None) == ("2026-06-26", "2026-07-10")
    assert D.run_date_range(today, 14, enabled=False) == (None, None)


def test_iso_timestamp_drops_an_empty_fraction(spark):
    df = spark.createDataFrame([(datetime(2026, 1, 2, 3, 4, 5),), (datetime(2026, 1, 2, 3, 4, 5, 60),)], "t timestamp")
    assert [r[0] for r in df.select(D.iso_timestamp(F.col("t"))).collect()] == ["2026-01-02T03:04:05", "2026-01-02T03:04:05.000060"]


def test_date_window_edges(spark):
    df = spark.createDataFrame([(date(2026, 7, d),) for d in (3, 4, 5, 6)] + [(None,)], "fecha_dt date")

    def days(**bounds):
        return [r[0].day if r[0] else None for r in R.filter_date_window(df, **bounds).collect()]

    assert days() == [3, 4, 5, 6, None]
    assert days(start="2026-07-04", end="2026-07-05") == [4, 5]
    assert days(end="2026-07-04") == [3, 4]
    stamps = df.select(F.col("fecha_dt").cast("timestamp_ntz").alias("fecha_dt"))
    assert R.filter_date_window(stamps, "2026-07-04", "2026-07-05").count() == 2


@pytest.mark.parametrize(("now", "expected"), [(datetime(2026, 7, 6, 12), [4, 5, 6]), (datetime(2026, 7, 6), [3, 4, 5, 6])])
def test_alert_window_counts_dates_as_midnight(spark, now, expected):
    df = spark.createDataFrame([(date(2026, 7, d),) for d in (2, 3, 4, 5, 6, 7)] + [(None,)], "fecha_dt date")
    assert [r[0].day for r in R.filter_alert_window(df, now, 72).collect()] == expected
    stamps = df.select(F.col("fecha_dt").cast("timestamp").alias("fecha_dt"))
    assert [r[0].day for r in R.filter_alert_window(stamps, now, 72).collect()] == expected


def test_domain(value):
    urls = ["https://WWW.A.com/x", "http://u@b.com:80/y?z", "//c.com", "d.com/x", "", None, "https://www.www.e.com", "mailto:x"]
    assert value(U.domain, urls) == ["a.com", "u@b.com:80", "c.com", "", None, None, "www.e.com", ""]


def test_social_and_redirect(value):
    assert value(U.social_network, ["https://FaceBook.com", "https://netflix.com", "https://a.com", None]) == ["facebook", "x.com", "web", "web"]
    urls = ["/url?q=https://a.com/x&sa=U", "url?q=http://b.com", "https://c.com", "", None, "url?q=http://x.com /url?q=http://y.com"]
    assert value(U.clean_redirect, urls) == ["https://a.com/x", "http://b.com", "https://c.com", None, None, "http://y.com"]


def test_links_of_a_page(spark):
    html = (
        '<a href="/uno?a=1&amp;b=2">Un titular <b>bastante</b> largo</a><a href="/uno?a=1&amp;b=2">Repetido con otro texto</a>'
        '<a href="/x">corto</a><a href="#top">Un enlace interno largo</a><a class="c" href=\'https://o.com/2\'>Otro titular muy largo</a>'
        '<a href="javascript:go()">Un enlace de script</a><a href="tres.html">Enlace relativo largo</a>'
    )
    df = spark.createDataFrame([(1, "https://p.com/dir/page?x", html), (2, "https://p.com", "<p>nada</p>"), (3, "https://p.com", None)], "id int, url string, html string")
    rows = sorted((r.rank, r.title, r.url) for r in L.extract_links(df).collect())
    assert rows == [
        (1, "Un titular bastante largo", "https://p.com/uno?a=1&b=2"),
        (2, "Otro titular muy largo", "https://o.com/2"),
        (3, "Enlace relativo largo", "https://p.com/dir/tres.html"),
    ]


def test_result_blocks(spark):
    def block(href, title, snippet):
        return (
            f'<article data-testid="result"><h2><a href="{href}">{title}</a></h2>'
            f'<span data-testid="result-extras-url-link">a.com</span><div data-result="snippet">{snippet}</div></article>'
        )

    html = (
        block("https://a.com/1", "Uno", "4 jul 2026 Un texto suficientemente largo")
        + block("https://a.com/1", "Otra vez", "x" * 30)
        + block("https://duckduckgo.com/y", "Ruido", "x" * 30)
        + block("https://a.com/settings", "Ajustes", "x" * 30)
        + block("https://a.com/2", "Dos", "corto")
        + block("https://a.com/3", "Tres", "Bloquea este sitio de los resultados")
    )
    df = spark.createDataFrame([(1, "https://s.com", html)], "id int, url string, html string")
    rows = sorted(L.extract_results(df, REF).collect(), key=lambda r: r["rank"])
    assert [(r["rank"], r.title, r.url, r.fecha, r.displayed_url) for r in rows] == [
        (1, "Uno", "https://a.com/1", "2026-07-04", "a.com"),
        (2, "Dos", "https://a.com/2", None, "a.com"),
        (3, "Tres", "https://a.com/3", None, "a.com"),
    ]
    assert [r.snippet for r in rows] == ["4 jul 2026 Un texto suficientemente largo", "", ""]


def test_rounding_follows_the_binary_value(value):
    numbers = [2.675, 676.175, 594.575, 0.125, 0.375, -2.675, 1.005, 100.0, 1234567.891, None]
    assert value(N.round_exact, numbers, "double") == [None if x is None else round(x, 2) for x in numbers]
    scaled = [676.175, 2.675, 0.125, 0.135, 4.345, 5.055]
    assert value(N.round_scaled, scaled, "double") == [float(round(np.float64(x), 2)) for x in scaled]
