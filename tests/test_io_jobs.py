from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from regionpulse.operators import searchgrid as G
from regionpulse.operators.classify import tag_state
from regionpulse.plans import news as P
from regionpulse.sources import dimensions, ledgers, readers, sinks
from regionpulse.sources.schemas import LEDGER_URLS, PROCESSED_NEWS, RAW_NEWS

HEADER = "page_number,rank,title,url,displayed_url,fecha,snippet,snippet_full,rich_type,criterio_busqueda"


def part(folder, name, text, bom=False):
    (folder / name).write_text(("﻿" if bom else "") + text, encoding="utf-8")


def test_parts_by_header(spark, tmp_path):
    part(tmp_path, "b_part1.csv", HEADER + "\n" + "1,1,uno,u1,d,2026-07-04,s,texto,r,q\n" + "1,2,dos,u2,d,,s,nan,r,q,sobra,mas\n"
         + '1,3,"con\nsalto, y ""comillas""",u3,d,,s,ñ,r,q\n' + "x,4,corta,u4\n", bom=True)
    part(tmp_path, "a_part2.csv", "url,title,extra\nu1,primero,e\n,sin url,e\n,otro sin url,e\n")
    part(tmp_path, "c_part3.csv", "")
    part(tmp_path, "otro.csv", "url\nno\n")
    paths = readers.find_parts(spark, str(tmp_path), "*_part*.csv")
    assert [p.rsplit("/", 1)[1] for p in paths] == ["a_part2.csv", "b_part1.csv"]
    raw = readers.read_raw_parts(spark, paths)
    rows = raw.orderBy(readers.SOURCE_ORDER).collect()
    assert [r.title for r in rows] == ["primero", "sin url", "otro sin url", "uno", 'con\nsalto, y "comillas"', "corta"]
    assert [r.page_number for r in rows] == [None, None, None, 1, 1, None]
    assert rows[5].criterio_busqueda is None and rows[4].snippet_full == "ñ" and rows[3].fecha == "2026-07-04"
    merged = {r.url: r.title for r in P.collect_raw(spark, paths).collect()}
    assert merged == {"u1": "primero", None: "sin url", "u3": 'con\nsalto, y "comillas"', "u4": "corta"}
    assert "displayed_url" not in P.collect_raw(spark, paths).columns
    old = spark.createDataFrame([("u3", "viejo")], "url string, title string")
    again = {r.url: r.title for r in P.collect_raw(spark, paths, old).collect()}
    assert again == {**merged, "u3": "viejo"}
    quick = P.collect_raw(spark, paths, old, accumulated_is_unique=True)
    assert {r.url: r.title for r in quick.collect()} == again


def test_part_order_does_not_change_the_result(spark, tmp_path):
    for name in ("a", "b", "c"):
        part(tmp_path, f"{name}_part.csv", "url,title\n" + "".join(f"u{i},{name}{i}\n" for i in range(5)))
    paths = readers.find_parts(spark, str(tmp_path))
    for order in (paths, paths[::-1]):
        assert {r.title for r in P.collect_raw(spark, order).collect()} == {f"a{i}" for i in range(5)}


def test_no_parts_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.find_parts(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        readers.find_parts(spark, str(tmp_path / "nada"))


def test_absent_tables_are_empty(spark, tmp_path):
    assert readers.read_accumulated(spark, str(tmp_path / "x"), RAW_NEWS).count() == 0
    assert ledgers.read_sent_ledger(spark, str(tmp_path / "x")).count() == 0
    assert ledgers.read_alert_ledger(spark, str(tmp_path / "y")).columns == ["clave"]


def test_list_literals(value):
    texts = ["['a', 'b']", "['a', \"b'c\"]", "['a',", "", None, "{'a': 1}", "('a',)", "[]", "nan"]
    assert value(readers.parse_list_literal, texts) == [["a", "b"], ["a", "b'c"], [], [], [], [], [], [], []]


def test_rain_and_quake_documents(spark, tmp_path):
    docs = [
        {"estado": "lara", "daily": {"time": ["2024-02-29", "2024-03-01"], "precipitation_sum": [1.5, None]}},
        {"estado": "zulia", "daily": {}}, {"estado": "sucre"},
    ]
    (tmp_path / "rain.json").write_text("\n".join(map(json.dumps, docs)))
    rows = readers.read_rain_json(spark, str(tmp_path / "rain.json")).orderBy("fecha").collect()
    assert [tuple(r) for r in rows] == [("lara", date(2024, 2, 29), 1.5), ("lara", date(2024, 3, 1), 0.0)]
    geo = {"type": "FeatureCollection", "features": [
        {"id": "a", "properties": {"time": 1700000000123, "mag": 4.5, "place": "aquí", "url": "u"}, "geometry": {"type": "Point", "coordinates": [-66.9, 10.5, 7.0]}},
        {"id": "b", "properties": {"time": 1700000000000}, "geometry": {"coordinates": [-60, 1]}},
    ]}
    (tmp_path / "q.json").write_text(json.dumps(geo, indent=1))
    a, b = readers.read_quake_geojson(spark, str(tmp_path / "q.json"), multiline=True).orderBy("id_evento").collect()
    lines = [json.dumps(geo), *map(json.dumps, geo["features"]), '{"other": 1}']
    (tmp_path / "lines.json").write_text("\n".join(lines))
    by_line = readers.read_quake_geojson(spark, str(tmp_path / "lines.json")).orderBy("id_evento").collect()
    assert by_line == [a, a, b, b]
    assert tuple(a) == ("a", datetime(2023, 11, 14, 22, 13, 20, 123000), 4.5, 7.0, "aquí", 10.5, -66.9, "u")
    assert (b.magnitud, b.profundidad_km, b.lugar, b.url_detalle, b.lat, b.lon) == (None, None, "", "", 1.0, -60.0)


def test_geojson_that_spans_lines_is_not_lost(spark, tmp_path):
    geo = {"features": [{"id": "a", "properties": {"mag": 4.5, "time": 1700000000123}, "geometry": {"coordinates": [1, 2, 3]}}]}
    (tmp_path / "q.json").write_text(json.dumps(geo, indent=1))
    with pytest.raises(Exception, match="multiline=True"):
        readers.read_quake_geojson(spark, str(tmp_path / "q.json")).collect()
    assert readers.read_quake_geojson(spark, str(tmp_path / "q.json"), multiline=True).count() == 1


def test_ledger_batches_repeat_safely(spark, tmp_path):
    path, compact = str(tmp_path / "l"), str(tmp_path / "c")
    keys = spark.createDataFrame([("a",), ("b",), ("a",)], LEDGER_URLS)
    ledgers.record_batch(keys, "url", path, "r1")
    ledgers.record_batch(keys, "url", path, "r1")
    ledgers.record_batch(spark.createDataFrame([("b",), ("c",)], LEDGER_URLS), "url", path, "r2")
    assert sorted(r.url for r in ledgers.read_sent_ledger(spark, path).collect()) == ["a", "b", "c"]
    ledgers.record_batch(spark.createDataFrame([("d",)], LEDGER_URLS), "url", path, "r2")
    assert sorted(r.url for r in ledgers.read_sent_ledger(spark, path).collect()) == ["a", "b", "c", "d"]
    ledgers.compact_ledger(spark, path, compact, "url")
    assert sorted(r.url for r in ledgers.read_sent_ledger(spark, compact).collect()) == ["a", "b", "c", "d"]
    union = ledgers.ledger_union(keys, spark.createDataFrame([("z",)], LEDGER_URLS), "url")
    assert sorted(r.url for r in union.collect()) == ["a", "b", "z"]


def test_increment_versions_and_snapshots(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "url string, n int")
    for _ in range(2):
        sinks.append_increment(rows, str(tmp_path / "t"), "url")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    first = sinks.write_version(rows, str(tmp_path / "v"))
    second = sinks.write_version(spark.read.parquet(first).where("n > 1"), str(tmp_path / "v"))
    assert spark.read.parquet(second).count() == 2 and first != second
    for day in (1, 1, 2):
        sinks.append_snapshot(rows.withColumn("fecha_calculo", F.lit(f"2026-07-0{day} 10:00:00").cast("timestamp")), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).groupBy("fecha_calculo_dia").count().count() == 2
    assert spark.read.parquet(str(tmp_path / "s")).count() == 9
    sinks.export_csv(rows, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["url", "n"]


def test_query_clauses_and_grid(spark):
    assert G.merge_clauses(["a", "b"], {"a": "(x OR y)", "b": "z"}) == "(x OR y OR z)"
    with pytest.raises(ValueError):
        G.merge_clauses("nieve")
    media = spark.createDataFrame([("El Diario", 0), ("La Voz", 1)], "medio string, ord int")
    grid = G.query_grid(media, "(x)", exclusions=" -e", sites=["ve", "co"], dates=("2026-07-01", "2026-07-02")).orderBy("ord")
    assert grid.first().criterio_busqueda == 'venezuela "El Diario" (x) -e site:ve after:2026-07-01 before:2026-07-02'
    assert [(r.ord, r.worker) for r in G.assign_workers(grid, 3).orderBy("ord").collect()] == [(0, 0), (1, 1), (2, 2), (3, 0)]
    days = G.query_days(spark.createDataFrame([("lara",)], "estado string"), ["s.com"], date(2026, 7, 1), date(2026, 7, 2)).orderBy("fecha")
    assert [r.criterio_busqueda for r in days.collect()] == [
        "site:s.com venezuela vzla venzolan lara after:2026-07-01 before:2026-07-02",
        "site:s.com venezuela vzla venzolan lara after:2026-07-02 before:2026-07-03",
    ]
    assert G.tag_hits(media, "q").first().criterio_busqueda == "q"


CATEGORIES = {f.name: [] for f in PROCESSED_NEWS if f.dataType.simpleString() == "array<string>"}
SETTINGS = P.NewsSettings(
    lexicon={**CATEGORIES, "eventos": ["sismo", "lluvi", " inund"], "victimas": ["falleci"], "rescate": [" rescat"], "daños": [" colaps"]},
    gazetteer=["lara", "la guaira", "maracay"],
    states=["lara", "la guaira"],
    situation=["lluvias", "sismo"],
    window_hours=72,
    per_situation=2,
)
NOW = datetime(2026, 7, 10, 12)


def hit(i, url, title, snippet, fecha):
    return (1, i, title, url, "d", fecha, "s", snippet, "r", "q")


def news_job(spark, folder):
    hits = [
        hit(1, "https://www.a.com/1", "Lluvia en Lara", "9 jul 2026 Fallecieron dos por lluvias en Lara, colapsó un puente", "2026-07-09"),
        hit(2, "https://b.com/1", "Lara", "hace 1 día Lluvias; 3 fallecidos en Lara.", "hace 1 dia"),
        hit(3, "https://c.com/1", "Sismo", "8 jul 2026 Sismo sacude La Guaira", "2026-07-08"),
        hit(4, "https://c.com/2", "Sismo", "9 jul 2026 Otro sismo en La Guaira", "2026-07-09"),
        hit(5, "https://d.com/1", "Viejo", "1 ene 2026 Sismo en Lara", "2026-01-01"),
        hit(6, "https://facebook.com/x", "Red", "9 jul 2026 Lluvia en Lara", "2026-07-09"),
        hit(7, "https://e.com/1", "Sin fecha", "Lluvia en Lara", "2026-07-09"),
        hit(8, "https://f.com/1", "Otro país", "9 jul 2026 Lluvia en Bogotá", "2026-07-09"),
        hit(9, "https://g.com/1", "Sin estado", "9 jul 2026 Lluvia en Maracay", "2026-07-09"),
        hit(10, "https://h.com/1", None, "9 jul 2026 Rescataron a vecinos tras lluvia en Lara", "2026-07-09"),
    ]
    raw = spark.createDataFrame(hits, RAW_NEWS)
    return P.run_news(raw, SETTINGS, NOW, folder, "2026-07-01", "2026-07-10")


def test_news_job(spark, tmp_path):
    processed, alerts = news_job(spark, str(tmp_path / "out"))
    rows = {r.url: r for r in processed.collect()}
    assert set(rows) == {"https://www.a.com/1", "https://b.com/1", "https://c.com/1", "https://c.com/2", "https://g.com/1", "https://h.com/1"}
    one = rows["https://www.a.com/1"]
    assert one.texto_clasificacion == "lluvia en lara 9 jul 2026 fallecieron dos por lluvias en lara colapso un puente"
    assert (one.estado, one.red_social, one.eventos, one.victimas, one.rescate) == ("lara", "web", ["lluvi"], ["falleci"], [])
    assert one["daños"] == [" colaps"] and one.fecha_dt == date(2026, 7, 9)
    assert rows["https://b.com/1"].fecha_dt == date(2026, 7, 9)
    assert rows["https://g.com/1"].estado is None
    assert rows["https://h.com/1"].texto_clasificacion.startswith("9 jul 2026 rescataron")
    assert {f.name: f.dataType for f in processed.schema} == {f.name: f.dataType for f in PROCESSED_NEWS}
    got = [(r.estado, r.tipo_evento, r.nivel_alerta, r.n_noticias, r.n_fuentes_distintas) for r in alerts.collect()]
    assert got == [("lara", "lluvias", "Rojo", 3, 3), ("la guaira", "sismo", "Amarillo", 2, 1)]
    summaries = P.news_summaries(processed, {"eventos": {"lluvias": ["lluvi"]}})
    assert [(r.etiqueta, r.n) for r in summaries["tipos_eventos"].collect()] == [("Lluvias", 4), ("Sismo", 2)]
    assert {r.categoria: r.n for r in summaries["nivel_afectacion"].collect()} == {"Victimas": 2, "Rescate": 1, "Daños": 1}
    assert summaries["zonas_afectadas"].count() == 8 and summaries["centros_atencion"].count() == 0
    placed = processed.withColumns(
        {"lugares_clean": F.array(F.lit("Lara"), F.lit("Coro")), "autoridades_actores": F.array(F.lit("x"))}
    )
    places = P.place_summaries(placed, ["lara"])
    assert places["total_lugares"].first().total == 12 and places["total_actores"].first().total == 6
    assert [r.lugar for r in places["top_destinos"].collect()] == ["Coro"]
    assert [r.lugar for r in places["top_estados"].collect()] == ["Lara"]
    assert [tuple(r) for r in places["top_actores"].collect()] == [("x", 6)]
    assert tag_state(processed.drop("estado"), SETTINGS.states).where("estado = 'lara'").count() == 3


def test_publication_records_only_what_was_accepted(spark, tmp_path):
    processed, alerts = news_job(spark, str(tmp_path / "out"))
    urls, keys = str(tmp_path / "urls"), str(tmp_path / "keys")

    def accept(batch):
        return [(201, "")] * len(batch)

    def reject_b(batch):
        return [(500, "no") if "b.com" in link else (200, "") for link in batch["enlace"]]

    def run(batch, deliver):
        return P.publish_news(processed, alerts, SETTINGS, urls, keys, batch, deliver, accept, str(tmp_path / batch))

    news, sent_alerts = run("r1", reject_b)
    assert news.count() == 4 and sinks.failed(news).count() == 1 and sent_alerts.count() == 2
    sent = {r.url for r in ledgers.read_sent_ledger(spark, urls).collect()}
    assert sent == {"https://h.com/1", "https://c.com/1", "https://c.com/2"}
    assert {r.clave for r in ledgers.read_alert_ledger(spark, keys).collect()} == {"lara|lluvias|2026-07-10|Rojo", "la guaira|sismo|2026-07-10|Amarillo"}
    # the failed article and the one that did not fit the first time follow; alerts are known already
    news, sent_alerts = run("r2", accept)
    assert {r.row_id for r in news.collect()} == {"https://b.com/1", "https://www.a.com/1"}
    assert sent_alerts.count() == 0
    news, sent_alerts = run("r3", accept)
    assert news.count() == 0 and sent_alerts.count() == 0


def test_processed_news_by_day(spark, tmp_path):
    processed, _ = news_job(spark, str(tmp_path / "out"))
    sinks.write_news(processed, str(tmp_path / "n"))
    back = spark.read.parquet(str(tmp_path / "n")).where("fecha_particion = DATE '2026-07-08'")
    assert back.count() == 1
    assert "PartitionFilters: [isnotnull(fecha_particion" in back._jdf.queryExecution().executedPlan().toString()
    assert readers.read_processed(spark, str(tmp_path / "n")).count() == 6


def test_dimensions_from_settings(spark):
    states = dimensions.states_dim(spark, {"lara": {"capital": "B", "lat": 1, "lon": 2}})
    assert tuple(states.first()) == ("lara", "B", 1.0, 2.0, 0)
    assert dimensions.event_types() == ["huracan", "lluvias", "sequia", "sismo"]
    assert dimensions.is_small(states, 1) and not dimensions.is_small(spark.range(5), 3)
    assert dimensions.load_mapping(spark.createDataFrame([("a", "b")], "raw string, clean string"), "raw", "clean") == {"a": "b"}
