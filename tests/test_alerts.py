from __future__ import annotations

import itertools
import random
from datetime import date, datetime
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from regionpulse.functions.levels import news_level, quake_level, rain_level, severity
from regionpulse.operators import alerts as A
from regionpulse.operators import contracts as K
from regionpulse.operators import dedupe as D
from regionpulse.operators import quality as Q
from regionpulse.operators import selection as S
from regionpulse.sources import dimensions

NOW = datetime(2026, 7, 10, 12)
SCHEMA = (
    "title string, url string, fecha_dt date, estado string, eventos array<string>, victimas array<string>, "
    "rescate array<string>, `daños` array<string>, criterio_busqueda string"
)


def report(url, estado="lara", day=date(2026, 7, 9), eventos=("lluvi",), v=(), r=(), d=()):
    return ("t", url, day, estado, list(eventos), list(v), list(r), list(d), "q")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def levels(df):
    return {(r.estado, r.tipo_evento): r.nivel_alerta for r in df.collect()}


def test_levels_of_groups(spark):
    rows = [
        report("https://a.com/1", "rojo", v=["victima"]), report("https://www.b.com/1", "rojo", v=["victima"]),
        report("https://a.com/2", "una fuente", v=["victima"]), report("https://a.com/3", "una fuente", v=["victima"]),
        report("https://a.com/4", "danios", d=["escombro"]), report("https://a.com/5", "rescate", r=[" rescat"]),
        report("https://a.com/6", "dos"), report("https://a.com/7", "dos"), report("https://a.com/8", "una"),
        report("https://a.com/9", "solo victima", v=["victima"]),
        report(None, "sin url", v=["victima"]), report(None, "sin url", v=["victima"]),
    ]
    got = levels(A.alert_metrics(frame(spark, rows), 48, NOW))
    assert {k[0]: v for k, v in got.items()} == {
        "rojo": "Rojo", "una fuente": "Amarillo", "danios": "Naranja", "rescate": "Naranja", "dos": "Amarillo",
        "una": "Verde", "solo victima": "Verde", "sin url": "Amarillo",
    }
    assert got == levels(A.alert_metrics(frame(spark, rows), 48, NOW, urls=True))


def test_metrics_row(spark):
    rows = [
        report("https://www.a.com/2", v=["x"]), report("https://a.com/1", day=date(2026, 7, 10), eventos=["lluvi", "sismo"]),
        report("https://a.com/1", eventos=["aguacero"]), report("sin-esquema"), report(None),
        report("https://late.com", day=date(2026, 7, 8)), report("https://undated.com", day=None),
        report("https://nostate.com", estado=None), report("https://noevent.com", eventos=["zzz"]),
    ]
    got = {r.tipo_evento: r for r in A.alert_metrics(frame(spark, rows), 48, NOW, urls=True).collect()}
    rain = got["lluvias"]
    assert (rain.n_noticias, rain.n_fuentes_distintas) == (5, 2)  # '' counts as a source
    assert (rain.tiene_victimas, rain.tiene_rescate_activo, rain.tiene_danios_estructurales) == (True, False, False)
    assert rain.fecha_mas_reciente == date(2026, 7, 10)
    assert rain.urls_relacionadas == "https://a.com/1 | https://www.a.com/2 | sin-esquema"
    assert (rain.ventana_horas, rain.fecha_calculo) == (48, NOW)
    assert got["sismo"].n_noticias == 1 and set(got) == {"lluvias", "sismo"}


def test_large_url_lists_come_in_parts_without_loss(spark):
    rows = [report(f"https://a{i}.com/{i:04d}") for i in range(200)] + [report("https://x.com", "sucre"), report(None, "sucre")]
    df = frame(spark, rows)
    parts = A.alert_url_parts(df, 48, NOW, part_bytes=300).where("estado = 'lara'").collect()
    assert len(parts) > 5 and len({p.parte for p in parts}) == len(parts)
    # No part, and so no task, gets the whole group.
    assert max(len(p.urls) for p in parts) < 1500
    assert sorted(u for p in parts for u in p.urls.split(" | ")) == sorted(r[1] for r in rows[:200])
    assert all(p.urls.split(" | ") == sorted(p.urls.split(" | ")) for p in parts)
    got = A.alert_metrics(df, 48, NOW, part_bytes=300).collect()
    assert sum(r.estado == "lara" for r in got) == len(parts) and {r.n_noticias for r in got if r.estado == "lara"} == {200}
    assert [r.urls_relacionadas for r in got if r.estado == "sucre"] == ["https://x.com"]
    assert sorted(K.prepare_metrics(A.alert_metrics(df, 48, NOW, part_bytes=300)).where("estado = 'lara'").toPandas()["urls_relacionadas"]) == sorted(p.urls for p in parts)


def test_levels_do_without_urls(spark):
    df = A.alert_metrics(frame(spark, [report(f"https://a.com/{i}") for i in range(5)]), 48, NOW)
    assert df.first().urls_relacionadas is None and "collect_list" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_ordered_parts_are_the_text_of_a_group(spark):
    """One group is longer than any part, in more ranges than one: its parts, in order, are the whole sorted text."""
    rng = random.Random(7)
    rows = [report(f"https://a{i % 9}.com/{'x' * rng.randrange(60)}/{i}") for i in range(1500)]
    rows += [report("https://b.com/" + "y" * 900, "sucre"), report("https://b.com/z", "sucre"), report("https://b.com/z", "sucre"), report(None, "zulia")]
    df = frame(spark, rows).repartition(5)
    parts = A.alert_url_ordered(df, 48, NOW, part_bytes=400).collect()
    whole = {(r.estado, r.tipo_evento): r.urls_relacionadas for r in A.alert_metrics(df, 48, NOW, urls=True).collect()}
    for key, text in whole.items():
        mine = sorted((p.parte, p.urls) for p in parts if (p.estado, p.tipo_evento) == key)
        assert " | ".join(urls for _, urls in mine) == text and len({n for n, _ in mine}) == len(mine)
    assert len([p for p in parts if p.estado == "lara"]) > 100
    assert all(len(p.urls) < 400 + 90 for p in parts if p.estado == "lara")


def test_a_large_group_is_one_row(spark):
    urls = [f"https://a{i}.com/{'x' * 4000}" for i in range(400)]
    df = frame(spark, [report(u) for u in urls])
    [row] = A.alert_metrics(df, 48, NOW, urls=True).collect()
    assert row.n_noticias == 400 and len(row.urls_relacionadas) > A.PART_BYTES
    assert row.urls_relacionadas == " | ".join(sorted(urls))


def test_reports_are_scanned_once(spark, tmp_path):
    frame(spark, [report(f"https://a.com/{i}") for i in range(20)]).write.parquet(str(tmp_path / "t"))
    df = A.alert_metrics(spark.read.parquet(str(tmp_path / "t")), 48, NOW, urls=True)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_state_can_be_read_from_the_text(spark):
    df = frame(spark, [report("https://a.com/1", None)]).withColumn("texto_clasificacion", F.lit("lluvia en la guaira"))
    assert levels(A.alert_metrics(df, 48, NOW, states=["lara", "la guaira"])) == {("la guaira", "lluvias"): "Verde"}


def test_empty_input_gives_an_empty_table(spark):
    assert A.alert_metrics(frame(spark, []), 48, NOW).count() == 0


def test_sorting(spark):
    rows = [report(f"https://a.com/{i}", "verde") for i in range(1)]
    rows += [report(f"https://b.com/{i}", "amarillo b") for i in range(2)] + [report(f"https://c.com/{i}", "amarillo a") for i in range(2)]
    rows += [report(f"https://d.com/{i}", "amarillo c") for i in range(3)] + [report("https://e.com", "naranja", d=["x"])]
    got = [r.estado for r in A.sort_alerts(A.alert_metrics(frame(spark, rows), 48, NOW)).collect()]
    assert got == ["naranja", "amarillo c", "amarillo a", "amarillo b", "verde"]


def test_levels_never_drop_when_signs_grow(spark):
    flags = [False, True]
    rows = [
        (v, s, r, d, n) for v, s, r, d, n in itertools.product(flags, [0, 1, 2], flags, flags, [1, 2, 3]) if v or not s
    ]
    df = spark.createDataFrame(rows, "v boolean, s int, r boolean, d boolean, n int")
    sev = {
        (x.v, x.s, x.r, x.d, x.n): x.sev
        for x in df.withColumn("sev", severity(news_level(*map(F.col, "vsrdn")))).collect()
    }
    for a, b in itertools.product(sev, sev):
        if all(x <= y for x, y in zip(a, b, strict=True)):
            assert sev[a] >= sev[b]


def test_threshold_edges(value):
    assert value(rain_level, [1.24, 1.25, 1.70, 2.20, 0.0], "double") == ["VERDE", "AMARILLO", "NARANJA", "ROJO", "VERDE"]
    assert value(lambda c: quake_level(c, F.lit(4.0), F.lit(5.0), F.lit(6.0)), [3.9, 4.0, 5.0, 6.0, None], "double") == [
        "VERDE", "AMARILLO", "NARANJA", "ROJO", "VERDE",
    ]


def alerts(spark, rows):
    return spark.createDataFrame(rows, "estado string, tipo_evento string, nivel_alerta string")


def test_most_severe_event_of_an_article(spark):
    table = alerts(spark, [("lara", "lluvias", "Verde"), ("lara", "sismo", "Rojo"), ("lara", "sequia", "Raro"), ("zulia", "sismo", "Verde"), ("zulia", "lluvias", "Verde")])
    rows = [
        report("1", eventos=["lluvi", "sismo"]), report("2", eventos=["lluvi"]), report("3", eventos=["huracan", "escasez de agua"]),
        report("4", "zulia", eventos=["sismo", "lluvi"]), report("5", "sucre", eventos=["sismo", "huracan"]),
        report("6", None), report("7", eventos=["zzz"]),
    ]
    got = {r.url: (r.tipo_evento, r.nivel_alerta_asociado) for r in S.enrich_with_alert(frame(spark, rows), table).collect()}
    assert got == {
        "1": ("sismo", "Rojo"), "2": ("lluvias", "Verde"), "3": ("sequia", "Raro"), "4": ("lluvias", "Verde"), "5": ("huracan", "Verde"),
    }
    none = {r.url: r.nivel_alerta_asociado for r in S.enrich_with_alert(frame(spark, rows), alerts(spark, [])).collect()}
    assert set(none.values()) == {"Verde"} and len(none) == 5


def test_selection_order_and_merge(spark):
    table = alerts(spark, [("lara", "lluvias", "Rojo"), ("zulia", "sismo", "Naranja")])
    rows = [
        report("a", "zulia", eventos=["sismo"]), report("b", "lara", day=None), report("c", "lara", day=date(2026, 7, 1)),
        report("d", "lara", day=date(2026, 7, 2)), report("e", "sucre", eventos=["sismo", "lluvi"]),
    ]
    sent = spark.createDataFrame([("d",)], "url string")
    got = S.select_news(frame(spark, rows), table, sent, ["sismo", "lluvias"], k=2).orderBy("situacion_pos", "orden")
    assert [(r.situacion, r.url) for r in got.collect()] == [("sismo", "a"), ("sismo", "e"), ("lluvias", "c"), ("lluvias", "b")]
    everything = S.select_news(frame(spark, rows), table, sent, None, k=10)
    assert sorted(r.url for r in everything.collect()) == ["a", "b", "c", "e"]
    # an article of two situations is sent once, for the earlier one
    both = S.select_news(frame(spark, [report("e", "sucre", eventos=["sismo", "lluvi"])]), table, sent, ["lluvias", "sismo"])
    assert [(r.situacion, r.url) for r in both.collect()] == [("lluvias", "e")]


def test_ledger_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "url string")
    assert {r.url for r in S.not_in_ledger(df, df.where("url = 'a'"), "url").collect()} == {"b", None}


def test_alert_key(spark):
    df = A.alert_metrics(frame(spark, [report("https://a.com/1", "la guaira")]), 48, NOW)
    assert S.with_alert_key(df).first().clave == "la guaira|lluvias|2026-07-10|Verde"


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_keep_first_does_not_depend_on_the_layout(spark, partitions):
    rows = [("u1", 3), ("u1", 1), ("u2", 2), (None, 9), (None, 4), ("u1", 2)]
    df = spark.createDataFrame(rows, "url string, p int").repartition(partitions)
    once = D.keep_first(df, "url", ["p"])
    assert sorted(map(tuple, once.collect()), key=str) == [("u1", 1), ("u2", 2), (None, 4)]
    assert sorted(map(tuple, D.keep_first(once, "url", ["p"]).collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def test_groups_are_limited_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS g", "id")
    plan = D.first_per_group(df, ["g"], ["id"], k=5)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange")  # printed top-down
    large = D.first_per_group(df, ["g"], [F.desc("id")], k=2000, rank="r")
    assert large.count() == 100


def test_accumulate_prefers_the_earlier_run(spark):
    old = spark.createDataFrame([("a", "viejo"), ("b", "viejo")], "url string, title string")
    new = spark.createDataFrame([("b", "nuevo", 1), ("c", "nuevo", 2), (None, "nuevo", 3)], "url string, title string, p int")
    got = {r.url: r.title for r in D.accumulate(old, new, ["p"]).collect()}
    assert got == {"a": "viejo", "b": "viejo", "c": "nuevo", None: "nuevo"}
    with_null = old.union(spark.createDataFrame([(None, "viejo")], "url string, title string"))
    assert {r.url for r in D.increment(with_null, new, "url").collect()} == {"c"}


def test_social_variant(spark):
    df = spark.createDataFrame([("a", "p", 1), ("a", "q", 2)], "source_url string, profile_url string, p int")
    row = D.merge_parts(df, ["p"]).collect()
    assert [r.asDict() for r in row] == [{"source_url": "a", "p": 1, "likes": "", "comments": ""}]


def test_contracts(spark):
    df = S.enrich_with_alert(
        frame(spark, [report("https://www.a.com/1", "la guaira"), report(None, "la guaira", day=None)]), alerts(spark, [("la guaira", "lluvias", "Rojo")])
    )
    rows = {r.enlace: r for r in K.prepare_news(df).collect()}
    assert rows["https://www.a.com/1"].asDict() == {
        "fecha": "2026-07-09", "titulo": "t", "enlace": "https://www.a.com/1", "estado": "la_guaira", "tipo_evento": "lluvias",
        "medio": "a.com", "nivel_alerta_asociado": "rojo", "criterio_busqueda": "q",
    }
    assert (rows[""].fecha, rows[""].medio) == ("", "")
    conformed = K.conform_output(K.prepare_news(df), "news")
    assert dict(conformed.dtypes) == {**K.contract_fields("news"), "fecha_carga": "date"}
    assert {r.fecha for r in conformed.collect()} == {date(2026, 7, 9), None}


def test_choice_violations(spark):
    choices = dimensions.choices_dim(
        spark.createDataFrame([("la guaira", "c", 0.0, 0.0, 0)], "estado string, capital string, lat double, lon double, ord int"),
        dimensions.distinct_event_types(dimensions.canonical_dim(spark)),
    )
    assert {(r.list_name, r.name, r.label) for r in choices.where("list_name IN ('estados', 'si_no')").collect()} == {
        ("estados", "la_guaira", "La guaira"), ("si_no", "si", "Sí"), ("si_no", "no", "No"),
    }
    df = spark.createDataFrame([("la_guaira", "sismo", "rojo"), ("La Guaira", "otro", "rojo"), (None, "otro", "verde")], "estado string, tipo_evento string, nivel_alerta_asociado string")
    assert {(r.campo, r.valor, r.n) for r in K.choice_violations(df, "news", choices).collect()} == {("estado", "La Guaira", 1), ("tipo_evento", "otro", 2)}


def test_submission_xml_escapes_and_omits(spark):
    df = spark.createDataFrame([("a & b <c>", "", None, 3)], "titulo string, vacio string, nulo string, n int")
    xml = K.submission_xml(df, "avisos", "f1").first().xml
    root = ElementTree.fromstring(xml)
    assert (root.tag, root.attrib) == ("avisos", {"id": "avisos"})
    assert [child.tag for child in root] == ["formhub", "titulo", "n", "meta"]
    assert (root.findtext("titulo"), root.findtext("n"), root.findtext("formhub/uuid")) == ("a & b <c>", "3", "f1")
    assert root.findtext("meta/instanceID").startswith("uuid:")


def test_counters(spark):
    df = frame(spark, [report("a"), report("a", None), report(None, day=None)])
    assert Q.count_news(df).first().asDict() == {"filas": 3, "sin_estado": 1, "sin_fecha": 1}
    assert Q.dedupe_counters(df, "url").first().asDict() == {"antes": 3, "despues": 2}
    assert Q.ledger_counters(df, spark.createDataFrame([("a",)], "url string"), "url").first().asDict() == {"filas": 3, "omitidas": 2}
    watched, observation = Q.observed(df, "news", Q.news_counters())
    watched.collect()
    assert observation.get["sin_estado"] == 1


def test_unmapped_keywords(spark):
    lexicon = dimensions.lexicon_dim(spark, {"eventos": [" crecida", "sismo"], "otra": ["x"]})
    assert [r.keyword for r in dimensions.unmapped_keywords(lexicon, dimensions.canonical_dim(spark)).collect()] == [" crecida"]
    assert dimensions.load_lexicon(dimensions.lexicon_dim(spark, {"daños": [" daño", "Invasión"]})) == {"daños": [" dano", "invasion"]}
    with pytest.raises(ValueError):
        dimensions.plan_values(spark.range(10), "id", limit=5)
