from __future__ import annotations

import html as stdlib
from datetime import datetime

from regionpulse.functions.html import page_hits, parse, plain_links, result_blocks
from regionpulse.operators import links as L

BASE = "https://search.example/q?x=1"
LONG = "Un texto bastante largo para ser un fragmento"


def test_nested_blocks_and_second_choices():
    page = f"""
    <article data-testid=result><h2><a href="/uno?a=1&amp;b=2"> Nota <b>uno</b></a></h2>
      <cite> </cite><span class="result__url">uno.ve</span>
      <div data-result="snippet">corto</div><div data-result="snippet"><div>{LONG}</div><div> y m&aacute;s</div></div></article>
    <div data-testid="result"><a class="big result__a" href="https://dos.ve/">Dos</a><div data-result="snippet">Bloquea este sitio {LONG}</div>
      <p class="snippet">{LONG} dos</p></div>
    <li data-layout="organic"><h2><a href="https://tres.ve/#x">con marca</a></h2></li>
    <li data-layout="organic"><h2><a href="https://dos.ve/">otra vez</a></h2></li>
    <li data-layout="organic"><p>sin enlace</p></li>"""
    hits = result_blocks(parse(page), BASE)
    assert hits == [
        ("Nota uno", "https://search.example/uno?a=1&b=2", "uno.ve", f"{LONG} y más"),
        ("Dos", "https://dos.ve/", "", f"{LONG} dos"),
    ]


def test_other_block_marks_and_links_without_blocks():
    page = '<div class="results"><article><a href="https://a.ve">A</a></article></div><a href="https://b.ve/largo">Un enlace muy largo</a>'
    assert [h[1] for h in page_hits(page, BASE)] == ["https://a.ve"]
    alone = '<a href="https://b.ve/largo">Un enlace muy largo</a><a href="https://b.ve/largo">Un enlace muy largo</a><a href="x">corto</a><script>"<a href=\'https://c.ve\'>no es un enlace</a>"</script>'
    assert page_hits(alone, BASE) == plain_links(parse(alone), BASE) == [("Un enlace muy largo", "https://b.ve/largo", "", "")]
    for odd in (None, "", "<", "<div><p>", "</div></p>", "<a href>", "<div " * 500, "<div>" * 5000 + "x"):
        assert page_hits(odd, BASE) == []


def test_character_references(value):
    texts = ["a &amp; b", "&oacute;&ntilde;&#233;&#x27;&#X1F600;", "&unknown; &#0; &#xD800; & &;", "&amp;lt;", "&lt;&gt;&quot;&nbsp;x", None, "sin nada"]
    want = ["a & b", "óñé'😀", "&unknown; &#0; &#xD800; & &;", "&lt;", stdlib.unescape("&lt;&gt;&quot;&nbsp;x"), None, "sin nada"]
    assert value(L.decode_entities, texts) == want


def test_first_of_many_links_in_page_order(spark):
    anchors = "".join(f'<a href="https://x.ve/{i % 700}">enlace número {i}</a>' for i in range(2000))
    df = spark.createDataFrame([("https://p.ve", anchors)], "url string, html string")
    got = L.extract_links(df).orderBy("rank").collect()
    assert [r.title for r in got] == [f"enlace número {i}" for i in range(700)] and [r.rank for r in got] == list(range(1, 701))


def test_hits_as_rows(spark):
    page = f'<article data-testid="result"><h2><a href="https://a.ve">T</a></h2><div data-result="snippet">3 jul 2026 {LONG}</div></article>'
    rows = L.page_hits(spark.createDataFrame([(1, BASE, page), (2, BASE, None)], "id int, url string, html string"), datetime(2026, 7, 4)).collect()
    assert [(r.id, r.rank, r.url, r.fecha) for r in rows] == [(1, 1, "https://a.ve", "2026-07-03")]


def test_pages_reach_python_in_small_batches(spark):
    """The reader holds some pages at a time, not a whole Arrow batch of them; a Python worker's memory does not grow with the table."""
    pages = spark.range(3).selectExpr("id AS doc_id", "'https://a.example/' AS url", "'<html></html>' AS html")
    for read in (L.extract_results, L.page_hits):
        plan = read(pages, datetime(2026, 7, 4))._jdf.queryExecution().executedPlan().toString()
        assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
