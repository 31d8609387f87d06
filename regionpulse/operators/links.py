"""Search hits read from stored result pages."""

from __future__ import annotations

import json
import sys
from collections.abc import Callable
from datetime import datetime
from functools import cache, reduce
from html.entities import html5

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regionpulse.functions.dates import with_snippet_date
from regionpulse.functions.html import page_hits as html_page_hits
from regionpulse.functions.html import parse, result_blocks
from regionpulse.functions.text import strip
from regionpulse.functions.urls import clean_redirect, resolve_href
from regionpulse.operators.filters import held, valid_link

ANCHOR = r"""(?is)<a\s[^>]*?href\s*=\s*["']([^"']*)["'][^>]*>(.*?)</a>"""

REFERENCE = r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


@cache
def _named_references() -> str:
    """Named character references of HTML and their text, as JSON."""
    return json.dumps({f"&{name}": text for name, text in html5.items() if name.endswith(";")})


# The references that nearly all pages use.  The ampersand comes last, so that what it yields stays.
COMMON_REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&#39;": "'", "&nbsp;": "\u00a0", "&amp;": "&"}
_RARE = r"&(?!(?:" + "|".join(name[1:-1] for name in COMMON_REFERENCES) + r");)" + REFERENCE[1:]


def decode_entities(c: Column) -> Column:
    """Decode character references, named and numeric ones; unknown ones stay.

    Common ones are replaced in the text; only a text that holds another one is cut up and looked up piece by piece.
    """
    names = F.from_json(F.lit(_named_references()), "map<string,string>")
    parts = F.split(c, rf"(?={REFERENCE})|(?<={REFERENCE})")

    def decoded(part: Column) -> Column:
        digits = F.regexp_extract(part, r"^&#[xX]?([0-9a-fA-F]+);$", 1)
        code = F.when(F.lower(F.substring(part, 3, 1)) == "x", F.conv(digits, 16, 10)).otherwise(digits).try_cast("long")
        known = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        numeric = F.when(known, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
        return F.when(~F.startswith(part, F.lit("&")), part).otherwise(F.coalesce(F.try_element_at(names, part), numeric, part))

    common = reduce(lambda text, pair: F.replace(text, F.lit(pair[0]), F.lit(pair[1])), COMMON_REFERENCES.items(), c)
    whole = F.array_join(F.transform(parts, decoded), "")
    return F.when(~F.contains(c, F.lit("&")), c).when(c.rlike(_RARE), whole).otherwise(common)


def plain_text(html: Column) -> Column:
    """Visible text of a piece of HTML, white space collapsed."""
    text = F.regexp_replace(html, r"<[^>]*>", "")
    return strip(F.regexp_replace(decode_entities(text), r"[\s\u00A0]+", " "))


def _explode_first_links(pages: DataFrame, links: Column, others: list[str], url: str) -> DataFrame:
    """One row per link, the first per address, in page order; ``_i`` counts those kept.

    ``links`` is an array of structs with an ``href``.  Sorting by address and
    place brings equal addresses together, so the work grows with the links and
    not with their square.
    """
    placed = F.transform(links, lambda link, i: F.struct(link["href"].alias("href"), i.alias("i"), link.alias("link")))
    staged = held(pages.select(*others, F.col(url).alias("pagina"), F.array_sort(placed).alias("_sorted")), "_sorted", F.col("_sorted"))
    first = F.filter("_sorted", lambda x, k: (k == 0) | (F.get("_sorted", k - 1)["href"] != x["href"]))
    in_order = F.array_sort(F.transform(first, lambda x: F.struct(x["i"].alias("i"), x["link"].alias("link"))))
    return (
        staged.select(*others, "pagina", F.posexplode_outer(in_order["link"]).alias("_i", "_link"))
        .where(F.col("_link").isNotNull())
    )


def extract_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Plain links of each page as hits, ranked in page order, repeated addresses once.

    A page is handled inside its row, so nothing is shuffled.
    """
    others = [c for c in pages.columns if c not in (url, html)]
    anchors = F.regexp_extract_all(F.col(html), F.lit(ANCHOR), F.lit(0))

    def link(anchor: Column) -> Column:
        return F.struct(
            resolve_href(decode_entities(F.regexp_extract(anchor, ANCHOR, 1)), F.col(url)).alias("href"),
            plain_text(F.regexp_extract(anchor, ANCHOR, 2)).alias("title"),
        )

    links = F.filter(F.transform(anchors, link), lambda a: valid_link(a["title"], a["href"]))
    return _explode_first_links(pages, links, others, url).select(
        *others,
        "pagina",
        (F.col("_i") + 1).alias("rank"),
        F.col("_link.title").alias("title"),
        clean_redirect(F.col("_link.href")).alias("url"),
    )


def _reader(read: Callable[[str | None, str | None], list[tuple[str, str, str, str]]]):
    schema = "array<struct<title:string,href:string,displayed_url:string,snippet:string>>"

    # Row by row: an Arrow batch would hold thousands of whole pages and all their hits at once.
    return F.udf(lambda page, address: read(page, address), schema, useArrow=False)


def _hits(pages: DataFrame, now: datetime, url: str, html: str, read) -> DataFrame:
    others = [c for c in pages.columns if c not in (url, html)]
    rows = pages.select(*others, F.col(url).alias("pagina"), _reader(read)(F.col(html), F.col(url)).alias("_hits"))
    rows = rows.select(*others, "pagina", F.posexplode("_hits").alias("_i", "_hit")).select(*others, "pagina", (F.col("_i") + 1).alias("rank"), "_hit.*")
    return with_snippet_date(rows, "snippet", "fecha", now).select(
        *others,
        "pagina",
        "rank",
        "title",
        clean_redirect(F.col("href")).alias("url"),
        "displayed_url",
        "fecha",
        "snippet",
        F.col("snippet").alias("snippet_full"),
        F.lit("").alias("rich_type"),
    )


def extract_results(pages: DataFrame, now: datetime, url: str = "url", html: str = "html") -> DataFrame:
    """Result blocks of stored pages as raw hits, with title, address, snippet and date.

    Elements nest, so the page is read by a small parser in Python; only the page and its address go there.  Blocks
    without a usable link are dropped and repeated addresses of a page kept once; ``rank`` counts the hits that remain.
    The snippet is the first valid text of the first selector that has one.
    """
    return _hits(pages, now, url, html, lambda page, base: result_blocks(parse(page), base or ""))


def page_hits(pages: DataFrame, now: datetime, url: str = "url", html: str = "html") -> DataFrame:
    """:func:`extract_results`, and for a page without any result its plain links."""
    return _hits(pages, now, url, html, html_page_hits)


# The functions travel to the executors by value, so that these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
