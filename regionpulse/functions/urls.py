"""URL functions: domain, social network, redirect targets and link resolution."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Social networks recognised in a URL (matched as patterns).
SOCIAL_NETWORKS = ["facebook", "instagram", "x.com", "tiktok", "threads", "youtube"]

# Substrings of links that are never results.
LINK_NOISE = ["duckduckgo.com", "javascript:", "#"]
TITLE_LINK_NOISE = ["duckduckgo.com", "javascript:", "#", "/settings", "/maps"]

_AUTHORITY = r"^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)"


def domain(url: Column) -> Column:
    """Network location in lower case without a leading ``www.``.

    Port and user info stay.  Null and empty URLs give null, a URL without an
    authority gives ``''``.
    """
    authority = F.regexp_extract(F.lower(F.nullif(url, F.lit(""))), _AUTHORITY, 1)
    return F.regexp_replace(authority, r"^www\.", "")


def social_network(url: Column) -> Column:
    """First social network named in the URL, else ``web``."""
    found = F.regexp_extract(url, "(?i)(" + "|".join(SOCIAL_NETWORKS) + ")", 1)
    return F.lower(F.coalesce(F.nullif(found, F.lit("")), F.lit("web")))


def clean_redirect(url: Column) -> Column:
    """Target of a ``url?q=`` redirect, else the URL itself; empty gives null."""
    targets = [
        F.nullif(F.regexp_extract(url, pattern, 1), F.lit(""))
        for pattern in (r"/url\?q=(https?://[^&]+)", r"url\?q=(https?://[^&]+)")
    ]
    return F.coalesce(*targets, F.nullif(url, F.lit("")))


def resolve_href(href: Column, base: Column) -> Column:
    """Absolute form of a link on the page at ``base``."""
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    folder = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(?:/[^?#]*/)?)", 1)
    page = F.regexp_extract(base, r"^([^#]*)", 1)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("#"), F.concat(page, href))
        .when(folder.endswith("/"), F.concat(folder, href))
        .otherwise(F.concat(folder, F.lit("/"), href))
    )


def contains_none(c: Column, parts: list[str]) -> Column:
    """True where the text has none of the given substrings."""
    result = F.lit(True)
    for part in parts:
        result = result & ~F.contains(c, F.lit(part))
    return result
