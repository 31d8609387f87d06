"""Text functions: transliteration, normalisation, keyword and name matching.

Everything is a built-in expression.  Term lists are compiled into one prefix
tree regular expression, so the work per character does not grow with the
length of the list.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

NON_ASCII = r"[^\x00-\x7F]"

# Signs turned into a space, and signs deleted, by normalisation.
SIGNS_TO_SPACE = '@#-_"!¡?()/|*'
SIGNS_DELETED = ".,"

# Transliterations that decomposition does not give.
ONE_TO_ONE = {
    "¡": "!", "¿": "?", "´": "'", "‘": "'", "’": "'", "′": "'", "“": '"', "”": '"', "″": '"',
    "¨": '"', "‐": "-", "‑": "-", "–": "-", "¯": "-", "•": "*", "·": "*", "¦": "|", "¬": "!",
    "¸": ",", "×": "x", "÷": "/", "µ": "u", "¶": "P", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D",
    "ł": "l", "Ł": "L", "ı": "i", "ð": "d", "Ð": "D",
}
ONE_TO_MANY = {
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th", "…": "...",
    "—": "--", "«": "<<", "»": ">>", "„": ",,", "€": "EUR", "©": "(c)", "®": "(r)", "°": "deg",
}


def empty_strings() -> Column:
    """The empty ``array<string>``."""
    return F.array().cast("array<string>")


# Latin letters for Greek and Cyrillic ones, in lower case.
GREEK = dict(zip("αβγδεζηικλμνξοπρσςτυφω", "abgdeziiklmnxoprsstyfo")) | {"θ": "th", "χ": "ch", "ψ": "ps"}
CYRILLIC = dict(zip("абвгдезийклмнопрстуфыэ", "abvgdeziiklmnoprstufye")) | {
    "ё": "io", "ж": "zh", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "'", "ь": "'", "ю": "iu", "я": "ia",
}


@cache
def _decompositions() -> dict[str, str]:
    """Every character of the basic plane whose compatibility decomposition holds ASCII characters -> these."""
    table = {}
    for code in (*range(0x00A0, 0xD800), *range(0xF900, 0x10000)):
        parts = unicodedata.normalize("NFKD", chr(code))
        base = "".join(p for p in parts if not unicodedata.combining(p) and p.isascii())
        if base:
            table[chr(code)] = base
    return table


@cache
def _other_scripts() -> dict[str, str]:
    """Greek and Cyrillic letters of either case, with and without marks -> Latin letters."""
    small = {**GREEK, **CYRILLIC}
    table = {**small, **{k.upper(): v.capitalize() for k, v in small.items() if k != "ς"}}
    for code in (*range(0x0370, 0x0400), *range(0x0400, 0x0500), *range(0x1F00, 0x2000)):
        base = "".join(p for p in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(p))
        if base in table:
            table.setdefault(chr(code), table[base])
    return table


@cache
def _decomposed_letters() -> dict[str, str]:
    """Character -> ASCII character, where the decomposition is one."""
    return {k: v for k, v in _decompositions().items() if len(v) == 1}


def _ranges(chars: Sequence[str], apart: Sequence[str]) -> str:
    """A character class around ``chars`` in few ranges, none of which holds one of ``apart``."""
    others = {ord(ch) for ch in apart}
    spans: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if spans and code - spans[-1][1] < 64 and not others & set(range(spans[-1][1], code)):
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "[" + "".join(f"\\u{low:04x}-\\u{high:04x}" for low, high in spans) + "]"


def _expand(c: Column, tested: Column, table: dict[str, str]) -> Column:
    """``c`` with rare characters replaced by several, where ``tested``, its origin, holds one of them."""
    pairs = F.expr("map(" + ", ".join(f"'{k}', '{v}'" for k, v in table.items() if "'" not in v and "\\" not in v) + ")")
    highest_plain = chr(min(map(ord, table)) - 1)
    letters = F.transform(F.split(c, ""), lambda ch: F.when(ch <= highest_plain, ch).otherwise(F.coalesce(F.try_element_at(pairs, ch), ch)))
    guard = _ranges(list(table), [*ONE_TO_ONE, *ONE_TO_MANY, *_decomposed_letters()])
    return F.when(tested.rlike(guard), F.array_join(letters, "")).otherwise(c)


def _replace_each(c: Column, table: dict[str, str]) -> Column:
    replaced = reduce(lambda acc, pair: F.replace(acc, F.lit(pair[0]), F.lit(pair[1])), table.items(), c)
    return F.when(c.rlike(f"[{''.join(table)}]"), replaced).otherwise(c)


def _several() -> dict[str, str]:
    """Characters beyond Latin-1 that become several."""
    table = {**_decompositions(), **_other_scripts()}
    return {k: v for k, v in table.items() if len(v) > 1 and ord(k) > 255 and k not in ONE_TO_MANY}


def _translate(c: Column, table: dict[str, str]) -> Column:
    return F.translate(c, "".join(table), "".join(table.values()))


def strip_marks(c: Column) -> Column:
    """Drop accents and other combining marks; every other character stays."""
    several = {k: v for k, v in _several().items() if k in _decompositions()}
    fractions = {k: v for k, v in _decompositions().items() if len(v) > 1 and ord(k) < 256}
    wide = _expand(_replace_each(c, fractions), c, several)
    plain = F.regexp_replace(_translate(wide, _decomposed_letters()), r"\p{Mn}+", "")
    return F.when(c.rlike(NON_ASCII), plain).otherwise(c)


def unaccent(c: Column) -> Column:
    """ASCII transliteration of Latin, Greek and Cyrillic text, compatibility characters and punctuation.

    Rows that are ASCII already skip the work.  Characters that no table covers
    are dropped.
    """
    fractions = {k: v for k, v in _decompositions().items() if len(v) > 1 and ord(k) < 256}
    wide = _expand(_replace_each(c, {**fractions, **ONE_TO_MANY}), c, _several())
    table = {**_decompositions(), **_other_scripts(), **ONE_TO_ONE}
    single = _translate(wide, {k: v for k, v in table.items() if len(v) == 1 and k not in ONE_TO_MANY})
    return F.when(c.rlike(NON_ASCII), F.regexp_replace(single, NON_ASCII, "")).otherwise(c)


def normalize_text(c: Column) -> Column:
    """Lower case, transliterate, signs to spaces, dots and commas away, one space between words.

    Single spaces between words, the bulk of white space, are left alone; only
    signs, line breaks and longer runs are rewritten.
    """
    plain = F.regexp_replace(unaccent(F.lower(c)), f"[{SIGNS_DELETED}]+", "")
    signs = "".join(_escape(ch) for ch in SIGNS_TO_SPACE if ch.isascii())
    spaced = F.regexp_replace(plain, rf"[{signs}\t\n\x0B\f\r]", " ")
    return F.trim(F.regexp_replace(spaced, " {2,}", " "))


def classification_text(title_clean: Column, snippet_clean: Column) -> Column:
    """Text the keyword matching reads; a missing side counts as empty."""
    return F.trim(
        F.concat(F.coalesce(title_clean, F.lit("")), F.lit(" "), F.coalesce(snippet_clean, F.lit("")))
    )


def strip(c: Column) -> Column:
    """Trim every kind of ASCII white space."""
    return F.trim(c, F.lit(" \t\n\r\x0b\x0c"))


def capitalize(c: Column) -> Column:
    """First letter upper, the rest lower."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2147483647)))


def choice_name(c: Column) -> Column:
    """Label -> choice name: no accents, lower case, trimmed, spaces as underscores."""
    return F.replace(F.trim(F.lower(strip_marks(c))), F.lit(" "), F.lit("_"))


def normalize_term(term: str) -> str:
    """Lexicon term as it can occur in normalised text; edge spaces are kept."""
    parts = unicodedata.normalize("NFKD", term.lower())
    return "".join(p for p in parts if not unicodedata.combining(p))


# -- term lists as prefix trees ------------------------------------------------

_META = set(r"\^$.|?*+()[]{}&-#~<>=!:,'\"/@%`;")


def _escape(ch: str) -> str:
    return "\\" + ch if ch in _META else ch


def prefix_tree_regex(terms: Sequence[str], longest: bool) -> str:
    """One regular expression for a list of terms.

    Terms that share a prefix share the branch.  ``longest=False`` stops at the
    first complete term, which is enough to know that one occurs;
    ``longest=True`` matches the longest term starting at a position.  A look
    at the next three characters comes first: most positions of a text fail
    there without entering the tree.
    """
    depth = min(3, min(map(len, terms)))
    opening = "".join(
        "[" + "".join(_escape(ch) for ch in sorted({t[i] for t in terms})) + "]" for i in range(depth)
    )
    tree: dict = {}
    for term in terms:
        node = tree
        for ch in term:
            node = node.setdefault(ch, {})
        node[""] = {}

    def render(node: dict) -> str:
        if "" in node and (not longest or len(node) == 1):
            return ""
        branches = [_escape(ch) + render(child) for ch, child in sorted(node.items()) if ch]
        body = branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"
        return f"(?:{body})?" if "" in node else body

    return f"(?={opening}){render(tree)}"


def _minimal_terms(terms: Sequence[str]) -> list[str]:
    """Terms that contain another term add nothing to an 'any of' test."""
    kept: list[str] = []
    seen: set[str] = set()
    for term in sorted(set(terms), key=lambda t: (len(t), t)):
        pieces = {term[i:j] for i in range(len(term)) for j in range(i + 1, len(term) + 1)}
        if not pieces & seen:
            kept.append(term)
            seen.add(term)
    return kept


def contains_any(c: Column, terms: Sequence[str], chunk: int = 20_000) -> Column:
    """True where the text contains one of ``terms`` anywhere, ignoring case.

    Null text gives null.  Very long lists are split into several patterns
    joined by ``or``, none is left out.
    """
    wanted = _minimal_terms([t.lower() for t in terms if t])
    if not wanted:
        return F.when(c.isNotNull(), F.lit(False))
    text = F.lower(c)
    tests = [
        text.rlike(prefix_tree_regex(wanted[i : i + chunk], longest=False))
        for i in range(0, len(wanted), chunk)
    ]
    return reduce(lambda a, b: a | b, tests)


def keyword_hits(text: Column, keywords: Sequence[str]) -> Column:
    """Distinct longest keywords found at each position of the text, in one pass.

    A zero-width look-ahead reports overlapping occurrences too.  Use
    :func:`keywords_from_hits` to read single categories from the result.
    """
    pattern = "(?=(" + prefix_tree_regex(sorted(set(keywords)), longest=True) + "))"
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)))
    return F.coalesce(found, empty_strings())


def _behind(hits: Column, terms: Sequence[str]) -> Column:
    """The ``terms`` that the text behind ``hits`` contains, in list order, repeats kept.

    A term is present when it, or a longer vocabulary term that starts with it,
    was the longest match somewhere.
    """
    listed = F.array(*map(F.lit, terms)) if terms else empty_strings()
    present = F.filter(listed, lambda term: F.exists(hits, lambda hit: F.startswith(hit, term)))
    return F.when(F.size(hits) == 0, empty_strings()).otherwise(present)


def keywords_from_hits(hits: Column, keywords: Sequence[str]) -> Column:
    """Keywords of one category contained in the text behind :func:`keyword_hits`, in list order, repeats kept."""
    return _behind(hits, keywords)


def longest_from_hits(hits: Column, names: Sequence[str]) -> Column:
    """Longest of ``names`` in the text behind the hits of :func:`keyword_hits`; ties go to list order; else null."""
    return F.get(_behind(hits, sorted(names, key=len, reverse=True)), F.lit(0))
