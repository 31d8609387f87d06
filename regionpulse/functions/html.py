"""A small reader of result pages: blocks, their title link, shown address and snippet."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

from pyspark import cloudpickle

# Elements without an end tag.
VOID = set("area base br col embed hr img input link meta source track wbr".split())

# Texts that are never a snippet, and marks of links that are no result.
INTERFACE_PHRASES = [
    "Incluir solo resultados", "Rehacer la búsqueda", "Bloquea este sitio", "Compartir comentarios",
]
LINK_NOISE = ["duckduckgo.com", "javascript:", "#"]
TITLE_LINK_NOISE = [*LINK_NOISE, "/settings", "/maps"]


class Node:
    __slots__ = ("tag", "attrs", "parent", "items")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.items = tag, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        """The elements below this one, in document order."""
        stack = [x for x in reversed(self.items) if isinstance(x, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [x for x in reversed(node.items) if isinstance(x, Node)]

    def text(self) -> str:
        """Text of this element and all below it, white space collapsed."""
        found, stack = [], list(reversed(self.items))
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                found.append(item)
            elif item.tag not in ("script", "style"):
                stack += reversed(item.items)
        return " ".join("".join(found).split())

    def above(self, test: Callable[[Node], bool]) -> bool:
        node = self.parent
        while node is not None:
            if test(node):
                return True
            node = node.parent
        return False

    def has_class(self, name: str) -> bool:
        return name in self.attrs.get("class", "").split()

    def is_third_child(self) -> bool:
        siblings = [x for x in self.parent.items if isinstance(x, Node)] if self.parent else []
        return len(siblings) > 2 and siblings[2] is self


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.top = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag in ("li", "p") and self.top.tag == tag:
            self.top = self.top.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.top)
        self.top.items.append(node)
        if tag not in VOID:
            self.top = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        node = self.top
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.top = node.parent

    def handle_data(self, data):
        self.top.items.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


def _marked(node: Node, name: str, value: str) -> bool:
    return node.attrs.get(name) == value


# What is a result block, and where pages without any have theirs.
BLOCKS = [
    lambda n: (n.tag in ("article", "div") and _marked(n, "data-testid", "result")) or (n.tag == "li" and _marked(n, "data-layout", "organic")),
    lambda n: (n.tag == "article" and n.above(lambda p: p.has_class("results"))) or n.has_class("nrn-react-div") or n.has_class("web-result"),
]
TITLES = [
    lambda n: n.tag == "a" and _marked(n, "data-testid", "result-title-a"),
    lambda n: n.tag == "a" and n.above(lambda p: p.tag == "h2"),
    lambda n: n.tag == "a" and n.has_class("result__a"),
    lambda n: n.tag == "a" and n.above(lambda p: p.tag == "article"),
]
ADDRESSES = [
    lambda n: n.tag == "span" and _marked(n, "data-testid", "result-extras-url-link"),
    lambda n: n.tag == "cite",
    lambda n: n.has_class("result__url"),
    lambda n: n.has_class("result__domain"),
]
SNIPPETS = [
    lambda n: _marked(n, "data-result", "snippet"),
    lambda n: n.tag == "div" and _marked(n, "data-testid", "result-snippet"),
    lambda n: n.has_class("result__snippet"),
    lambda n: n.above(lambda p: p.has_class("result__snippet")),
    lambda n: n.has_class("snippet"),
    lambda n: n.tag == "div" and n.is_third_child(),
]


def _none_of(text: str, marks: list[str]) -> bool:
    return not any(m in text for m in marks)


def _first(nodes: list[Node], selectors: list, accept: Callable[[Node], bool] = lambda n: True) -> Node | None:
    """The first accepted element of the first selector that has one."""
    return next((n for select in selectors for n in nodes if select(n) and accept(n)), None)


def _is_snippet(node: Node) -> bool:
    text = node.text()
    return len(text) > 20 and _none_of(text, INTERFACE_PHRASES)


def result_blocks(root: Node, base: str) -> list[tuple[str, str, str, str]]:
    """(title, address, shown address, snippet) of each result, the first of each address."""
    every = list(root.walk())
    blocks = next((found for select in BLOCKS if (found := [n for n in every if select(n)])), [])
    hits, seen = [], set()
    for block in blocks:
        inner = list(block.walk())
        link = _first(inner, TITLES)
        if link is None:
            continue
        href = link.attrs.get("href", "")
        url = urljoin(base, href) if href else ""
        if not url or url in seen or not _none_of(url, TITLE_LINK_NOISE):
            continue
        seen.add(url)
        shown = _first(inner, ADDRESSES, lambda n: bool(n.text()))
        snippet = _first(inner, SNIPPETS, _is_snippet)
        hits.append((link.text(), url, shown.text() if shown else "", snippet.text() if snippet else ""))
    return hits


def plain_links(root: Node, base: str) -> list[tuple[str, str, str, str]]:
    """The same from all links with enough text, for pages without a result."""
    hits, seen = [], set()
    for node in root.walk():
        if node.tag == "a" and node.attrs.get("href") and len(text := node.text()) > 10:
            url = urljoin(base, node.attrs["href"])
            if "http" in url and url not in seen and _none_of(url, LINK_NOISE):
                seen.add(url)
                hits.append((text, url, "", ""))
    return hits


def page_hits(html: str | None, base: str | None) -> list[tuple[str, str, str, str]]:
    """Results of a page, or its plain links if it has none."""
    root = parse(html)
    return result_blocks(root, base or "") or plain_links(root, base or "")


# The functions travel to the executors by value, so that these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
