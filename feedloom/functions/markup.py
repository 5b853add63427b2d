"""Element lookups that need a document tree: small per-page helpers behind Arrow-batched functions."""

from __future__ import annotations

import html
import re
import sys
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.text import by_rows

# Ship these helpers by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset(("script", "style", "template"))

# Where pages put an abstract, in order of preference, as (tags, attribute, test, value).
_BLOCKS = ("section", "div", "article")
ABSTRACT_BLOCKS = (
    ((_BLOCKS, "id", "has", "abstract"),),
    ((_BLOCKS, "class", "has", "abstract"),),
    ((("div",), "id", "is", "Abs1-content"), (("div",), "id", "is", "Abs1"), (("div",), "id", "is", "Abs1-section")),
    ((("section", "div"), "id", "is", "abstract"), (("section", "div"), "class", "word", "abstract")),
    ((("div",), "class", "word", "Citation__abstract"), (("div",), "class", "word", "article__abstract")),
    ((("section",), "class", "word", "ArticleBody_abstract"), (("section",), "class", "word", "Abstract")),
)
MIN_BLOCK_LENGTH = 40


class _Element:
    __slots__ = ("tag", "attrs", "parts")

    def __init__(self, tag, attrs):
        self.tag, self.attrs, self.parts = tag, attrs, []

    def walk(self):
        """Descendant elements in document order, without recursion."""
        todo = [p for p in reversed(self.parts) if isinstance(p, _Element)]
        while todo:
            e = todo.pop()
            yield e
            todo.extend(p for p in reversed(e.parts) if isinstance(p, _Element))

    def find(self, test):
        return next((e for e in self.walk() if test(e)), None)

    def strings(self):
        todo = list(reversed(self.parts))
        while todo:
            p = todo.pop()
            if isinstance(p, str):
                yield p
            elif p.tag not in _HIDDEN:
                todo.extend(reversed(p.parts))

    def text(self):
        """Visible text with one space between pieces, or None."""
        return " ".join(s for s in (x.strip() for x in self.strings()) if s) or None


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Element("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        e = _Element(tag, {k: v or "" for k, v in attrs})
        self.open[-1].parts.append(e)
        if tag not in _VOID:
            self.open.append(e)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].parts.append(_Element(tag, {k: v or "" for k, v in attrs}))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        self.open[-1].parts.append(data)


def parse(page: str) -> _Element:
    builder = _Builder()
    builder.feed(page)
    builder.close()
    return builder.root


def _matches(e: _Element, rule) -> bool:
    tags, attr, test, value = rule
    if e.tag not in tags or attr not in e.attrs:
        return False
    have = e.attrs[attr]
    return {"has": value in have, "is": have == value, "word": value in have.split()}[test]


def abstract_block(page: str):
    """Text of the first preferred block that is long enough."""
    root = parse(page)
    for rules in ABSTRACT_BLOCKS:
        e = root.find(lambda x: any(_matches(x, r) for r in rules))
        if e is not None:
            text = " ".join(html.unescape(" ".join(e.strings())).split())
            if len(text) > MIN_BLOCK_LENGTH:
                return text
    return None


def _attr(name, pattern, *tags):
    rx = re.compile(pattern, re.I)
    return lambda e: e.tag in tags and name in e.attrs and rx.search(e.attrs[name]) is not None


def _class(pattern, *tags):
    rx = re.compile(pattern)
    return lambda e: e.tag in tags and rx.search(e.attrs.get("class", "")) is not None


def _first_paragraph(block):
    p = block.find(lambda e: e.tag == "p") if block is not None else None
    return p.text() if p is not None else None


_HEADING = (_attr("data-test", "article-title", "h1"), _class(r"\bc-article-title\b", "h1"))
_MAIN_NAME = _attr("data-test", "^main-content$", "div")
_MAIN_CLASS = (
    _attr("class", r"\bc-article-body\b.*\bmain-content\b", "div"),
    lambda e: {"c-article-body", "main-content"} <= set(e.attrs.get("class", "").split()),
)
_SECTION = (_attr("id", r"^Abs\d+", "section"), _attr("data-title", "abstract", "section"))
_TEASER = _class(r"\barticle__teaser\b", "div")
_CRUMBS = _attr("aria-label", "breadcrumb", "ol", "nav")
_HISTORY = _attr("data-test", "publication-history", "ul")
_PUBLISHED = re.compile(r"\bPublished\b", re.I)
_DAY = re.compile(r"\d{4}-\d{2}-\d{2}")


def _either(root, tests):
    for test in tests:
        e = root.find(test)
        if e is not None:
            return e
    return None


def _published_day(root):
    history = root.find(_HISTORY)
    for li in history.walk() if history is not None else ():
        if li.tag == "li" and _PUBLISHED.search(li.text() or ""):
            when = li.find(lambda e: e.tag == "time" and "datetime" in e.attrs)
            day = when.attrs["datetime"].strip()[:10] if when is not None else ""
            if _DAY.fullmatch(day):
                return day
    return None


def publisher_parts(page: str) -> tuple:
    """Element texts of a publisher page: heading, lead, abstract section, teaser, journal crumb, day."""
    root = parse(page)
    heading = _either(root, _HEADING)
    crumbs = root.find(_CRUMBS)
    links = [e.text() for e in crumbs.walk() if e.tag == "a"] if crumbs is not None else []
    return (
        heading.text() if heading is not None else None,
        _first_paragraph(root.find(lambda e: _MAIN_NAME(e) and any(test(e) for test in _MAIN_CLASS))),
        _first_paragraph(_either(root, _SECTION)),
        _first_paragraph(root.find(_TEASER)),
        links[1] if len(links) > 1 else None,
        _published_day(root),
    )


_PAGES = 50  # that are Python objects at a time
_PART_NAMES = ("heading", "lead", "section", "teaser", "crumb", "day")


@F.arrow_udf(T.StringType())
def abstract_block_udf(pages: pa.Array) -> pa.Array:
    return by_rows(abstract_block, pages, pa.string(), _PAGES)


@F.arrow_udf(T.StructType([T.StructField(n, T.StringType()) for n in _PART_NAMES]))
def publisher_parts_udf(pages: pa.Array) -> pa.Array:
    """The parts of each page; without a page, none of them."""
    kind = pa.struct([(n, pa.string()) for n in _PART_NAMES])
    parts = by_rows(lambda page: dict(zip(_PART_NAMES, publisher_parts(page))), pages, kind, _PAGES)
    return pa.StructArray.from_arrays(parts.flatten(), fields=list(kind))
