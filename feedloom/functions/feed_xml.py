"""The elements of one feed document, by their namespaces.

Element names count by namespace, whatever prefix a feed declares for it and wherever. Of a repeated element the first
counts, and its value is the text in front of any markup inside it.
"""

from __future__ import annotations

from xml.etree import ElementTree

# The namespaces of feed elements.
RDF = "{http://www.w3.org/1999/02/22-rdf-syntax-ns#}"
RSS = "{http://purl.org/rss/1.0/}"
DC = "{http://purl.org/dc/elements/1.1/}"
PRISM = "{http://prismstandard.org/namespaces/basic/2.0/}"
ATOM = "{http://www.w3.org/2005/Atom}"

RAW = ("title", "link", "about", "ident", "pub_date", "doi", "journal", "description")
#: For each dialect the elements that may fill a field; the first that holds text does.
ELEMENTS = {
    "rss1": {"title": (RSS + "title", DC + "title"), "link": (RSS + "link",), "ident": (DC + "identifier",), "pub_date": (DC + "date",),
             "doi": (PRISM + "doi",), "journal": (PRISM + "publicationName",)},
    "rss2": {"title": ("title", DC + "title"), "link": ("link",), "ident": ("guid",), "pub_date": ("pubDate", DC + "date"), "description": ("description",)},
    "atom": {"title": (ATOM + "title", "title"), "ident": (ATOM + "id", "id"), "pub_date": (ATOM + "published", "published", ATOM + "updated", "updated")},
}


class NotAFeed(ValueError):
    """The document cannot be read as XML."""


def read_feed(content: str | None) -> tuple[str, list[dict]]:
    """The dialect and the raw fields of each item in document order; ``other`` documents have no items."""
    if not content:
        raise NotAFeed("no content")
    try:
        root = ElementTree.fromstring(content)
    except ElementTree.ParseError as e:
        raise NotAFeed(f"not well-formed: {e}") from e
    except ValueError as e:  # what XML cannot hold at all
        raise NotAFeed(str(e)) from e
    dialect = _dialect(root)
    return dialect, [_fields(dialect, item) for item in _items(dialect, root)]


def _dialect(root: ElementTree.Element) -> str:
    name = root.tag.rpartition("}")[2]
    if name == "RDF" or root.find(RSS + "channel") is not None:
        return "rss1"
    if name == "rss" or root.find("channel") is not None:
        return "rss2"
    return "atom" if name == "feed" or root.find(ATOM + "feed") is not None else "other"


def _items(dialect: str, root: ElementTree.Element) -> list[ElementTree.Element]:
    if dialect == "rss1":
        return root.findall(RSS + "item")
    if dialect == "rss2":
        channel = root.find("channel")
        return [] if channel is None else channel.findall("item")
    return (root.findall(ATOM + "entry") or root.findall("entry")) if dialect == "atom" else []


def _fields(dialect: str, item: ElementTree.Element) -> dict:
    first: dict[str, ElementTree.Element] = {}
    for child in item:
        first.setdefault(child.tag, child)
    out = dict.fromkeys(RAW)
    for field, names in ELEMENTS[dialect].items():
        texts = ((first[n].text or "").strip() for n in names if n in first)
        out[field] = next((t for t in texts if t), None)
    if dialect == "rss1":
        out["about"] = item.get(RDF + "about")
    if dialect == "atom":
        out["link"] = _href(item)
    return out


def _href(entry: ElementTree.Element) -> str | None:
    """The alternate link of an Atom entry; without ``rel`` a link is an alternate one."""
    links = entry.findall(ATOM + "link") + entry.findall("link")
    named = [link.get("href") for link in links if link.get("rel") == "alternate"][:1]
    bare = [link.get("href") for link in links if link.get("rel") is None][:1]
    return next((href for href in named + bare if href), None)
