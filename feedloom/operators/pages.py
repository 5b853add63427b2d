"""Article pages to metadata records, through prioritised fallbacks.

JSON-LD and meta tags are read with native expressions. Only pages that still lack an abstract, and pages of the
publisher with its own layout, are handed to a document tree; all other pages travel to it as NULL.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.dates import iso_date_prefix
from feedloom.functions.identifiers import DOI_LOOSE, host_in, ingest_doi, is_html_type, normalize_link, publisher_doi
from feedloom.functions.markup import abstract_block_udf, publisher_parts_udf
from feedloom.functions.text import as_col, clean_all, first_filled, strip, unescape_all
from feedloom.session import broadcast_if_small

MAX_BROADCAST_URLS = 500_000
RECORD_FIELDS = ("title", "abstract", "journal", "type", "date_published", "doi", "article_url", "raw_jsonld")

# The host suffix with its own page layout, and the article types accepted in JSON-LD.
PUBLISHER_SUFFIX = "nature.com"
ARTICLE_LD_TYPES = ("Article", "ScholarlyArticle", "NewsArticle")
LENIENT_LD_TYPES = ("scholarlyarticle", "newsarticle", "article", "blogposting", "reviewarticle")
LETTER = "letter to the editor"

_LD_SCRIPT = r"(?is)<script\b[^>]*\btype\s*=\s*[\"']?application/ld\+json[\"']?(?:\s[^>]*)?>(.*?)</script"
_META_TAG = r"(?is)<meta\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
_ATTRIBUTE = r"(?s)[A-Za-z_:][-\w:.]*\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+)"
# What a page must contain for a preferred abstract block to exist; only such pages are worth a document tree.
_BLOCK_HINT = r"(?s)\b(?:id|class)\s*=[^<]*?(?:[aA]bstract|Abs1)"


# ---- JSON-LD ---------------------------------------------------------------------------------------------

def ld_blocks(html: Column) -> Column:
    """Bodies of the JSON-LD scripts that are valid JSON, in document order."""
    bodies = F.regexp_extract_all(html, F.lit(_LD_SCRIPT), F.lit(1))
    return F.filter(bodies, lambda b: F.try_parse_json(b).isNotNull())


def ld_objects(blocks: Column) -> Column:
    """JSON-LD objects of all blocks, with top-level lists flattened."""
    def objects(block: Column) -> Column:
        value = F.try_parse_json(block)
        listed = F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.array(value))
        return F.filter(listed, lambda v: F.schema_of_variant(v).startswith("OBJECT"))

    return F.flatten(F.transform(blocks, objects))


def ld_text(blocks: Column) -> Column:
    """All blocks as one JSON array in their original spelling."""
    inner = F.transform(
        blocks,
        lambda b: F.when(F.ltrim(b).startswith("["), strip(F.regexp_extract(b, r"(?s)^\s*\[(.*)\]\s*\z", 1))).otherwise(strip(b)),
    )
    return F.concat(F.lit("["), F.array_join(F.filter(inner, lambda b: b != ""), ", "), F.lit("]"))


def scalar_at(obj: Column, *paths: str) -> Column:
    """First path that holds a non-empty scalar, as text; objects and lists do not count."""
    def at(path: str) -> Column:
        kind = F.schema_of_variant(F.try_variant_get(obj, path, "variant"))
        text = F.try_variant_get(obj, path, "string")
        return F.when(~kind.rlike("^(OBJECT|ARRAY)"), F.nullif(text, F.lit("")))

    return F.coalesce(*map(at, paths))


def is_article(obj: Column) -> Column:
    """Whether the (first) type of an object is an article type."""
    kind = scalar_at(obj, "$['@type'][0]", "$['@type']", "$.type[0]", "$.type")
    return F.coalesce(kind.isin(*ARTICLE_LD_TYPES), F.lit(False))


def is_article_lenient(obj: Column) -> Column:
    """Whether any type of an object is an article type, in any letter case."""
    def kinds(path: str) -> Column:
        many = F.try_variant_get(obj, path, "array<string>")
        return F.coalesce(many, F.array(F.try_variant_get(obj, path, "string")))

    declared = F.when(scalar_at(obj, "$['@type'][0]", "$['@type']").isNotNull(), kinds("$['@type']")).otherwise(
        kinds("$.type")
    )
    return F.coalesce(F.exists(declared, lambda k: F.lower(k).isin(*LENIENT_LD_TYPES)), F.lit(False))


def pick_article(objects: Column, lenient: bool = False) -> Column:
    return F.get(F.filter(objects, is_article_lenient if lenient else is_article), F.lit(0))


def ld_fields(obj: Column) -> dict[str, Column]:
    """Raw record fields of an article object."""
    listed = F.transform(
        F.try_variant_get(obj, "$.identifier", "array<variant>"),
        lambda v: scalar_at(v, "$.value", "$['@id']", "$"),
    )
    identifiers = F.coalesce(listed, F.array(scalar_at(obj, "$.identifier")))
    dois = F.filter(
        F.transform(identifiers, lambda s: F.regexp_extract(s, DOI_LOOSE, 0)), lambda d: d.isNotNull() & (d != "")
    )
    return {
        "title": scalar_at(obj, "$.headline", "$.name"),
        "abstract": scalar_at(obj, "$.abstract", "$.description"),
        "date_published": scalar_at(obj, "$.datePublished", "$.dateCreated"),
        "journal": scalar_at(obj, "$.isPartOf.name", "$.publisher.name"),
        "type": scalar_at(obj, "$.articleSection", "$.type"),
        "doi": F.get(dois, F.lit(0)),
    }


# ---- meta tags -------------------------------------------------------------------------------------------

def without_comments(html: Column) -> Column:
    return F.regexp_replace(html, r"(?s)<!--.*?-->", "")


def without_scripts(html: Column) -> Column:
    """Markup without scripts and styles, where a tag is not a tag."""
    return F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", "")


def meta_tags(html: Column) -> Column:
    """All meta tags as structs of name, property and content (still entity-encoded)."""
    def attribute(text: Column) -> Column:
        value = F.ltrim(F.substr(text, F.instr(text, "=") + 1))
        quoted = value.startswith('"') | value.startswith("'")
        return F.struct(
            F.lower(F.regexp_extract(text, r"^[^\s=]+", 0)).alias("k"),
            F.when(quoted, F.substr(value, F.lit(2), F.length(value) - 2)).otherwise(value).alias("v"),
        )

    def value(pairs: Column, key: str) -> Column:
        return F.get(F.filter(pairs, lambda p: p["k"] == key), F.lit(0))["v"].alias(key)

    tags = F.regexp_extract_all(html, F.lit(_META_TAG), F.lit(0))
    pairs = F.transform(tags, lambda t: F.transform(F.regexp_extract_all(t, F.lit(_ATTRIBUTE), F.lit(0)), attribute))
    return F.transform(pairs, lambda p: F.struct(*(value(p, k) for k in ("name", "property", "content"))))


def content_by(tags: Column | str, names: Iterable[str], attribute: str = "name") -> Column:
    """Map from those of ``names`` that ``attribute`` has to the content of the first such tag.

    Only tags with these names are looked at, and each name once, so a page of very many tags costs linear time.
    """
    asked = F.array(*(F.lit(n) for n in dict.fromkeys(names)))
    known = F.filter(as_col(tags), lambda t: F.array_contains(asked, t[attribute]))
    present = F.array_intersect(asked, F.transform(known, lambda t: t[attribute]))
    return F.map_from_entries(F.transform(present, lambda n: F.struct(n, F.get(F.filter(known, lambda t: t[attribute] == n), F.lit(0))["content"])))


def meta_content(contents: Column | str, *names: str) -> Column:
    """First non-blank content among ``names``; still entity-encoded."""
    def at(name: str) -> Column:
        content = F.try_element_at(as_col(contents), F.lit(name))
        return F.when(strip(content) != "", content)

    return F.coalesce(*map(at, names))


# Meta names by record field for ordinary pages and for the publisher's pages.
_GENERIC_META = {
    "m_journal": ("citation_journal_title",),
    "m_title": ("citation_title",),
    "m_doi": ("citation_doi",),
    "m_date_published": ("citation_publication_date",),
    "m_type": ("citation_article_type",),
    "m_description1": ("dc.description",),
    "m_description2": ("description",),
    "m_twitter": ("twitter:description",),
}
_META_FIELDS = ("journal", "title", "doi", "date_published", "type")


def _says(text: Column) -> Column:
    """Whether anything is left of an entity-encoded text but blanks."""
    return F.regexp_replace(text, r"(?i)(?U)&(?:nbsp|ensp|emsp|thinsp|#160|#xa0|#32|#x20|#10|#13|#9);|&amp;nbsp;|\s", "") != ""


def extract_records(
    pages: DataFrame,
    url: str = "url",
    html: str = "html",
    publisher_suffix: str = PUBLISHER_SUFFIX,
    compat: bool = False,
) -> DataFrame:
    """Add the record fields of each page to its row; the page text itself is dropped.

    By default meta tags also fill fields that a JSON-LD article leaves empty; with ``compat`` they are used
    only on pages without one.
    """
    keep = [c for c in pages.columns if c != html and c not in RECORD_FIELDS]
    visible = pages.withColumn("_visible", without_comments(F.col(html)))
    scanned = visible.withColumn("_ld", ld_blocks(F.col("_visible"))).withColumn(
        "_metas", meta_tags(without_scripts(F.col("_visible")))
    )
    picked = (
        scanned.withColumn("_article", pick_article(ld_objects(F.col("_ld"))))
        .withColumn("_names", content_by("_metas", chain(*_GENERIC_META.values(), *_PUBLISHER_META.values())))
        .withColumn("_properties", content_by("_metas", ("og:description",), "property"))
    )
    ld, generic_meta, own_meta = ld_fields(F.col("_article")), dict(_GENERIC_META), dict(_PUBLISHER_META)
    raw = picked.select(
        *keep,
        html,
        F.col(url).alias("_url"),
        host_in(url, publisher_suffix, compat).alias("_own_layout"),
        ld_text(F.col("_ld")).alias("_ld_text"),
        F.col("_article").isNotNull().alias("_has_article"),
        F.array(*ld.values()).alias("_j"),
        F.array(*(meta_content("_names", *names) for names in generic_meta.values()),
                meta_content("_properties", "og:description")).alias("_m"),
        F.array(*(meta_content("_names", *names) for names in own_meta.values())).alias("_p"),
    )
    # One Arrow pass decodes the few texts with unusual entities and walks the few pages that need a tree.
    described = [F.get("_j", F.lit(list(ld).index("abstract")))] + [
        F.get("_m", F.lit(list(generic_meta).index(f))) for f in ("m_description1", "m_description2")
    ]
    wants_block = F.coalesce(*(F.when(_says(d), d) for d in described)).isNull() & F.col(html).rlike(_BLOCK_HINT)
    own_html = F.when(F.col("_own_layout"), F.col(html))
    texts = raw.select(
        *keep,
        "_url", "_own_layout", "_ld_text", "_has_article",
        clean_all(F.col("_j")).alias("_j"),
        clean_all(F.col("_m"), decode=2).alias("_m"),
        F.transform(unescape_all(F.when(F.col("_own_layout"), F.col("_p"))), strip).alias("_p"),
        abstract_block_udf(F.when(wants_block, F.col(html))).alias("block"),
        publisher_parts_udf(own_html).alias("_parts"),
    )
    decoded = texts.select(
        *keep,
        "_url", "_own_layout", "_ld_text", "_has_article", "block", "_parts",
        *(F.get("_j", F.lit(i)).alias(f"j_{f}") for i, f in enumerate(ld)),
        *(F.get("_m", F.lit(i)).alias(f) for i, f in enumerate((*generic_meta, "m_og"))),
        *(F.get("_p", F.lit(i)).alias(f) for i, f in enumerate(own_meta)),
    )
    generic, own = _generic_record(compat), _publisher_record()
    use_own = F.col("_own_layout") & _core_complete(own)
    return decoded.select(
        *keep, *(F.when(use_own, own[f]).otherwise(generic[f]).alias(f) for f in RECORD_FIELDS)
    )


def _generic_record(compat: bool) -> dict[str, Column]:
    record = {}
    for field in _META_FIELDS:
        from_ld, from_meta = F.col(f"j_{field}"), F.nullif(F.col(f"m_{field}"), F.lit(""))
        record[field] = (
            F.when(F.col("_has_article"), from_ld).otherwise(from_meta) if compat else first_filled(from_ld, from_meta)
        )
    record["abstract"] = first_filled("j_abstract", "m_description1", "m_description2", "block", "m_og", "m_twitter")
    record["article_url"] = F.col("_url")
    record["raw_jsonld"] = F.col("_ld_text")
    return record


_PUBLISHER_META = {
    "p_title": ("citation_title", "dc.title"),
    "p_journal": ("citation_journal_title", "prism.publicationName"),
    "p_doi": ("citation_doi",),
    "p_identifier": ("dc.identifier",),
    "p_day": ("citation_online_date",),
    "p_type": ("citation_article_type",),
    "p_abstract": ("dc.description", "description"),
}


def _publisher_record() -> dict[str, Column]:
    identifier = F.when(F.col("p_identifier").rlike(r"\b10\.[0-9]{4,9}/\S+\b"), F.col("p_identifier"))
    described = F.nullif(F.col("p_abstract"), F.lit(""))
    is_letter = F.coalesce(F.lower(described) == LETTER, F.lit(False))
    return {
        "title": first_filled("_parts.heading", "p_title"),
        "abstract": first_filled(
            F.when(is_letter, F.col("_parts.lead")).otherwise(described), "_parts.section", "_parts.teaser"
        ),
        "journal": first_filled("p_journal", "_parts.crumb"),
        "type": F.nullif(F.col("p_type"), F.lit("")),
        "date_published": first_filled("_parts.day", iso_date_prefix("p_day")),
        "doi": publisher_doi(first_filled("p_doi", identifier)),
        "article_url": F.col("_url"),
        "raw_jsonld": F.lit(None).cast("string"),
    }


def _core_complete(record: dict[str, Column]) -> Column:
    return (
        record["title"].isNotNull()
        | record["doi"].isNotNull()
        | (record["journal"].isNotNull() & record["date_published"].isNotNull())
    )


def records_for(urls: DataFrame, page_payloads: DataFrame, compat: bool = False) -> DataFrame:
    """``(url, page)``: one record per landed page that ``urls(url)`` asks for, as a struct.

    Pages that no url asks for are dropped before any parsing. A bounded set of urls is broadcast, and page text is
    then never shuffled; a larger one meets the pages in a shuffle, which costs less than parsing them all. Of several
    landings of a url a readable one is preferred.
    """
    distinct = urls.select("url").filter("url IS NOT NULL").distinct()
    asked = page_payloads.join(broadcast_if_small(distinct, MAX_BROADCAST_URLS), "url", "left_semi")
    readable = F.col("error").isNull() & is_html_type("content_type")
    records = extract_records(asked.withColumn("html", F.when(readable, F.col("html"))), compat=compat)
    best = F.struct(readable, F.col("title").isNotNull(), F.xxhash64("content_type", "error", *RECORD_FIELDS))
    page = F.struct("content_type", "error", *RECORD_FIELDS)
    return records.groupBy("url").agg(F.max_by(page, best).alias("page"))


# ---- reconciliation with the feed item -------------------------------------------------------------------

def reconcile(item: str, page: str) -> dict[str, Column]:
    """Article fields from a page record, with the feed item's values where the page has none."""
    def p(f: str) -> Column:
        return F.col(f"{page}.{f}")

    def i(f: str) -> Column:
        return F.col(f"{item}.{f}")

    return {
        "journal": p("journal"),
        "title_en": first_filled(p("title"), i("title")),
        "type": p("type"),
        "pub_date": first_filled(p("date_published"), i("pub_date")),
        "doi": first_filled(p("doi"), ingest_doi(i("doi"))),
        "article_url": F.coalesce(F.nullif(p("article_url"), F.lit("")), normalize_link(i("link")), F.lit("")),
        "abstract_en": p("abstract"),
        "raw_jsonld": p("raw_jsonld"),
    }
