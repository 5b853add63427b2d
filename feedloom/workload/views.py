"""Inputs derived from the benchmark tables: portable SQL views, and payloads rendered from documents.

The SQL texts run unchanged in Spark and in the checking engine, so both sides read the same rows. They cover
their tables completely; ``%`` only varies values, never selects rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.session import read_spread

VIEWS = {
    # The article table: one article per document, fetched at the time of the event with its number.
    "articles_v": """
SELECT 'doi:10.5555/d' || CAST(d.doc_id AS STRING) AS uid,
       'https://feeds.example.org/' || d.source || '.xml' AS feed_url,
       CASE WHEN d.doc_id % 11 = 0 THEN NULL ELSE d.source END AS journal,
       split_part(d.text, chr(10), 1) AS title_en,
       CASE WHEN d.doc_id % 3 = 0 THEN NULL ELSE 'T' || CAST(d.doc_id AS STRING) END AS title_cn,
       CASE WHEN d.doc_id % 7 = 0 THEN NULL ELSE 'Article' END AS type,
       CASE d.doc_id % 4 WHEN 0 THEN CAST(CAST(e.ts AS DATE) AS STRING)
                         WHEN 1 THEN substr(CAST(CAST(e.ts AS DATE) AS STRING), 1, 7)
                         WHEN 2 THEN '' ELSE NULL END AS pub_date,
       '10.5555/d' || CAST(d.doc_id AS STRING) AS doi,
       CASE WHEN d.doc_id % 23 = 0 THEN NULL
            ELSE 'https://doi.org/10.5555/D' || CAST(d.doc_id AS STRING) END AS article_url,
       CASE d.doc_id % 9 WHEN 0 THEN NULL WHEN 1 THEN 'Stub in ' || d.lang ELSE d.text END AS abstract_en,
       CAST(NULL AS STRING) AS abstract_cn,
       CAST(NULL AS STRING) AS raw_jsonld,
       e.ts AS fetched_at,
       e.ts AS last_updated_at,
       CASE d.doc_id % 6 WHEN 0 THEN '["生命科学"]' WHEN 1 THEN '人工智能'
                         WHEN 2 THEN '["人工智能", "生命科学"]' WHEN 3 THEN '3D打印和增材制造'
                         WHEN 4 THEN '["其他"]' ELSE NULL END AS topic_tag
FROM documents d JOIN events e ON e.event_id = d.doc_id""",
    # The same articles read again from their pages.
    "reprobe_v": """
SELECT 'doi:10.5555/d' || CAST(d.doc_id AS STRING) AS uid,
       CASE d.doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Article' ELSE 'Review' END AS type,
       d.source AS journal,
       CASE WHEN d.doc_id % 8 = 5 THEN NULL ELSE CAST(CAST(e.ts AS DATE) AS STRING) END AS date_published,
       CASE WHEN d.doc_id % 10 < 4 THEN d.text || ' (text of the version of record)' ELSE d.text END AS abstract_en,
       CASE WHEN d.doc_id % 19 = 0 THEN 'application/pdf' ELSE 'text/html; charset=utf-8' END AS content_type,
       CASE WHEN d.doc_id % 17 = 0 THEN 'HTTP 503' ELSE NULL END AS error
FROM documents d JOIN events e ON e.event_id = d.doc_id""",
    # Parsed feed items: two versions of each page's item, some in two feeds, with every kind of identity.
    "feed_items_v": """
SELECT 'https://feeds.example.org/f' || CAST(feed_ord AS STRING) AS feed_url,
       feed_ord,
       page_id * 2 + variant AS pos,
       'Item ' || CAST(page_id AS STRING) || ' v' || CAST(variant AS STRING) AS title,
       CASE WHEN page_id % 12 = 4 THEN NULL WHEN variant = 1 THEN url
            WHEN url LIKE '%?%' THEN url || '&utm_medium=rss' ELSE url || '?utm_medium=rss' END AS link,
       CASE WHEN page_id % 4 = 0 THEN NULL ELSE 'guid-' || CAST(page_id AS STRING) END AS id_like,
       CASE WHEN page_id % 3 = 0 THEN 'https://doi.org/10.5555/P' || CAST(page_id AS STRING) ELSE NULL END AS doi,
       CAST(NULL AS STRING) AS journal,
       CAST(NULL AS STRING) AS pub_date
FROM (SELECT page_id, url, 1 AS variant, CAST(page_id % 10 AS INT) AS feed_ord FROM pages
      UNION ALL
      SELECT page_id, url, 2 AS variant,
             CAST((page_id + CASE WHEN page_id % 5 = 0 THEN 1 ELSE 0 END) % 10 AS INT) AS feed_ord FROM pages) x""",
    # Attempts to fetch a uid's page.
    "fetch_attempts_v": """
SELECT 'id:u' || CAST(user_id AS STRING) || 'h' || CAST(hour(ts) AS STRING) AS uid,
       event_id AS attempt_id, ts AS attempted_at,
       event_type <> 'error' AS ok,
       CASE WHEN event_type = 'error' THEN 'HTTP 503 ' || props ELSE NULL END AS error
FROM events""",
    # Polls of one feed per user: content, not modified, or a failure.
    "polls_v": """
SELECT 'https://feeds.example.org/u' || CAST(user_id AS STRING) AS feed_url,
       CAST(CASE event_type WHEN 'view' THEN 304 WHEN 'error' THEN 503 ELSE 200 END AS INT) AS status,
       CASE WHEN event_type IN ('view', 'error') THEN NULL ELSE 'W/' || CAST(event_id AS STRING) END AS etag,
       CASE WHEN event_type IN ('view', 'error') THEN NULL ELSE CAST(CAST(ts AS DATE) AS STRING) END AS last_modified,
       ts AS polled_at
FROM events""",
    # Poll state before those polls, for the users that ever signed up.
    "feeds_v": """
SELECT 'https://feeds.example.org/u' || CAST(user_id AS STRING) AS feed_url,
       'W/old' || CAST(user_id AS STRING) AS etag, '2023-12-31' AS last_modified, min(ts) AS last_checked_at
FROM events WHERE event_type = 'signup' GROUP BY user_id""",
    # A retry table from before those attempts.
    "pending_v": """
SELECT 'id:u' || CAST(user_id AS STRING) || 'h' || CAST((hour(ts) + 1) % 24 AS STRING) AS uid,
       CAST(NULL AS STRING) AS feed_url, 'https://old.example.org' AS article_url, CAST(NULL AS STRING) AS doi,
       CAST(NULL AS STRING) AS pub_date, count(*) AS fail_count, 'old ' || min(props) AS last_error,
       min(ts) AS first_seen_at, min(ts) AS last_attempt_at
FROM events WHERE event_type = 'purchase' GROUP BY user_id, hour(ts)""",
    # Article rows of a later run: some known uids, some new ones.
    "updates_v": """
SELECT 'doi:10.5555/d' || CAST(doc_id * 2 AS STRING) AS uid, 'https://feeds.example.org/new.xml' AS feed_url,
       source AS journal, 'new ' || split_part(text, chr(10), 1) AS title_en, CAST(NULL AS STRING) AS title_cn,
       lang AS type, CAST(NULL AS STRING) AS pub_date, '10.5555/d' || CAST(doc_id * 2 AS STRING) AS doi,
       CAST(NULL AS STRING) AS article_url, text AS abstract_en, CAST(NULL AS STRING) AS abstract_cn,
       CAST(NULL AS STRING) AS raw_jsonld, CAST('2024-06-01 00:00:00' AS TIMESTAMP_NTZ) AS fetched_at,
       CAST('2024-06-01 00:00:00' AS TIMESTAMP_NTZ) AS last_updated_at, '["其他"]' AS topic_tag
FROM documents""",
    # Documents with topical phrases in their last words.
    "topical_v": """
SELECT doc_id, split_part(text, chr(10), 1) AS title,
       text || CASE doc_id % 9 WHEN 0 THEN ' on Stem  Cell lines' WHEN 1 THEN ' with MACHINE' || chr(10) || 'learning.'
                               WHEN 2 THEN ' by 3d print' WHEN 3 THEN ' of proteins' WHEN 4 THEN ' 关于人工智能和3D打印和增材制造'
                               WHEN 5 THEN ' protein and llm' WHEN 6 THEN ' additive manufacturing, ebm' ELSE '' END AS abstract
FROM documents""",
    # Lines of a DOI file in the spellings that users type.
    "doi_lines_v": """
SELECT doc_id AS ord,
       CASE doc_id % 7 WHEN 0 THEN 'https://doi.org/10.5555/D' || CAST(doc_id AS STRING)
                       WHEN 1 THEN 'doi:10.5555/d' || CAST(doc_id AS STRING)
                       WHEN 2 THEN ' dx.doi.org/10.5555/d' || CAST(doc_id AS STRING) || '/ '
                       WHEN 3 THEN '10.5555/D' || CAST(doc_id - 3 AS STRING)
                       WHEN 4 THEN '# comment ' || lang
                       WHEN 5 THEN '  ' ELSE '10.5555/d' || CAST(doc_id AS STRING) END AS value
FROM documents""",
    # Comma-separated values of a repeatable argument.
    "doi_args_v": """
SELECT doc_id AS ord, '10.5555/a' || CAST(doc_id AS STRING) || ', ,10.5555/A' || CAST(doc_id + 1 AS STRING) || ' ' AS value
FROM documents""",
}


def sql_with(body: str, *names: str) -> str:
    """``body`` with the named views in front."""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in names) + "\n" + body


TEXT_KEYS = {"documents": "doc_id", "pages": "page_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose texts are about to be parsed or matched."""
    return read_spread(spark, f"{sf_dir}/{name}.parquet", TEXT_KEYS[name])


def view(spark: SparkSession, sf_dir: str, name: str, heavy: bool = False) -> DataFrame:
    """A derived view; ``heavy`` if its texts are about to be parsed or matched."""
    for t in ("documents", "events", "pages"):
        if f" {t}" in VIEWS[name]:
            read = text_table if heavy and t in TEXT_KEYS else table
            read(spark, sf_dir, t).createOrReplaceTempView(t)
    return spark.sql(VIEWS[name])


# ---- rendered payloads -----------------------------------------------------------------------------------

FEED_BLOCK = 100
_DOI_PREFIX = "10.5555/d"
RSS1_HEAD = (
    '<?xml version="1.0" encoding="UTF-8"?><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#"'
    ' xmlns="http://purl.org/rss/1.0/" xmlns:dc="http://purl.org/dc/elements/1.1/"'
    ' xmlns:prism="http://prismstandard.org/namespaces/basic/2.0/"><channel rdf:about="c"><title>c</title></channel>'
)
RSS2_HEAD = (
    '<?xml version="1.0"?><!-- feed --><rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/">'
    "<channel><title>c</title><link>https://c.example.org</link>"
)
ATOM_HEAD = '<feed xmlns="http://www.w3.org/2005/Atom"><title>c</title><link rel="self" href="https://c.example.org"/>'


def xml_escape(c: Column) -> Column:
    c = F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(raw), F.lit(entity))
    return c


def _doc_fields(documents: DataFrame) -> dict[str, Column]:
    doc_id = F.col("doc_id").cast("string")
    return {
        "id": doc_id,
        "title": F.split_part("text", F.lit("\n"), F.lit(1)),
        "link": F.concat(F.lit("https://j.example.org/a/"), doc_id, F.lit("?a=1&b=2")),
        "day": F.concat(F.lit("2024-02-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0")),
        "doi": F.concat(F.lit(_DOI_PREFIX), doc_id),
    }


def _item_xml(dialect: str, f: dict[str, Column]) -> Column:
    def tag(name: str, body: Column, attributes: str = "") -> Column:
        return F.concat(F.lit(f"<{name}{attributes}>"), body, F.lit(f"</{name}>"))

    title, link = xml_escape(f["title"]), xml_escape(f["link"])
    if dialect == "rss1":
        return F.concat(
            F.lit('<item rdf:about="urn:x:'), f["id"], F.lit('">'), tag("title", title), tag("link", link),
            tag("dc:date", f["day"]),
            F.when(F.col("doc_id") % 2 == 0, tag("prism:doi", f["doi"])).otherwise(
                tag("dc:identifier", F.concat(F.lit("doi:"), f["doi"]))
            ),
            tag("prism:publicationName", F.concat(F.col("source"), F.lit(" &amp; Co"))), tag("description", xml_escape(F.col("text"))), F.lit("</item>"),
        )
    if dialect == "rss2":
        text = F.concat(F.replace("text", F.lit("]]>"), F.lit("]] >")), F.lit(" (see doi:"), f["doi"], F.lit(")."))
        return F.concat(
            F.lit("<item>"), tag("title", title), tag("link", link),
            tag("guid", F.concat(F.lit("tag:"), f["id"]), ' isPermaLink="false"'), tag("pubDate", f["day"]),
            F.lit("<description><![CDATA["), text, F.lit("]]></description></item>"),
        )
    return F.concat(
        F.lit("<entry>"), tag("id", F.concat(F.lit("https://doi.org/"), f["doi"])), tag("title", title, ' type="text"'),
        F.lit('<link rel="self" href="https://self.example.org"/><link rel="alternate" href="'), link, F.lit('"/>'),
        tag("updated", f["day"]), F.when(F.col("doc_id") % 2 == 0, tag("published", f["day"])).otherwise(F.lit("")),
        tag("summary", xml_escape(F.col("text"))), F.lit("</entry>"),
    )


def feed_payloads(documents: DataFrame, dialect: str | None = None, broken_lang: str | None = None) -> DataFrame:
    """Feed payloads holding every document, at most 100 of one source and language each.

    Without ``dialect`` sources alternate between the three. Payloads of ``broken_lang`` are cut in the middle.
    """
    f = _doc_fields(documents)
    which = F.lit(dialect) if dialect else F.element_at(
        F.array(F.lit("rss1"), F.lit("rss2"), F.lit("atom")), (F.crc32("source") % 3 + 1).cast("int")
    )
    kinds = (dialect,) if dialect else ("rss1", "rss2", "atom")
    xml = F.coalesce(*(F.when(F.col("which") == k, _item_xml(k, f)) for k in kinds))
    block = F.floor(F.col("doc_id") / FEED_BLOCK).cast("int")
    grouped = (
        documents.withColumn("which", which)
        .select("source", "lang", "which", block.alias("feed_ord"), "doc_id", xml.alias("xml"))
        .groupBy("source", "lang", "which", "feed_ord")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "xml"))), lambda i: i["xml"]), "").alias("items"))
    )
    head = F.when(F.col("which") == "rss1", RSS1_HEAD).when(F.col("which") == "rss2", RSS2_HEAD).otherwise(ATOM_HEAD)
    tail = F.when(F.col("which") == "rss1", "</rdf:RDF>").when(F.col("which") == "rss2", "</channel></rss>").otherwise("</feed>")
    whole = F.concat(head, F.col("items"), tail)
    content = whole
    if broken_lang:
        half = F.substr(whole, F.lit(1), F.floor(F.length(whole) / 2).cast("int"))
        content = F.when(F.col("lang") == broken_lang, half).otherwise(whole)
    return grouped.select(
        F.concat_ws("/", F.lit("https://feeds.example.org"), "source", "lang", F.col("feed_ord").cast("string")).alias("feed_url"),
        "feed_ord",
        F.lit(200).alias("status"),
        F.lit(None).cast("string").alias("etag"),
        F.lit(None).cast("string").alias("last_modified"),
        content.alias("content"),
        F.lit("2024-03-01 00:00:00").cast("timestamp_ntz").alias("polled_at"),
    )


def _meta(name: str, content: Column, key: str = "name") -> Column:
    return F.concat(F.lit(f'<meta {key}="{name}" content="'), content, F.lit('">'))


def _page(head: list[Column], body: list[Column]) -> Column:
    return F.concat(
        F.lit('<!DOCTYPE html><html><head><meta charset="utf-8"><!-- <meta name="citation_title" content="no"> -->'
              '<script>var s = \'<meta name="citation_title" content="no">\';</script>'),
        *head, F.lit("</head><body><nav><a href='/'>home</a></nav>"), *body, F.lit("</body></html>"),
    )


def _ld(json: Column) -> Column:
    return F.concat(F.lit('<script type="application/ld+json">'), json, F.lit("</script>"))


def generic_pages(documents: DataFrame) -> DataFrame:
    """One ordinary article page per document; six ways of stating the metadata take turns."""
    f = _doc_fields(documents)
    title, text = xml_escape(f["title"]), xml_escape(F.col("text"))
    metas = [
        _meta("citation_title", title), _meta("citation_journal_title", F.col("source")), _meta("citation_doi", f["doi"]),
        _meta("citation_publication_date", f["day"]), _meta("citation_article_type", F.lit("Letter")),
    ]

    def obj(**fields) -> Column:
        return F.struct(*(v.alias(k) for k, v in fields.items()))

    single = F.to_json(obj(**{
        "@type": F.lit("ScholarlyArticle"), "headline": f["title"], "abstract": F.col("text"), "datePublished": f["day"],
        "isPartOf": obj(name=F.col("source")), "publisher": obj(name=F.lit("P")), "articleSection": F.lit("Research"),
        "identifier": F.concat(F.lit("https://doi.org/"), f["doi"]),
    }))
    second = F.to_json(obj(**{
        "@type": F.array(F.lit("NewsArticle"), F.lit("X")), "name": f["title"], "description": F.col("text"),
        "dateCreated": f["day"], "publisher": obj(name=F.col("source")), "type": F.lit("News"),
        "identifier": F.array(
            F.create_map(F.lit("value"), F.lit("pmid:1")), F.create_map(F.lit("@id"), F.concat(F.lit("doi:"), f["doi"]))
        ),
    }))
    listed = F.concat(F.lit('[{"@type":"WebPage","name":"no"}, '), second, F.lit("]"))
    blocks = [
        F.lit('<section class="abstract-note">short</section><div id="abstract-main"><h2>Abstract</h2><p>'), text,
        F.lit("</p></div>"),
    ]
    kind = F.col("doc_id") % 6
    html = (
        F.when(kind == 0, _page([_ld(single), _meta("citation_title", F.lit("other"))], []))
        .when(kind == 1, _page([_ld(listed)], []))
        .when(kind == 2, _page([_ld(F.lit('{"@type": "Article", "name": ')), *metas, _meta("dc.description", text)], []))
        .when(kind == 3, _page(metas, blocks))
        .when(kind == 4, _page([*metas, _meta("og:description", text, "property")], []))
        .otherwise(_page([*metas, _meta("twitter:description", text)], []))
    )
    return _landed(documents, f["link"], html)


def publisher_pages(documents: DataFrame) -> DataFrame:
    """One page with the publisher's own layout per document; four layouts take turns."""
    f = _doc_fields(documents)
    title, text = xml_escape(f["title"]), xml_escape(F.col("text"))
    heading = F.concat(F.lit('<h1 class="c-article-title" data-test="article-title">'), title, F.lit(" <i>in vivo</i></h1>"))
    crumbs = F.concat(
        F.lit('<nav aria-label="breadcrumbs"><ol><li><a href="/">home</a></li><li><a href="/j"> '), F.col("source"),
        F.lit(" </a></li></ol></nav>"),
    )
    history = F.concat(
        F.lit('<ul data-test="publication-history"><li>Received <time datetime="2023-01-01">x</time></li>'
              '<li>Published: <time datetime="'), f["day"], F.lit('T09:00:00Z">x</time></li></ul>'),
    )

    def para(before: str, after: str) -> Column:
        return F.concat(F.lit(f"{before}<p>"), text, F.lit(f"</p>{after}"))

    section = para('<section id="Abs1" data-title="Abstract"><div><h2>Abstract</h2>', "<p>more</p></div></section>")
    lead = para('<div class="c-article-body main-content" data-test="main-content"><h2>x</h2>', "<p>more</p></div>")
    teaser = para('<div class="article__teaser">', "</div>")
    ld = F.to_json(F.struct(F.lit("Article").alias("@type"), F.col("text").alias("description")))
    kind = F.col("doc_id") % 4
    html = (
        F.when(kind == 0, _page([_meta("dc.identifier", F.concat(F.lit("doi:"), f["doi"]))], [heading, crumbs, history, section]))
        .when(kind == 1, _page([
            _meta("citation_title", title), _meta("citation_journal_title", F.col("source")), _meta("description", F.lit("Letter to the Editor")),
            _meta("citation_doi", F.concat(F.lit("https://doi.org/"), f["doi"])), _meta("citation_online_date", F.concat(f["day"], F.lit("T00:00"))),
            _meta("citation_article_type", F.lit("correspondence")),
        ], [lead]))
        .when(kind == 2, _page([_meta("dc.title", title), _meta("prism.publicationName", F.col("source"))], [history, teaser]))
        .otherwise(_page([_ld(ld)], [crumbs]))
    )
    return _landed(documents, F.concat(F.lit("https://www.nature.com/articles/d"), f["id"]), html)


def _landed(documents: DataFrame, url: Column, html: Column) -> DataFrame:
    return documents.select(
        url.alias("url"), F.lit("text/html; charset=utf-8").alias("content_type"), html.alias("html"),
        F.lit(None).cast("string").alias("error"),
    )
