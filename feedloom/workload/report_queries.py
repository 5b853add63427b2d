"""Digest, listing and article selection."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.operators.identity import doi_requests
from feedloom.plans import backfill, reports
from feedloom.workload import oracle_text as o
from feedloom.workload.registry import query
from feedloom.workload.views import sql_with, view

AI = ("人工智能",)


def _clock(articles: DataFrame) -> datetime:
    """The latest fetch stands for the time of the run."""
    return articles.agg(F.max("fetched_at")).first()[0]


def _digest(spark: SparkSession, sf: str, topics=None) -> DataFrame:
    articles = view(spark, sf, "articles_v")
    return reports.digest_items(articles, _clock(articles), topics)


def _items_sql(topics=None) -> str:
    return f"""items AS (SELECT *, coalesce(nullif(journal, ''), 'UnknownJournal') AS j FROM articles_v
WHERE fetched_at >= (SELECT max(fetched_at) FROM articles_v) - INTERVAL 3 DAY
  AND {o.has_topic('topic_tag', topics) if topics else o.has_topic('topic_tag')}
ORDER BY fetched_at DESC, uid LIMIT 500),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY j ORDER BY fetched_at DESC, uid) AS INT) AS rk FROM items)"""


def _digest_sql(body: str, topics=None) -> str:
    return sql_with("", "articles_v").rstrip() + ",\n" + _items_sql(topics) + "\n" + body


@query("digest_items", _digest_sql("SELECT uid, journal, title_en, fetched_at FROM items"))
def digest_items(spark, sf):
    return _digest(spark, sf).select("uid", "journal", "title_en", "fetched_at")


@query("digest_by_journal", _digest_sql("SELECT j AS journal, rk AS rank_in_journal, uid FROM ranked", AI))
def digest_by_journal(spark, sf):
    return reports.by_journal(_digest(spark, sf, AI)).select("journal", "rank_in_journal", "uid")


_TOP_SQL = """top AS (SELECT journal, count(*) AS n, max(fetched_at) AS newest,
       arg_min(uid, (-epoch_us(fetched_at), uid)) AS newest_uid
FROM items WHERE coalesce(journal, '') <> '' GROUP BY journal ORDER BY n DESC, newest DESC, newest_uid LIMIT 5)"""


@query("digest_top_journals", _digest_sql("", None).rstrip() + f",\n{_TOP_SQL}\nSELECT journal, n FROM top")
def digest_top_journals(spark, sf):
    return reports.top_journals(_digest(spark, sf)).select("journal", "n")


_SUMMARY_SQL = f"""{_TOP_SQL},
days AS (SELECT try_cast(CASE WHEN length(pub_date) = 7 THEN pub_date || '-01' ELSE nullif(pub_date, '') END AS DATE) AS d FROM items),
facts AS (SELECT CAST(min(d) AS VARCHAR) AS lo, CAST(max(d) AS VARCHAR) AS hi FROM days),
summary AS (SELECT (SELECT count(*) FROM items) AS n_items, lo AS first_day, hi AS last_day, lo || ' ~ ' || hi AS date_range,
  'local导读：共收录 ' || (SELECT count(*) FROM items) || ' 篇；期刊覆盖：' ||
  (SELECT string_agg(journal || '×' || n, ', ' ORDER BY n DESC, newest DESC, newest_uid) FROM top)
  || '。建议优先关注方法创新与可复现性。' AS sentence FROM facts)"""


@query("digest_summary", _digest_sql("").rstrip() + f",\n{_SUMMARY_SQL}\nSELECT * FROM summary")
def digest_summary(spark, sf):
    return reports.digest_summary(_digest(spark, sf))


def _field(label: str, c: str) -> str:
    return f"CASE WHEN {c} <> '' THEN '**{label}：**' || {c} END"


def _text(label: str, c: str) -> str:
    return f"CASE WHEN {c} <> '' THEN '**{label}：**' END, CASE WHEN {c} <> '' THEN {c} END"


_LINES_SQL = f"""{_SUMMARY_SQL},
parts AS (
SELECT 0 AS section, '' AS journal, 0 AS item, ['# 今日导读（主题：人工智能） — 涵盖时间：' || date_range, sentence, '## 目录（按期刊）'] AS l FROM summary
UNION ALL SELECT DISTINCT 1, j, 0, ['- ' || j] FROM ranked
UNION ALL SELECT 1, j, rk, ['  - ' || rk || '. ' || title_en || coalesce(' ' || title_cn, '')] FROM ranked
UNION ALL SELECT 2, '', 0, ['---', '## 内容']
UNION ALL SELECT DISTINCT 3, j, 0, ['### ' || j] FROM ranked
UNION ALL SELECT 3, j, rk, list_filter(['**' || rk || '. ' || title_en || '**', {_field('标题（CN）', 'title_cn')}, {_field('类型', 'type')},
  {_field('发表日期', 'pub_date')}, {_field('DOI', 'doi')}, {_field('链接', 'article_url')}, {_text('Abstract(EN)', 'abstract_en')},
  {_text('Abstract(CN)', 'abstract_cn')}, '---'], lambda x: x IS NOT NULL) FROM ranked)
SELECT section, journal, item, CAST(unnest(generate_series(0, len(l) - 1)) AS INT) AS part, unnest(l) AS line FROM parts"""


@query("digest_lines", _digest_sql("", AI).rstrip() + ",\n" + _LINES_SQL)
def digest_lines(spark, sf):
    return reports.digest_lines(_digest(spark, sf, AI), AI)


@query(
    "digest_unlimited_rank",
    sql_with(
        """SELECT uid, coalesce(journal, 'UnknownJournal') AS journal,
CAST(row_number() OVER (PARTITION BY coalesce(journal, 'UnknownJournal') ORDER BY fetched_at DESC, uid) AS INT) AS rank_in_journal
FROM articles_v""",
        "articles_v",
    ),
)
def digest_unlimited_rank(spark, sf):
    """Ranks inside journals without a limit: no journal is ever gathered in one task."""
    articles = view(spark, sf, "articles_v").select("uid", "journal", "fetched_at")
    return reports.by_journal(articles, bounded=False).select("uid", "journal", "rank_in_journal")


@query(
    "digest_request",
    _digest_sql("""SELECT CAST(row_number() OVER (ORDER BY fetched_at DESC, uid) AS INT) AS position, uid,
row_number() OVER (ORDER BY fetched_at DESC, uid) || '. 标题: ' || title_en || coalesce(chr(10) || '   期刊: ' || journal, '')
|| coalesce(chr(10) || '   类型: ' || type, '') || coalesce(chr(10) || '   日期: ' || nullif(pub_date, ''), '')
|| chr(10) || '   DOI: ' || doi
|| coalesce(chr(10) || '   摘要(EN): ' || CASE WHEN length(abstract_en) > 1500 THEN substr(abstract_en, 1, 1500) || ' ...' ELSE abstract_en END, '') AS block
FROM items"""),
)
def digest_request(spark, sf):
    return reports.summary_request(_digest(spark, sf))


def _latest_sql(where: str) -> str:
    return sql_with(
        f"""SELECT *, rn || '. [' || coalesce(nullif(topic_tag, ''), '其他') || '] ' || coalesce(journal, 'Unknown') || ' | '
|| coalesce(pub_date, '') || ' | ' || title_en || chr(10) || '   DOI: ' || doi || coalesce(chr(10) || '   URL: ' || article_url, '')
|| coalesce(chr(10) || '   摘要: ' || abstract_en, '') || chr(10) || '   fetched_at: ' || strftime(fetched_at, '%Y-%m-%dT%H:%M:%S') AS b
FROM (SELECT *, CAST(row_number() OVER (ORDER BY fetched_at DESC, uid) AS INT) AS rn FROM articles_v WHERE {where}) WHERE rn <= 200""",
        "articles_v",
    ).replace("SELECT *, rn ||", "SELECT rn AS position, uid, rn ||").replace(" AS b\n", " AS block\n")


@query("latest_n", _latest_sql("true"))
def latest_n(spark, sf):
    return reports.listing(reports.latest(view(spark, sf, "articles_v")))


@query("latest_n_topic", _latest_sql(o.has_topic("topic_tag", AI)))
def latest_n_topic(spark, sf):
    return reports.listing(reports.latest(view(spark, sf, "articles_v"), AI))


@query("latest_n_topic_compat", _latest_sql("topic_tag IN ('人工智能')"))
def latest_n_topic_compat(spark, sf):
    return reports.listing(reports.latest(view(spark, sf, "articles_v"), AI, compat=True))


@query(
    "range_candidates",
    sql_with(
        """SELECT uid, article_url, fetched_at, pub_date FROM articles_v
WHERE CAST(fetched_at AS DATE) = (SELECT CAST(max(fetched_at) AS DATE) - 1 FROM articles_v)""",
        "articles_v",
    ),
)
def range_candidates(spark, sf):
    articles = view(spark, sf, "articles_v")
    day = _clock(articles).date() - timedelta(days=1)
    return backfill.range_candidates(articles, day, day).select("uid", "article_url", "fetched_at", "pub_date")


_DOIS_SQL = f"""requested AS (
SELECT 0 AS src, ord, part, nullif(trim(raw), '') AS raw FROM (
  SELECT ord, unnest(generate_series(0, len(p) - 1)) AS part, unnest(p) AS raw FROM (SELECT ord, string_split(value, ',') AS p FROM doi_args_v))
UNION ALL SELECT 1, ord, 0, nullif(trim(value), '') FROM doi_lines_v WHERE NOT starts_with(trim(value), '#')),
keyed AS (SELECT *, {o.lookup_doi('raw')} AS doi_key FROM requested),
dois AS (SELECT doi_key, arg_min(raw, (src, ord, part)) AS doi_raw FROM keyed WHERE doi_key <> '' GROUP BY doi_key)"""


@query("doi_list", sql_with("", "doi_args_v", "doi_lines_v").rstrip() + f",\n{_DOIS_SQL}\nSELECT doi_key, doi_raw FROM dois")
def doi_list(spark, sf):
    return doi_requests(view(spark, sf, "doi_args_v"), view(spark, sf, "doi_lines_v")).select("doi_key", "doi_raw")


_LINE_DOIS_SQL = f"""dois AS (SELECT DISTINCT {o.lookup_doi('value')} AS doi_key FROM doi_lines_v
WHERE NOT starts_with(trim(value), '#') AND {o.lookup_doi('value')} <> '')"""


@query(
    "doi_lookup",
    sql_with("", "articles_v", "doi_lines_v").rstrip() + f""",\n{_LINE_DOIS_SQL}
SELECT uid, doi, article_url FROM articles_v a WHERE EXISTS (SELECT 1 FROM dois WHERE doi_key = lower(a.doi)
OR contains(lower(a.article_url), 'doi.org/' || doi_key))""",
)
def doi_lookup(spark, sf):
    dois = doi_requests(lines=view(spark, sf, "doi_lines_v"))
    return backfill.doi_candidates(view(spark, sf, "articles_v"), dois).select("uid", "doi", "article_url")
