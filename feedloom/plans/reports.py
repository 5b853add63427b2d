"""Digest and listing: topic-filtered selections of articles and their text form."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.dates import flexible_date, local_time
from feedloom.functions.text import as_col, first_filled, truncate
from feedloom.functions.topics import has_topic
from feedloom.operators.ranking import bounded_rank, rank_within
from feedloom.schemas import DEFAULT_TOPIC, TOPICS
from feedloom.session import stage

DIGEST_DAYS = 3
DIGEST_LIMIT = 500
LISTING_LIMIT = 200
SUMMARY_ABSTRACT_LIMIT = 1500

# Report texts.
UNKNOWN_JOURNAL = "UnknownJournal"
LISTING_UNKNOWN_JOURNAL = "Unknown"
NO_DATES = "无数据"
NO_ITEMS_SENTENCE = "local导读：本次未检索到新文章。"
SUMMARY_HEAD, SUMMARY_JOURNALS = "local导读：共收录 ", " 篇；期刊覆盖："
SUMMARY_TAIL = "。建议优先关注方法创新与可复现性。"
TITLE_HEAD, TITLE_DATES = "# 今日导读（主题：", "） — 涵盖时间："
TOC_HEADING, BODY_HEADING, TOC_EMPTY = "## 目录（按期刊）", "## 内容", "- （暂无）"
BODY_FIELDS = (("标题（CN）", "title_cn"), ("类型", "type"), ("发表日期", "pub_date"), ("DOI", "doi"), ("链接", "article_url"))
BODY_TEXTS = (("Abstract(EN)", "abstract_en"), ("Abstract(CN)", "abstract_cn"))
LISTING_HEAD, LISTING_TOPICS, LISTING_ABSTRACT = "# 最新条目（", "） 主题: ", "摘要"
PROMPT_FIELDS = (("期刊", "journal"), ("类型", "type"), ("日期", "pub_date"), ("DOI", "doi"))
PROMPT_TITLE, PROMPT_ABSTRACT = "标题", "摘要(EN)"

_DIGEST_COLUMNS = (
    "uid", "feed_url", "journal", "title_en", "title_cn", "type", "pub_date", "doi", "article_url",
    "abstract_en", "abstract_cn", "topic_tag", "fetched_at",
)
_LISTING_COLUMNS = ("uid", "journal", "title_en", "pub_date", "doi", "article_url", "topic_tag", "fetched_at", "abstract_en")


def newest_first() -> list[Column]:
    return [F.desc_nulls_last("fetched_at"), F.asc("uid")]


def digest_items(
    articles: DataFrame,
    run_ts: datetime,
    topics: Sequence[str] | None = None,
    since_days: int = DIGEST_DAYS,
    limit: int = DIGEST_LIMIT,
    compat: bool = False,
) -> DataFrame:
    """Articles of the last days about the given topics (all known ones by default), newest first.

    The time bound is a literal, so it reaches the Parquet scan. ``limit <= 0`` keeps every row.
    """
    since = local_time(run_ts - timedelta(days=since_days))
    chosen = articles.select(*_DIGEST_COLUMNS).filter(
        (F.col("fetched_at") >= since) & has_topic("topic_tag", topics or TOPICS, compat)
    )
    return chosen.orderBy(*newest_first()).limit(limit) if limit > 0 else chosen


def by_journal(items: DataFrame, bounded: bool = True) -> DataFrame:
    """Items numbered inside their journal, newest first; ``bounded=False`` for results without a limit."""
    keyed = items.withColumn("journal", first_filled("journal", F.lit(UNKNOWN_JOURNAL)))
    numbering = bounded_rank if bounded else rank_within
    return numbering(keyed, ["journal"], newest_first(), "rank_in_journal")


def top_journals(items: DataFrame, n: int = 5) -> DataFrame:
    """Journals with most items; the one met first in newest-first order wins a tie.

    Counting per journal and time first leaves one candidate for "met first" per group, so both steps combine
    map-side.
    """
    per_time = (
        items.filter(F.nullif("journal", F.lit("")).isNotNull())
        .groupBy("journal", "fetched_at")
        .agg(F.count(F.lit(1)).alias("n"), F.min("uid").alias("uid"))
    )
    totals = per_time.groupBy("journal").agg(F.sum("n").alias("n"), F.max(F.struct("fetched_at", "uid")).alias("met"))
    order = [F.desc("n"), F.desc_nulls_last("met.fetched_at"), F.asc("met.uid")]
    return bounded_rank(totals.orderBy(*order).limit(n), [], order, "place").select("journal", "n", "place")


def digest_summary(items: DataFrame, compat: bool = False) -> DataFrame:
    """One row: item count, publication date range and the fallback summary sentence.

    Unreadable dates are left out of the range; with ``compat`` one of them makes the whole range textual.
    """
    return _summary(stage(items.select("uid", "journal", "pub_date", "fetched_at"), "digest-facts"), compat)


def _summary(items: DataFrame, compat: bool = False) -> DataFrame:
    pub = F.nullif(F.col("pub_date"), F.lit(""))
    day = flexible_date("pub_date")
    facts = items.agg(
        F.count(F.lit(1)).alias("n_items"),
        F.min(day).cast("string").alias("first_day"),
        F.max(day).cast("string").alias("last_day"),
        F.min(pub).alias("_low"),
        F.max(pub).alias("_high"),
        F.count_if(pub.isNotNull() & day.isNull()).alias("_unread"),
    )
    coverage = top_journals(items).agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("place", "journal", "n"))),
                lambda j: F.concat(j["journal"], F.lit("×"), j["n"].cast("string")),
            ),
            ", ",
        ).alias("_coverage")
    )
    textual = F.col("_unread") > 0 if compat else F.lit(False)
    low = F.when(textual, F.col("_low")).otherwise(F.col("first_day"))
    high = F.when(textual, F.col("_high")).otherwise(F.col("last_day"))
    both = facts.unionByName(coverage, allowMissingColumns=True)
    one = both.agg(*(F.max(c).alias(c) for c in both.columns))
    return one.select(
        "n_items",
        "first_day",
        "last_day",
        F.coalesce(F.concat(low, F.lit(" ~ "), high), F.lit(NO_DATES)).alias("date_range"),
        F.when(F.col("n_items") == 0, NO_ITEMS_SENTENCE)
        .otherwise(
            F.concat(
                F.lit(SUMMARY_HEAD), F.col("n_items").cast("string"), F.lit(SUMMARY_JOURNALS), F.col("_coverage"),
                F.lit(SUMMARY_TAIL),
            )
        )
        .alias("sentence"),
    )


def _line(text: Column, *needs: str) -> Column:
    shown = F.lit(True)
    for c in needs:
        shown = shown & F.coalesce(F.col(c) != "", F.lit(False))
    return F.when(shown, text)


def _lines(df: DataFrame, section: int, journal: Column, rank: Column, lines: list[Column]) -> DataFrame:
    """Explode the non-null lines of each row, keyed so that sorting restores the document."""
    kept = F.filter(F.array(*lines), lambda x: x.isNotNull())
    return df.select(
        F.lit(section).alias("section"), journal.alias("journal"), rank.cast("int").alias("item"),
        F.posexplode(kept).alias("part", "line"),
    )


def digest_lines(items: DataFrame, topics: Sequence[str] | None = None, bounded: bool = True) -> DataFrame:
    """The Markdown digest as rows; order by section, journal, item, part.

    The selection is written down once: several sections read it, and the articles should be scanned only once.
    """
    none, zero = F.lit(""), F.lit(0)
    items = stage(items, "digest-items")
    ranked = by_journal(items, bounded)
    summary = _summary(items)
    journals = ranked.select("journal").distinct()
    title = F.coalesce(F.col("title_en"), F.lit(""))
    number = F.col("rank_in_journal").cast("string")

    header = _lines(summary, 0, none, zero, [
        F.concat(F.lit(TITLE_HEAD), F.lit("-".join(topics) if topics else "ALL"), F.lit(TITLE_DATES), F.col("date_range")),
        F.col("sentence"),
        F.lit(TOC_HEADING),
        F.when(F.col("n_items") == 0, TOC_EMPTY),
    ])
    toc_journal = _lines(journals, 1, F.col("journal"), zero, [F.concat(F.lit("- "), F.col("journal"))])
    toc_item = _lines(ranked, 1, F.col("journal"), F.col("rank_in_journal"), [
        F.concat(F.lit("  - "), number, F.lit(". "), title, F.coalesce(_line(F.concat(F.lit(" "), F.col("title_cn")), "title_cn"), F.lit(""))),
    ])
    body = _lines(summary, 2, none, zero, [F.when(F.col("n_items") > 0, "---"), F.lit(BODY_HEADING)])
    body_journal = _lines(journals, 3, F.col("journal"), zero, [F.concat(F.lit("### "), F.col("journal"))])
    body_item = _lines(ranked, 3, F.col("journal"), F.col("rank_in_journal"), [
        F.concat(F.lit("**"), number, F.lit(". "), title, F.lit("**")),
        *(_line(F.concat(F.lit(f"**{label}：**"), F.col(c)), c) for label, c in BODY_FIELDS),
        *(x for label, c in BODY_TEXTS for x in (_line(F.lit(f"**{label}：**"), c), _line(F.col(c), c))),
        F.lit("---"),
    ])
    parts = [header, toc_journal, toc_item, body, body_journal, body_item]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


DIGEST_ORDER = ("section", "journal", "item", "part")


def summary_request(items: DataFrame) -> DataFrame:
    """One block of text per bounded item for an external summariser, abstracts shortened."""
    ranked = bounded_rank(items, [], newest_first(), "position")
    lines = [
        F.concat(F.col("position").cast("string"), F.lit(f". {PROMPT_TITLE}: "), F.coalesce(F.col("title_en"), F.lit(""))),
        *(_line(F.concat(F.lit(f"   {label}: "), F.col(c)), c) for label, c in PROMPT_FIELDS),
        _line(F.concat(F.lit(f"   {PROMPT_ABSTRACT}: "), truncate("abstract_en", SUMMARY_ABSTRACT_LIMIT, " ...")), "abstract_en"),
    ]
    return ranked.select("position", "uid", F.concat_ws("\n", *lines).alias("block"))


def latest(
    articles: DataFrame, topics: Sequence[str] | None = None, limit: int = LISTING_LIMIT, compat: bool = False
) -> DataFrame:
    """The newest articles with their position; unreadable times come last."""
    chosen = articles.select(*_LISTING_COLUMNS).filter(has_topic("topic_tag", topics, compat))
    return bounded_rank(chosen.orderBy(*newest_first()).limit(limit), [], newest_first(), "position")


def listing(rows: DataFrame) -> DataFrame:
    """One text block per listed article; lines without a value are left out."""
    text = F.concat_ws(
        "\n",
        F.concat(
            F.col("position").cast("string"), F.lit(". ["), first_filled("topic_tag", F.lit(DEFAULT_TOPIC)), F.lit("] "),
            first_filled("journal", F.lit(LISTING_UNKNOWN_JOURNAL)), F.lit(" | "),
            F.coalesce(F.col("pub_date"), F.lit("")), F.lit(" | "), F.coalesce(F.col("title_en"), F.lit("")),
        ),
        _line(F.concat(F.lit("   DOI: "), F.col("doi")), "doi"),
        _line(F.concat(F.lit("   URL: "), F.col("article_url")), "article_url"),
        _line(F.concat(F.lit(f"   {LISTING_ABSTRACT}: "), F.col("abstract_en")), "abstract_en"),
        F.concat(F.lit("   fetched_at: "), F.coalesce(iso_seconds("fetched_at"), F.lit("None"))),
    )
    return rows.select("position", "uid", text.alias("block"))


def listing_header(run_ts: datetime, topics: Sequence[str] | None = None) -> str:
    return f"{LISTING_HEAD}{run_ts.isoformat(timespec='seconds')}{LISTING_TOPICS}{','.join(topics or ()) or 'ALL'}"


def iso_seconds(c: Column | str) -> Column:
    text = as_col(c).cast("timestamp_ntz").cast("string")
    return F.concat(F.substr(text, F.lit(1), F.lit(10)), F.lit("T"), F.substr(text, F.lit(12), F.lit(8)))
