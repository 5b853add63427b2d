"""Ingestion: landed payloads to articles, ledger, retry table and run log."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.functions.dates import local_time
from feedloom.functions.identifiers import ingest_doi, is_html_type, normalize_link
from feedloom.functions.text import first_filled
from feedloom.functions.topics import encode_tags, label_from_answer, tagging_text, topic_array
from feedloom.operators import feeds as feed_ops
from feedloom.operators.identity import dedupe_items, item_uid, new_items, unseen
from feedloom.operators.merge import replace_rows
from feedloom.operators.pages import reconcile, records_for
from feedloom.operators.retries import RetryPolicy, due_retries, retry_items, update_pending
from feedloom.operators.skew import heavy_keys, salted_join
from feedloom.plans.runs import log_row, run_status
from feedloom.session import stage, staging
from feedloom.sources import tables
from feedloom.sources.tables import Store

LAST_UPDATE_KEY = "last_global_update_at"
# Errors recorded for pages that cannot be used.
PAGE_MISSING, NOT_HTML = "page not landed", "Non-HTML content-type: "


def page_failure(page: str = "page") -> Column:
    """NULL for a usable page, else the error to record."""
    content_type = F.coalesce(F.col(f"{page}.content_type"), F.lit(""))
    return (
        F.when(F.col(page).isNull(), PAGE_MISSING)
        .when(F.col(f"{page}.error").isNotNull(), F.col(f"{page}.error"))
        .when(~is_html_type(content_type), F.concat(F.lit(NOT_HTML), content_type))
    )


def read_pages(items: DataFrame, page_payloads: DataFrame, compat: bool = False) -> DataFrame:
    """Each item with its page record (``page``, NULL if none landed) and ``failure``.

    Items with the same or no link are salted.
    """
    wanted = items.withColumn("url", F.nullif(normalize_link("link"), F.lit("")))
    records = records_for(wanted, page_payloads, compat)
    joined = salted_join(wanted, records, "url", "left", "uid", heavy_keys(wanted, "url"))
    return joined.withColumn("failure", page_failure())


def article_rows(
    read: DataFrame, run_ts: datetime, labels: DataFrame | None = None, translations: DataFrame | None = None
) -> DataFrame:
    """Article rows of the items whose page could be read.

    ``labels(uid, answer)`` may carry an external classifier's answers, ``translations(uid, title_cn,
    abstract_cn)`` an external translator's.
    """
    now = local_time(run_ts)
    item = F.struct("title", "pub_date", "doi", "link").alias("item")
    rows = read.filter("failure IS NULL").select("uid", "feed_url", item, "page")
    rows = rows.select("uid", "feed_url", *(c.alias(n) for n, c in reconcile("item", "page").items()))
    text = tagging_text("title_en", "abstract_en")
    if labels is not None:
        rows = rows.join(labels.select("uid", "answer"), "uid", "left")
        tags = topic_array(text, label_from_answer("answer", text))
    else:
        tags = topic_array(text)
    rows = rows.withColumn("topic_tag", encode_tags(tags))
    if translations is not None:
        rows = rows.join(translations.select("uid", "title_cn", "abstract_cn"), "uid", "left")
    return schemas.conform(rows.withColumn("fetched_at", now).withColumn("last_updated_at", now), schemas.ARTICLES)


def attempt_rows(read: DataFrame, run_ts: datetime) -> DataFrame:
    return read.select(
        "uid",
        F.lit(0).alias("attempt_id"),
        local_time(run_ts).alias("attempted_at"),
        F.col("failure").isNull().alias("ok"),
        F.col("failure").alias("error"),
        "feed_url",
        first_filled("url", F.lit("")).alias("article_url"),
        ingest_doi("doi").alias("doi"),
        "pub_date",
    )


def seen_rows(articles: DataFrame) -> DataFrame:
    return articles.select(
        "uid", "feed_url", "article_url", "doi", "pub_date", F.col("fetched_at").alias("first_seen_at")
    )


def find_new_items(read: DataFrame, seen: DataFrame, max_items: int = feed_ops.MAX_ITEMS_PER_FEED) -> DataFrame:
    """The items of ``feeds.read_feeds`` that the ledger does not know, one per uid."""
    return new_items(_identified(read, max_items), seen)


def _identified(read: DataFrame, max_items: int) -> DataFrame:
    return feed_ops.items_of(read, max_items).drop("dialect").withColumn("uid", item_uid())


def items_to_retry(pending: DataFrame, fresh: DataFrame, ledger: Callable[[DataFrame], DataFrame], run_ts: datetime, policy: RetryPolicy) -> DataFrame:
    """Items that failed before and are due, whether or not their feed serves them again; one that it does serve is
    among ``fresh`` already, and one stored since has nothing to retry. ``ledger`` gives what is known of some uids."""
    due = stage(retry_items(due_retries(pending, run_ts, policy)).join(fresh.select("uid"), "uid", "left_anti"), "due")
    return unseen(due, ledger(due))


def run_ingest(
    spark: SparkSession,
    store: Store,
    feed_payloads: DataFrame,
    page_payloads: DataFrame,
    run_ts: datetime,
    run_id: str,
    max_items: int = feed_ops.MAX_ITEMS_PER_FEED,
    labels: DataFrame | None = None,
    translations: DataFrame | None = None,
    compat: bool = False,
    retries: RetryPolicy | None = None,
) -> dict:
    """One ingestion run. Running it again with the same ``run_id`` leaves the same tables.

    With ``retries``, items that failed in earlier runs are tried again when they are due.
    The ledger is written last: until then a repeated run finds the same new items again. A run that fails leaves an
    ``error`` row in the log, which its repetition replaces.
    """
    try:
        with staging(spark):
            return _ingest(spark, store, feed_payloads, page_payloads, run_ts, run_id, max_items, labels, translations, compat, retries)
    except Exception as e:
        log = log_row(spark, run_id, "ingest", run_ts, run_ts, "error", 0, f"{type(e).__name__}: {e}")
        tables.append_run(log, store.path("runs_log"), schemas.RUNS_LOG, run_id)
        raise


def _ingest(spark, store, feed_payloads, page_payloads, run_ts, run_id, max_items, labels, translations, compat, retries) -> dict:
    this_run = F.col(tables.RUN) == run_id
    feeds_read = stage(feed_ops.read_feeds(feed_payloads), "feeds-read")
    polls = feed_ops.polls_of(feeds_read)
    batch = stage(dedupe_items(_identified(feeds_read, max_items)), "batch-items")

    def ledger(keys: DataFrame) -> DataFrame:
        return tables.read_ledger(spark, store.path("seen"), schemas.SEEN, keys).filter(~this_run)

    fresh = stage(unseen(batch, ledger(batch)), "new-items")

    def before(table: str, schema) -> DataFrame:
        return tables.read_snapshot(spark, store.path(table), schema, before_run=run_id)

    def publish(df: DataFrame, table: str, schema) -> None:
        tables.write_snapshot(df, store.path(table), schema, run_id)

    if retries:
        again = items_to_retry(before("pending", schemas.PENDING), fresh, ledger, run_ts, retries)
        fresh = fresh.unionByName(stage(again, "retries"))
    read = stage(read_pages(fresh, page_payloads, compat), "read-pages")
    articles = stage(article_rows(read, run_ts, labels, translations), "article-rows")

    tables.merge_articles(spark, store.path("articles"), articles)

    attempts = attempt_rows(read, run_ts)
    publish(update_pending(before("pending", schemas.PENDING), attempts), "pending", schemas.PENDING)
    publish(feed_ops.feed_state(before("feeds", schemas.FEEDS), polls), "feeds", schemas.FEEDS)

    counts = run_status(attempts).first()
    broken, refused = feed_ops.poll_failures(polls)
    failures = counts["failures"] + broken + refused
    status = "ok" if failures == 0 else ("partial_ok" if counts["inserted"] > 0 else "error")
    log = log_row(
        spark, run_id, "ingest", run_ts, run_ts, status, counts["inserted"], f"fails={failures} broken_feeds={broken} failed_polls={refused}"
    )
    tables.append_run(log, store.path("runs_log"), schemas.RUNS_LOG, run_id)
    updated = spark.createDataFrame([(LAST_UPDATE_KEY, run_ts.isoformat(timespec="seconds"))], schemas.META)
    publish(replace_rows(before("meta", schemas.META), updated, "key"), "meta", schemas.META)
    tables.append_run(seen_rows(articles), store.path("seen"), schemas.SEEN, run_id)
    tables.merge_runs(spark, store.path("seen"), schemas.SEEN, key="uid")
    tables.merge_runs(spark, store.path("runs_log"), schemas.RUNS_LOG)
    return {"inserted": counts["inserted"], "failures": failures, "status": status}
