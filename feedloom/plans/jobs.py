"""Whole jobs over a store: digest, listing and backfill, each with its line in the run log.

Ingestion is ``feedloom.plans.ingest.run_ingest``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from feedloom import schemas
from feedloom.functions.topics import has_topic
from feedloom.plans import backfill, reports
from feedloom.plans.runs import log_row
from feedloom.session import stage, staging
from feedloom.sources import tables, text_sinks
from feedloom.sources.tables import Store


def _log(spark, store: Store, run_id: str, script: str, run_ts: datetime, rows: int, notes: str, status: str = "ok") -> None:
    row = log_row(spark, run_id, script, run_ts, run_ts, status, rows, notes)
    tables.append_run(row, store.path("runs_log"), schemas.RUNS_LOG, run_id)


@contextmanager
def _job(spark: SparkSession, store: Store, run_id: str, script: str, run_ts: datetime) -> Iterator[None]:
    """A job's staged tables go at its end; one that fails leaves an ``error`` row, which its repetition replaces."""
    try:
        with staging(spark):
            yield
    except Exception as e:
        _log(spark, store, run_id, script, run_ts, 0, f"{type(e).__name__}: {e}", "error")
        raise


def run_digest(
    spark: SparkSession,
    store: Store,
    out: str,
    run_ts: datetime,
    run_id: str,
    topics: Sequence[str] | None = None,
    since_days: int = reports.DIGEST_DAYS,
    limit: int = reports.DIGEST_LIMIT,
) -> int:
    """Write the Markdown digest; for one without a limit see also ``write_digest_by_journal``."""
    with _job(spark, store, run_id, "digest", run_ts):
        since = (run_ts - timedelta(days=since_days)).date()
        articles = tables.read_articles(spark, store.path("articles"), first=since)
        items = stage(reports.digest_items(articles, run_ts, topics, since_days, limit), "digest")
        text_sinks.write_digest(reports.digest_lines(items, topics, bounded=limit > 0), out)
        n = items.count()
        _log(spark, store, run_id, "digest", run_ts, n, f"topics={'-'.join(topics) if topics else 'ALL'}; file={out}")
        return n


def run_latest(
    spark: SparkSession,
    store: Store,
    out: str,
    run_ts: datetime,
    run_id: str,
    topics: Sequence[str] | None = None,
    limit: int = reports.LISTING_LIMIT,
) -> int:
    """Write the numbered listing of the newest articles, reading only the days that can hold them."""
    with _job(spark, store, run_id, "latest", run_ts):
        path = store.path("articles")
        about = tables.read_articles(spark, path).filter(has_topic("topic_tag", topics))
        articles = tables.read_articles(spark, path, first=tables.newest_days(about, limit))
        blocks = stage(reports.listing(reports.latest(articles, topics, limit)), "listing")
        text_sinks.write_listing(blocks, out, run_ts, topics)
        n = blocks.count()
        _log(spark, store, run_id, "latest", run_ts, n, f"topics={list(topics or ())}")
        return n


def run_backfill(
    spark: SparkSession,
    store: Store,
    page_payloads: DataFrame,
    run_ts: datetime,
    run_id: str,
    start: date | None = None,
    end: date | None = None,
    limit: int = 0,
    dois: DataFrame | None = None,
    reclassify: bool = False,
    translate: Callable[[DataFrame], DataFrame] | None = None,
    approve: Callable[[DataFrame], DataFrame] | None = None,
    dry_run: bool = False,
) -> dict:
    """Plan and apply a backfill by date range, or by DOI if ``dois(doi_key)`` is given.

    ``translate`` turns work ``(src_hash, text)`` into answers of the same shape; ``approve`` turns the change
    summary ``(uid, changes)`` into the uids that may be written. Only the days with changes are rewritten.
    """
    with _job(spark, store, run_id, "backfill", run_ts):
        doi_mode = dois is not None
        path = store.path("articles")
        articles = tables.read_articles(spark, path)
        if doi_mode:
            candidates = backfill.range_candidates(backfill.doi_candidates(articles, dois))
        else:
            candidates = backfill.range_candidates(tables.read_articles(spark, path, start, end), start, end, limit)
        sources = backfill.prepare_backfill(candidates, backfill.page_probes(candidates, page_payloads), doi_mode)
        answers = translate(backfill.translation_work(sources)) if translate else None
        plan = backfill.plan_backfill(sources, answers, reclassify, doi_mode)
        counts = backfill.plan_counts(plan).first().asDict()
        applied = 0
        if not dry_run and counts["to_apply"]:
            approved = stage(approve(backfill.change_summary(plan)).select("uid"), "approved") if approve else None
            changes = stage(backfill.approved_changes(plan, approved), "changes")
            applied = changes.count()

            def write(version: tables.Version) -> None:
                now = tables.read_articles(spark, path, version=version)
                if days := tables.touched_days(now, changes):
                    old = now.filter(tables.on_days(days)).drop(tables.DAY)
                    tables.write_articles(backfill.apply_plan(old, plan, run_ts, approved), path, version)

            tables.write_again_on_conflict(write, spark, path)
        skipped = 0 if dry_run else counts["to_apply"] - applied
        notes = "; ".join([
            f"mode={'doi_mode' if doi_mode else 'date_range'}", f"rows={counts['rows']}", f"applied={applied}", f"skipped={skipped}",
            f"trans={counts['trans']} tag={counts['tag']} meta={counts['meta']}",
            f"range=({start}..{end}) dry_run={dry_run} reclassify={reclassify or doi_mode}",
        ])
        _log(spark, store, run_id, "backfill", run_ts, applied, notes)
        return {**counts, "applied": applied, "skipped": skipped}
