"""Incremental runs with Structured Streaming.

Each micro-batch runs the batch plan and writes under the id of its stream, which the checkpoint keeps, and its batch
id: a replayed batch replaces its own output, and never that of another stream or of a new checkpoint.
The ledger is a table, not streaming state: it never expires and costs one anti-join per batch.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedloom import schemas
from feedloom.operators.identity import dedupe_items, unseen
from feedloom.operators.retries import update_pending
from feedloom.plans.ingest import run_ingest
from feedloom.session import stage, staging
from feedloom.sources import tables
from feedloom.sources.tables import Store


def _run_available(stream: DataFrame, on_batch: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    query = (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def _run_id(batch: DataFrame, batch_id: int) -> str:
    stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"batch-{stream}-{batch_id}"


def ingest_stream(
    spark: SparkSession,
    feed_payloads: DataFrame,
    page_payloads: Callable[[], DataFrame],
    store: Store,
    checkpoint: str,
    clock: Callable[[DataFrame], datetime] | None = None,
    **options,
) -> None:
    """Ingest all landed feed payloads not ingested yet. A batch's clock is its latest poll time."""
    def latest_poll(batch: DataFrame) -> datetime:
        polled = batch.agg(F.max("polled_at")).first()[0]
        return polled or datetime.now(timezone.utc).replace(tzinfo=None)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        run_ts = (clock or latest_poll)(batch)
        run_ingest(spark, store, batch, page_payloads(), run_ts, _run_id(batch, batch_id), **options)

    _run_available(feed_payloads, on_batch, checkpoint)


def ledger_stream(
    spark: SparkSession, items: DataFrame, prepare: Callable[[DataFrame], DataFrame], ledger: str, checkpoint: str
) -> DataFrame:
    """Exact first-seen items over all batches: anti-join with the ledger, then append under the batch id."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        run = _run_id(batch, batch_id)
        with staging(spark):
            items = stage(dedupe_items(prepare(batch)), "batch-items")
            seen = tables.read_ledger(spark, ledger, schemas.SEEN, items).filter(F.col(tables.RUN) != run)
            first = unseen(items, seen).select(
                "uid", "feed_url", F.col("link").alias("article_url"), "doi", "pub_date",
                F.lit(None).cast("timestamp_ntz").alias("first_seen_at"),
            )
            tables.append_run(first, ledger, schemas.SEEN, run)
        tables.merge_runs(spark, ledger, schemas.SEEN, key="uid")

    _run_available(items, on_batch, checkpoint)
    return tables.read_appended(spark, ledger, schemas.SEEN)


def pending_stream(
    spark: SparkSession, attempts: DataFrame, prepare: Callable[[DataFrame], DataFrame], table: str, checkpoint: str
) -> DataFrame:
    """The retry table after all batches of attempts; each writes a snapshot, of which the last few stay."""
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        run = _run_id(batch, batch_id)
        pending = tables.read_snapshot(spark, table, schemas.PENDING, before_run=run)
        tables.write_snapshot(update_pending(pending, prepare(batch)), table, schemas.PENDING, run)

    _run_available(attempts, on_batch, checkpoint)
    return tables.read_snapshot(spark, table, schemas.PENDING)
