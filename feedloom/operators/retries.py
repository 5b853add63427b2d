"""Failure bookkeeping: how often a uid failed since it last succeeded."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.functions.dates import local_time
from feedloom.functions.text import truncate
from feedloom.operators.skew import heavy_keys, salted_join

ERROR_LIMIT = 500
_ITEM_COLUMNS = ("feed_url", "article_url", "doi", "pub_date")


def open_failures(attempts: DataFrame) -> DataFrame:
    """Per uid: whether it ever succeeded here, and its failures after the last success.

    ``attempts(uid, attempt_id, attempted_at, ok, error, …)``; attempts are ordered by time, then id. Both
    aggregates combine map-side, and the join between them salts uids with very many attempts.
    """
    have = set(attempts.columns)
    when = F.struct("attempted_at", "attempt_id")
    last_ok = attempts.filter("ok").groupBy("uid").agg(F.max(when).alias("last_ok"))
    failed = attempts.filter(~F.col("ok")).select(
        "uid", when.alias("at"), truncate("error", ERROR_LIMIT).alias("error"),
        *((F.col(c) if c in have else F.lit(None).cast("string")).alias(c) for c in _ITEM_COLUMNS),
    )
    since = salted_join(failed, last_ok, "uid", "left", "at", heavy_keys(failed, "uid")).filter(
        F.col("last_ok").isNull() | (F.col("at") > F.col("last_ok"))
    )
    open_ = since.groupBy("uid").agg(
        F.count(F.lit(1)).alias("n"),
        F.max_by("error", "at").alias("last_error"),
        F.min("at.attempted_at").alias("first_at"),
        F.max("at.attempted_at").alias("last_at"),
        F.min_by(F.struct(*_ITEM_COLUMNS), "at").alias("item"),
    )
    return (
        open_.join(last_ok.select("uid", F.lit(True).alias("succeeded")), "uid", "full_outer")
        .withColumn("n", F.coalesce("n", F.lit(0)))
        .withColumn("succeeded", F.coalesce("succeeded", F.lit(False)))
    )


def update_pending(pending: DataFrame, attempts: DataFrame) -> DataFrame:
    """The pending table after a batch of attempts.

    A success removes the row; failures after it start a new one. Otherwise failures add to the old count and
    refresh only the error and the time of the last attempt.
    """
    p, b = pending.alias("p"), open_failures(attempts).alias("b")
    joined = p.join(b, F.col("p.uid") == F.col("b.uid"), "full_outer")
    kept = F.col("p.uid").isNotNull() & ~F.coalesce(F.col("b.succeeded"), F.lit(False))
    n = F.coalesce(F.col("b.n"), F.lit(0))

    def first(old: str, new: str):
        return F.when(kept, F.col(f"p.{old}")).otherwise(F.col(f"b.{new}"))

    merged = joined.select(
        F.coalesce("p.uid", "b.uid").alias("uid"),
        *(first(c, f"item.{c}").alias(c) for c in _ITEM_COLUMNS),
        (F.when(kept, F.col("p.fail_count")).otherwise(0) + n).cast("long").alias("fail_count"),
        F.when(n > 0, F.col("b.last_error")).otherwise(F.col("p.last_error")).alias("last_error"),
        first("first_seen_at", "first_at").alias("first_seen_at"),
        F.when(n > 0, F.col("b.last_at")).otherwise(F.col("p.last_attempt_at")).alias("last_attempt_at"),
    )
    return merged.filter("fail_count > 0").select(*schemas.PENDING.names)


def retry_candidates(pending: DataFrame, max_fail: int) -> DataFrame:
    """Pending rows worth another attempt, whether or not their feed serves them again."""
    return pending.filter(F.col("fail_count") <= max_fail)


@dataclass(frozen=True)
class RetryPolicy:
    """How long a failed item waits for its next attempt, and after how many failures it gets none."""

    max_fail: int = 8
    first_wait: timedelta = timedelta(hours=6)
    factor: float = 2.0
    longest_wait: timedelta = timedelta(days=7)


def due_retries(pending: DataFrame, run_ts: datetime, policy: RetryPolicy = RetryPolicy()) -> DataFrame:
    """Pending rows whose wait is over: it starts at ``first_wait`` and grows by ``factor`` with each failure."""
    wait = F.lit(policy.first_wait.total_seconds()) * F.pow(F.lit(float(policy.factor)), F.col("fail_count") - 1)
    seconds = F.least(wait, F.lit(policy.longest_wait.total_seconds()))
    over = F.col("last_attempt_at") + F.make_dt_interval(secs=seconds) <= local_time(run_ts)
    return retry_candidates(pending, policy.max_fail).filter(F.coalesce(over, F.lit(True)))


def retry_items(due: DataFrame) -> DataFrame:
    """Pending rows as items with the identity they have; what only a feed could say is NULL."""
    no = F.lit(None)
    return due.select(
        "uid", "feed_url", no.cast("int").alias("feed_ord"), no.cast("timestamp_ntz").alias("polled_at"), no.cast("int").alias("pos"),
        no.cast("string").alias("title"), F.col("article_url").alias("link"), no.cast("string").alias("id_like"), "pub_date", "doi",
        no.cast("string").alias("journal"))
