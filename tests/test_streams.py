"""Streams over several micro-batches, with restarts and a batch that is replayed."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators.retries import update_pending
from feedloom.streaming.jobs import ledger_stream, pending_stream

ATTEMPTS = "uid string, attempt_id long, attempted_at timestamp_ntz, ok boolean, error string"


def slices(rows, n):
    return [rows[len(rows) * k // n:len(rows) * (k + 1) // n] for k in range(n)]


def forget_last_commit(checkpoint):
    """As if the driver had been lost between the batch's write and its commit."""
    commits = Path(checkpoint) / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (commits / name).unlink(missing_ok=True)


@pytest.mark.parametrize("seed", [1, 2])
def test_pending_over_batches_and_restarts(spark, tmp_path, seed):
    rnd = random.Random(seed)
    start = datetime(2025, 8, 1)
    rows = [(f"id:{rnd.choice('abcdefgh') if k % 3 else 'hot'}", k, start + timedelta(minutes=k), ok := rnd.random() < 0.3, None if ok else f"HTTP {500 + k}") for k in range(200)]
    checkpoint = f"{tmp_path}/checkpoint"

    def run():
        stream = spark.readStream.schema(ATTEMPTS).parquet(f"file://{tmp_path}/in/*")
        return pending_stream(spark, stream, lambda b: b, f"file://{tmp_path}/pending", f"file://{checkpoint}")

    for k, part in enumerate(slices(rows, 5)):
        spark.createDataFrame(part, ATTEMPTS).write.parquet(f"file://{tmp_path}/in/{k}")
        got = run()
        want = update_pending(spark.createDataFrame([], schemas.PENDING), spark.createDataFrame(rows[:len(rows) * (k + 1) // 5], ATTEMPTS))
        facts = ("uid", "fail_count", "last_error", "first_seen_at", "last_attempt_at")
        answer = sorted(map(tuple, want.select(*facts).collect()))
        assert sorted(map(tuple, got.select(*facts).collect())) == answer
        if k in (1, 4):
            forget_last_commit(checkpoint)
            assert sorted(map(tuple, run().select(*facts).collect())) == answer


def test_ledger_over_batches_and_restarts(spark, tmp_path):
    rnd = random.Random(3)
    kind = "uid string, feed_url string, feed_ord int, polled_at timestamp_ntz, pos int, title string, link string, id_like string, pub_date string, doi string, journal string"
    start = datetime(2025, 8, 1)
    rows = [(f"id:{rnd.randint(0, 40)}", "https://f.org/a", 0, start + timedelta(hours=k // 40), k % 40, "t", f"https://j.org/{k}", None, None, None, None) for k in range(200)]
    checkpoint, seen = f"{tmp_path}/checkpoint", {}

    def run():
        stream = spark.readStream.schema(kind).parquet(f"file://{tmp_path}/in/*")
        return {r.uid: r.article_url for r in ledger_stream(spark, stream, lambda b: b, f"file://{tmp_path}/ledger", f"file://{checkpoint}").collect()}

    for k, part in enumerate(slices(rows, 5)):
        spark.createDataFrame(part, kind).write.parquet(f"file://{tmp_path}/in/{k}")
        got = run()
        assert set(got) == {r[0] for r in rows[:40 * (k + 1)]}
        assert {u: got[u] for u in seen} == seen  # what an earlier batch saw first stays
        seen = got
        if k in (1, 4):
            forget_last_commit(checkpoint)
            assert run() == seen
    ledger = spark.read.parquet(f"file://{tmp_path}/ledger")
    assert ledger.groupBy("uid").count().filter(F.col("count") > 1).count() == 0
