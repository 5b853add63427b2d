"""Cases of the store and of feeds that the queries' inputs do not hold."""

from datetime import datetime

import pytest

from feedloom import schemas
from feedloom.operators import feeds
from feedloom.operators import identity, merge
from feedloom.plans.ingest import run_ingest
from feedloom.session import stage, staging
from feedloom.sources import tables
from feedloom.streaming.jobs import ledger_stream


@pytest.fixture
def store(tmp_path):
    return tables.Store(f"file://{tmp_path}")


def article(spark, uid, title, at):
    return schemas.conform(spark.createDataFrame([(uid, title, at)], "uid string, title_en string, fetched_at timestamp"), schemas.ARTICLES)


def test_articles_without_a_fetch_time_are_replaced(spark, store):
    path = store.path("articles")
    tables.merge_articles(spark, path, article(spark, "n1", "old", None).unionByName(article(spark, "n2", "kept", None)))
    tables.merge_articles(spark, path, article(spark, "n1", "new", None))
    tables.merge_articles(spark, path, article(spark, "d1", "dated", datetime(2025, 1, 2)))
    got = sorted((r.uid, r.title_en) for r in tables.read_articles(spark, path).collect())
    assert got == [("d1", "dated"), ("n1", "new"), ("n2", "kept")]


def test_a_replay_without_rows_clears_the_run(spark, store):
    path = store.path("seen")
    rows = schemas.conform(spark.createDataFrame([("a",)], "uid string"), schemas.SEEN)
    for run in ("run 1", "run 2"):
        tables.append_run(rows, path, schemas.SEEN, run)
    tables.append_run(rows.where("1 = 0"), path, schemas.SEEN, "run 1")
    assert [r[tables.RUN] for r in tables.read_appended(spark, path, schemas.SEEN).collect()] == ["run 2"]


def test_long_feeds_are_taken_whole_and_refused_polls_counted(spark):
    items = "".join(f"<item><title>t{i}</title><link>http://x.org/{i}</link></item>" for i in range(250))
    rss = f'<rss version="2.0"><channel><title>f</title>{items}</channel></rss>'
    polls = spark.createDataFrame([("a", 0, 200, rss), ("b", 1, 503, "busy"), ("c", 2, 304, None)], "feed_url string, feed_ord int, status int, content string")
    assert feeds.feed_items(polls).count() == 250
    assert feeds.feed_items(polls, 20).count() == 20
    assert [r.feed_url for r in feeds.failed_polls(polls).collect()] == ["b"]


def test_a_write_lost_before_publishing_changes_nothing(spark, store, monkeypatch):
    path = store.path("articles")
    tables.merge_articles(spark, path, article(spark, "a", "old", datetime(2025, 1, 2)))
    begun = tables.read_articles(spark, path)
    with monkeypatch.context() as m:
        m.setattr(tables, "_publish", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tables.merge_articles(spark, path, article(spark, "a", "new", datetime(2025, 1, 2)))
    assert [r.title_en for r in tables.read_articles(spark, path).collect()] == ["old"]
    tables.merge_articles(spark, path, article(spark, "a", "new", datetime(2025, 1, 2)))
    assert [r.title_en for r in tables.read_articles(spark, path).collect()] == ["new"]
    assert [r.title_en for r in begun.collect()] == ["old"]
    with pytest.raises(RuntimeError):
        tables._publish(spark, path, 2, [])
    tables.expire_articles(spark, path, keep=1)
    assert [r.title_en for r in tables.read_articles(spark, path).collect()] == ["new"]
    fs, p = tables._fs_path(spark, path)
    assert len([s for s in fs.listStatus(p) if s.getPath().getName().startswith("version=")]) == 1


def test_streams_on_one_ledger_do_not_replace_each_other(spark, store, tmp_path):
    schema = "uid string, feed_ord int, pos int, feed_url string, link string, doi string, pub_date string"
    for name, uids in (("one", "ab"), ("two", "bc")):
        rows = [(u, 0, i, "f", None, None, None) for i, u in enumerate(uids)]
        spark.createDataFrame(rows, schema).write.parquet(f"file://{tmp_path}/{name}")
        stream = spark.readStream.schema(schema).parquet(f"file://{tmp_path}/{name}")
        got = ledger_stream(spark, stream, lambda b: b, store.path("seen"), f"file://{tmp_path}/checkpoint-{name}")
    assert sorted(r.uid for r in got.collect()) == ["a", "b", "c"]


def test_jobs_remove_their_own_tables_only(spark):
    rows = spark.range(3)
    outside = stage(rows, "outside")
    paths = []
    with staging(spark):
        mine = stage(rows, "mine")
        paths += mine.inputFiles()
        with staging(spark):
            paths += stage(rows, "inner").inputFiles()
        assert mine.count() == 3
    assert outside.count() == 3
    with pytest.raises(ValueError):
        with staging(spark):
            paths += stage(rows, "lost").inputFiles()
            raise ValueError
    assert len(paths) >= 3 and not any(tables.path_exists(spark, f) for f in paths)


def test_a_failed_run_is_logged(spark, store):
    with pytest.raises(Exception):
        run_ingest(spark, store, spark.range(1), spark.range(1), datetime(2025, 1, 2), "r")
    assert [r.status for r in tables.read_appended(spark, store.path("runs_log"), schemas.RUNS_LOG).collect()] == ["error"]


def test_a_small_batch_shuffles_neither_ledger_nor_target(spark):
    big = spark.range(5000).selectExpr("cast(id as string) AS uid", "id AS v")
    few = spark.createDataFrame([("7", 1), ("x", 2)], "uid string, v long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        unseen = identity.unseen(few, big)
        assert [r.uid for r in unseen.collect()] == ["x"]
        assert "SortMergeJoin" not in unseen._jdf.queryExecution().executedPlan().toString()
        merged = merge.upsert(big, few, "uid")
        plan = merged._jdf.queryExecution().sparkPlan().toString()
        assert "LeftAnti, BuildRight" in plan and "LeftSemi, BuildRight" in plan
        assert merged.count() == 5001 and merged.where("uid = '7'").first().v == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
