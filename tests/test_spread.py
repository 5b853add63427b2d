"""Rows of joins and batches that must not gather in one task or one Python worker."""

import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.functions import markup
from feedloom.operators import feeds
from feedloom.operators.skew import salted_join
from feedloom.plans import backfill


@pytest.fixture
def shuffled(spark):
    """Joins shuffle, and partitions stay as they are dealt."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("heavy", [[], ["k1"]])
def test_null_keys_spread_over_all_tasks(shuffled, heavy):
    left = shuffled.range(4_000).select(
        F.col("id").cast("string").alias("uid"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("k"), (F.col("id") % 2).cast("string"))).alias("key")
    )
    right = shuffled.createDataFrame([("k1", "one")], "key string, text string")
    joined = salted_join(left, right, "key", "left", "uid", heavy)
    assert joined.filter("text = 'one'").count() == left.filter("key = 'k1'").count() and joined.count() == 4_000
    tasks = joined.filter("key IS NULL").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == 16 and max(r["count"] for r in tasks) < 400
    kept = {how: salted_join(left, right, "key", how, "uid", heavy).count() for how in ("inner", "left_semi", "left_anti")}
    assert kept == {"inner": 667, "left_semi": 667, "left_anti": 3_333}


def test_staged_plans_hold_a_text_once(spark, tmp_path, monkeypatch):
    """What is written down of a backfill has no second copy of an abstract; the texts to translate come out all the same."""
    written = []
    real = backfill.stage
    monkeypatch.setattr(backfill, "stage", lambda df, label: written.append(df.columns) or real(df, label))
    rows = [("a", " t ", "", "x" * 50, None), ("b", "  ", None, None, "new " + "y" * 90), ("c", "t", "C", "z" * 50, None), ("d", "t", None, " ", None)]
    articles = spark.createDataFrame([(u, f"u{u}", t, c, a) for u, t, c, a, _ in rows], "uid string, article_url string, title_en string, title_cn string, abstract_en string")
    candidates = schemas.conform(articles, schemas.ARTICLES).select(*backfill._CANDIDATE_COLUMNS)
    probes = spark.createDataFrame(
        [(u, None, None, None, new, "text/html", None) for u, *_, new in rows],
        "uid string, type string, journal string, date_published string, abstract_en string, content_type string, error string",
    )
    for force in (False, True):
        sources = backfill.prepare_backfill(candidates, probes, doi_mode=force)
        answers = backfill.translation_work(sources).select("src_hash", F.concat(F.lit("zh "), "text").alias("text"))
        plan = {r.uid: r for r in backfill.plan_backfill(sources, answers, doi_mode=force).collect()}
        assert {u: r.title_src for u, r in plan.items()} == {"a": "t", "b": None, "c": "t" if force else None, "d": "t"}
        assert {u: r.abstract_src for u, r in plan.items()} == {"a": "x" * 50, "b": "new " + "y" * 90, "c": "z" * 50, "d": None}
        assert all(r.new_abstract_cn == (r.abstract_src and "zh " + r.abstract_src) and r.new_title_cn == (r.title_src and "zh " + r.title_src) for r in plan.values())
    assert len(written) == 4 and not any({"title_src", "abstract_src"} & set(columns) for columns in written)


def test_pages_become_python_objects_a_few_at_a_time():
    """What a worker holds of a batch does not grow with the batch."""
    def peak(pages: int) -> float:
        page = '<html><body><div class="article__teaser"><p>lead</p></div>' + "x" * 20_000 + "</body></html>"
        column = pa.array([page, None] * pages)
        tracemalloc.start()
        parts = markup.publisher_parts_udf.func(column)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert parts.to_pylist()[:2] == [dict.fromkeys(markup._PART_NAMES) | {"teaser": "lead"}, dict.fromkeys(markup._PART_NAMES)]
        return most

    peak(10)
    assert peak(800) < 1.5 * peak(100) + 100_000


def test_rows_of_feeds_leave_a_worker_in_small_batches(spark):
    item = "<item><title>t</title><description>" + "x" * 1_000 + "</description></item>"
    payload = '<rss version="2.0"><channel>' + item * 1_000 + "</channel></rss>"
    read = spark.createDataFrame([("f", 0, 200, payload)], "feed_url string, feed_ord int, status int, content string").repartition(1)
    sizes = feeds.read_feeds(read).select("pos", "title").mapInArrow(lambda bs: (b for b in bs), "pos int, title string")
    assert sizes.count() == 1_001 and sizes.filter("title = 't'").count() == 1_000
    assert feeds._ROWS_PER_BATCH * len(item) < 1 << 20
