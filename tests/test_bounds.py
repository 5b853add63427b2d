"""Work that stays bounded: pages of very many tags, slices of very many rows; jobs that fail say so."""

import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.functions.topics import decode_tags, has_topic
from feedloom.operators import pages
from feedloom.operators.ranking import rank_within
from feedloom.plans import jobs
from feedloom.sources import tables
from feedloom.sources.tables import Store


def records(spark, *htmls):
    df = spark.createDataFrame([(k, "https://j.org/a", h) for k, h in enumerate(htmls)], "k int, url string, html string")
    return sorted(pages.extract_records(df).collect(), key=lambda r: r.k)


def test_a_page_of_many_tags_costs_linear_time(spark):
    start = '<meta name="citation_title" content="first"><meta property="og:description" content="about">'
    tags = lambda n: start + "".join(f'<meta name="description" content="d{k}"><meta name="citation_author" content="a{k}">' for k in range(n))
    records(spark, tags(10))
    took = []
    for n in (5_000, 25_000):
        begun = time.perf_counter()
        row = records(spark, tags(n))[0]
        took.append(time.perf_counter() - begun)
        assert (row.title, row.abstract) == ("first", "d0")
    assert took[1] < 12 * took[0] + 2


def test_blank_descriptions_do_not_hide_the_block(spark):
    block = '<div id="abstract"><p>' + "The text of the abstract, long enough to count. " * 2 + "</p></div>"
    blank = ['<meta name="description" content=" ">', '<meta name="description" content="&nbsp; &#160;">',
             '<script type="application/ld+json">{"@type": "Article", "abstract": "  "}</script>', '<meta name="dc.description" content="real">']
    found = [r.abstract or "" for r in records(spark, *(b + block for b in blank))]
    assert all(a.startswith("The text of the abstract") for a in found[:3]) and found[3] == "real"


def test_slices_are_cut_by_their_rows(spark):
    df = spark.range(4_000).select((F.col("id") % 2).alias("g"), ((F.col("id") * 7919) % 4_001).alias("v"))
    got = rank_within(df, ["g"], [F.asc("v")], "n", slices=2, slice_rows=150)
    rows = got.collect()
    for g in (0, 1):
        assert [r.n for r in sorted((r for r in rows if r.g == g), key=lambda r: r.v)] == list(range(1, 2_001))
    same = spark.range(500).select(F.lit(1).alias("g"), F.lit(1).alias("v"))
    assert sorted(r.n for r in rank_within(same, ["g"], [F.asc("v")], "n", slices=2, slice_rows=100).collect()) == list(range(1, 501))


def test_failed_jobs_leave_a_row(spark, tmp_path):
    store, at = Store(f"file://{tmp_path}/store"), datetime(2024, 5, 1)
    row = spark.createDataFrame([("a", at)], "uid string, fetched_at timestamp_ntz")
    tables.write_articles(row, store.path("articles"))
    fail = lambda work: 1 / 0
    no_pages = spark.createDataFrame([], schemas.PAGE_PAYLOADS)
    with pytest.raises(ZeroDivisionError):
        jobs.run_backfill(spark, store, no_pages, at, "b1", translate=fail)
    log = lambda: [(r.run_id, r.script_name, r.status) for r in tables.read_appended(spark, store.path("runs_log"), schemas.RUNS_LOG).collect()]
    assert log() == [("b1", "backfill", "error")]
    jobs.run_backfill(spark, store, no_pages, at, "b1")
    assert log() == [("b1", "backfill", "ok")]


def test_topic_filters_reach_the_scan(spark, tmp_path):
    tags = ["人工智能", '["人工智能", "生命科学"]', '["\\u4eba\\u5de5\\u667a\\u80fd"]', '["其他"]', '["人工智能x"]', '["人工智能"', "", None, "x人工智能"]
    path = f"file://{tmp_path}/articles"
    spark.createDataFrame([(k, t) for k, t in enumerate(tags)], "k int, topic_tag string").write.parquet(path)
    rows = spark.read.parquet(path)
    for topics in (["人工智能"], ["其他", "生命科学"], ["x"], ['["人工智能"']):
        kept = rows.filter(has_topic("topic_tag", topics))
        parsed = rows.filter(F.arrays_overlap(decode_tags("topic_tag"), F.array(*map(F.lit, topics))))
        assert sorted(r.k for r in kept.collect()) == sorted(r.k for r in parsed.collect())
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert f"StringContains(topic_tag,{topics[0]})" in plan.split("PushedFilters:")[1]
    assert sorted(r.k for r in rows.filter(has_topic("topic_tag", ["人工智能"])).collect()) == [0, 1, 2]
