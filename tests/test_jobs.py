"""Whole jobs on small stores: ingestion, streaming, backfill, text outputs."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.plans import backfill, reports
from feedloom.operators.identity import bounded_dedupe, doi_requests
from feedloom.plans import jobs
from feedloom.plans.ingest import LAST_UPDATE_KEY, run_ingest
from feedloom.sources import landing, tables, text_sinks
from feedloom.sources.tables import Store
from feedloom.streaming.jobs import ingest_stream

DAY1, DAY2 = datetime(2024, 5, 1, 8), datetime(2024, 5, 2, 8)


def rss(*numbers):
    items = "".join(
        f"<item><title>Item {n} on dna</title><link>https://j.org/{n}?utm_source=rss</link><guid>g{n}</guid><pubDate>2024-04-0{n}</pubDate></item>"
        for n in numbers
    )
    return f'<rss version="2.0"><channel>{items}</channel></rss>'


def payloads(spark, at, *feeds):
    rows = [(f"https://feeds.org/{i}", i, 200 if c else 304, f"e{at.day}" if c else None, None, c, at) for i, c in enumerate(feeds)]
    return spark.createDataFrame(rows, schemas.FEED_PAYLOADS)


def page_table(spark, *numbers, error=()):
    rows = []
    for n in numbers:
        html = f'<meta name="citation_title" content="Page {n}"><meta name="citation_journal_title" content="J"><meta name="description" content="about llm">'
        rows.append((f"https://j.org/{n}", "text/html", None if n in error else html, "HTTP 500" if n in error else None))
    rows.append(("https://j.org/9", "application/pdf", "x", None))
    return spark.createDataFrame(rows, schemas.PAGE_PAYLOADS)


def contents(df, *columns):
    return sorted((tuple(map(str, r)) for r in df.select(*columns).collect()))


@pytest.fixture
def store(tmp_path):
    return Store(f"file://{tmp_path}/store")


def snapshot(spark, store):
    read = lambda t, s: tables.read_snapshot(spark, store.path(t), s)
    return {
        "articles": contents(tables.read_articles(spark, store.path("articles")), *schemas.ARTICLES.names),
        "seen": contents(tables.read_appended(spark, store.path("seen"), schemas.SEEN), *schemas.SEEN.names),
        "pending": contents(read("pending", schemas.PENDING), *schemas.PENDING.names),
        "feeds": contents(read("feeds", schemas.FEEDS), *schemas.FEEDS.names),
        "meta": contents(read("meta", schemas.META), *schemas.META.names),
        "runs_log": contents(tables.read_appended(spark, store.path("runs_log"), schemas.RUNS_LOG), *schemas.RUNS_LOG.names),
    }


def test_ingest_runs(spark, store):
    first = payloads(spark, DAY1, rss(1, 2, 3, 9), rss(3, 4), rss(1)[:30])
    pages = page_table(spark, 1, 3, 4, error=(4,))
    result = run_ingest(spark, store, first, pages, DAY1, "r1")
    assert result == {"inserted": 2, "failures": 4, "status": "partial_ok"}
    after = snapshot(spark, store)
    assert [(a[0], a[1], a[3], a[14]) for a in after["articles"]] == [
        ("id:g1", "https://feeds.org/0", "Page 1", '["人工智能"]'), ("id:g3", "https://feeds.org/0", "Page 3", '["人工智能"]')]
    assert [s[0] for s in after["seen"]] == ["id:g1", "id:g3"]
    assert [(p[0], p[5], p[6]) for p in after["pending"]] == [
        ("id:g2", "1", "page not landed"), ("id:g4", "1", "HTTP 500"), ("id:g9", "1", "Non-HTML content-type: application/pdf")]
    assert after["meta"] == [(LAST_UPDATE_KEY, "2024-05-01T08:00:00")]

    # The same run again, as after a lost driver, leaves the same tables.
    assert run_ingest(spark, store, first, pages, DAY1, "r1") == result
    assert snapshot(spark, store) == after

    # A later run: one feed unchanged, item 4 is readable now, item 2 still is not, item 5 is new.
    second = payloads(spark, DAY2, None, rss(4, 5, 1), rss(2))
    result = run_ingest(spark, store, second, page_table(spark, 1, 4, 5), DAY2, "r2")
    assert result == {"inserted": 2, "failures": 1, "status": "partial_ok"}
    later = snapshot(spark, store)
    assert [a[0] for a in later["articles"]] == ["id:g1", "id:g3", "id:g4", "id:g5"]
    assert [(p[0], p[5]) for p in later["pending"]] == [("id:g2", "2"), ("id:g9", "1")]
    assert {f[0]: f[1] for f in later["feeds"]} == {"https://feeds.org/0": "e1", "https://feeds.org/1": "e2", "https://feeds.org/2": "e2"}
    assert [r[4:7:2] for r in later["runs_log"]] == [("partial_ok", "2"), ("partial_ok", "2")]


def test_merge_rewrites_only_touched_days(spark, store):
    path = store.path("articles")
    base = spark.createDataFrame([(f"u{i}", "f", f"t{i}", datetime(2024, 1, 1 + i % 3)) for i in range(9)], "uid string, feed_url string, title_en string, fetched_at timestamp_ntz")
    tables.merge_articles(spark, path, base)
    files = lambda: {f for f in tables.read_articles(spark, path).inputFiles()}
    before = files()
    tables.merge_articles(spark, path, spark.createDataFrame([("u4", "g", "new", datetime(2024, 2, 1))], base.schema))
    rows = {r.uid: r for r in tables.read_articles(spark, path).collect()}
    assert len(rows) == 9 and (rows["u4"].title_en, rows["u4"].feed_url, rows["u4"].fetched_at) == ("new", "f", datetime(2024, 1, 2))
    kept = before & files()
    assert {f for f in kept if "2024-01-02" in f} == set()
    assert {f.split("fetched_date=")[1][:10] for f in kept} == {"2024-01-01", "2024-01-03"}


def test_newest_days(spark, store):
    path = store.path("articles")
    rows = [(f"u{i}", "f", datetime(2024, 1, 1 + i % 4) if i else None) for i in range(12)]
    tables.write_articles(spark.createDataFrame(rows, "uid string, feed_url string, fetched_at timestamp_ntz"), path)
    table = tables.read_articles(spark, path)
    assert tables.newest_days(table, 4) == date(2024, 1, 3) and tables.newest_days(table, 3) == date(2024, 1, 4)
    assert tables.newest_days(table, 12) is None
    pruned = tables.read_articles(spark, path, first=date(2024, 1, 3))
    assert {r.uid for r in reports.latest(pruned, limit=4).collect()} == {r.uid for r in reports.latest(table, limit=4).collect()}
    assert "PartitionFilters: [isnotnull(fetched_date" in pruned._jdf.queryExecution().executedPlan().toString()


def test_stream_equals_batch(spark, store, tmp_path):
    pages = page_table(spark, 1, 2, 3, 4)
    landed = f"file://{tmp_path}/landed"
    batches = [payloads(spark, DAY1, rss(1, 2)), payloads(spark, DAY2, rss(2, 3, 4))]
    for i, b in enumerate(batches):
        b.coalesce(1).write.parquet(f"{landed}/{i}")
    stream = lambda: landing.feed_payload_stream(spark, f"{landed}/*", max_files=1)
    args = (lambda: pages, store, f"file://{tmp_path}/checkpoint")
    ingest_stream(spark, stream(), *args)
    got = snapshot(spark, store)
    assert [s[0] for s in got["seen"]] == ["id:g1", "id:g2", "id:g3", "id:g4"]
    batch_store = Store(f"file://{tmp_path}/batch")
    for i, b in enumerate(batches):
        run_ingest(spark, batch_store, b, pages, [DAY1, DAY2][i], f"r{i}")
    strip_times = lambda s: [a[:12] + a[14:] for a in s["articles"]]
    assert strip_times(got) == strip_times(snapshot(spark, batch_store))
    # Nothing new has landed: a second start does nothing.
    ingest_stream(spark, stream(), *args)
    assert snapshot(spark, store) == got


def _articles(spark):
    rows = [
        ("a", "f", None, "On dna", None, None, "2024", "10.1/a", "https://j.org/a", None, None, None, DAY1, DAY1, None),
        ("b", "f", "J", "B", "乙", "Article", "2024-01-01", "10.1/b", None, "x" * 90, "摘", None, DAY1, DAY1, "其他"),
        ("c", "f", "J", "C", "丙", "Article", "2024-01-01", "10.1/c", "https://j.org/c", "x" * 90, "摘", None, DAY2, DAY2, '["其他"]'),
    ]
    return spark.createDataFrame(rows, schemas.ARTICLES)


def test_backfill_job(spark):
    articles = _articles(spark)
    html = ('<meta name="citation_article_type" content="Review"><meta name="citation_journal_title" content="J">'
            '<meta name="citation_publication_date" content="2024-01-02"><meta name="description" content=" about llm ">')
    landed = [("https://j.org/a", "text/html", html, None), ("https://j.org/a", None, None, "HTTP 500"), ("https://j.org/c", None, None, "HTTP 404")]
    records = spark.createDataFrame(landed, schemas.PAGE_PAYLOADS)
    candidates = backfill.range_candidates(articles)
    sources = backfill.prepare_backfill(candidates, backfill.page_probes(candidates, records))
    work = {r.text: r.src_hash for r in backfill.translation_work(sources).collect()}
    assert set(work) == {"On dna", "about llm"}
    answers = spark.createDataFrame([(work["On dna"], "关于DNA"), (work["about llm"], "")], "src_hash string, text string")
    plan = backfill.plan_backfill(sources, answers)
    assert {tuple(r) for r in backfill.no_improve(plan).collect()} == {
        ("b", "(missing)", "", None), ("c", "https://j.org/c", "abstract_en", "fetch/extract failed: HTTP 404")}
    changes = {r.uid: r.changes for r in backfill.change_summary(plan).collect()}
    assert changes == {"a": "title_cn: (NULL) → 关于DNA; topic_tag: (NULL) → 生命科学; type: (NULL) → Review; journal: (NULL) → J; "
                            "pub_date: 2024 → 2024-01-02; abstract_en: (NULL) → about llm"}
    assert tuple(backfill.plan_counts(plan).first()) == (3, 1, 1, 1, 2, 1)
    now = datetime(2024, 6, 1)
    done = {r.uid: r for r in backfill.apply_plan(articles, plan, now).collect()}
    assert (done["a"].title_cn, done["a"].abstract_en, done["a"].last_updated_at, done["a"].fetched_at) == ("关于DNA", "about llm", now, DAY1)
    assert done["b"].last_updated_at == DAY1
    assert contents(backfill.apply_plan(articles, plan, now, dry_run=True), "*") == contents(articles, "*")
    nobody = spark.createDataFrame([], "uid string")
    assert contents(backfill.apply_plan(articles, plan, now, nobody), "*") == contents(articles, "*")
    doi_plan = backfill.plan_backfill(backfill.prepare_backfill(candidates, backfill.page_probes(candidates, records), doi_mode=True), doi_mode=True, compat=True)
    assert {r.uid: r.new_topic_tag for r in doi_plan.collect()} == {"a": "生命科学", "b": "其他", "c": "其他"}


def test_apply_writes_touched_days(spark, store):
    path = store.path("articles")
    tables.write_articles(_articles(spark), path)
    table = tables.read_articles(spark, path)
    sources = backfill.prepare_backfill(backfill.range_candidates(table), spark.createDataFrame([], "uid string, type string, journal string, date_published string, abstract_en string, content_type string, error string"))
    plan = backfill.plan_backfill(sources)
    days = tables.touched_days(table, backfill.approved_changes(plan))
    assert days == [date(2024, 5, 1)]
    tables.write_articles(backfill.apply_plan(table.filter(F.col(tables.DAY).isin(*days)).drop(tables.DAY), plan, DAY2), path)
    assert {r.uid: r.topic_tag for r in tables.read_articles(spark, path).collect()} == {"a": "生命科学", "b": "其他", "c": '["其他"]'}


def test_range_includes_the_end_day(spark):
    assert [r.uid for r in backfill.range_candidates(_articles(spark), date(2024, 5, 1), date(2024, 5, 1)).collect()] == ["a", "b"]
    assert [r.uid for r in backfill.range_candidates(_articles(spark), None, None, 2).collect()] == ["a", "b"]


def test_text_outputs(spark, tmp_path):
    items = reports.digest_items(_articles(spark), DAY2, since_days=3)
    lines = reports.digest_lines(items)
    text_sinks.write_digest(lines, f"file://{tmp_path}/digest")
    text = "".join(f.read_text() for f in sorted((tmp_path / "digest").glob("part-*")))
    assert text.startswith("# 今日导读（主题：ALL） — 涵盖时间：2024-01-01 ~ 2024-01-01\n\nlocal导读：共收录 2 篇；期刊覆盖：J×2。")
    assert "- J\n  - 1. C 丙\n  - 2. B 乙\n" in text and "**DOI：**10.1/c\n" in text
    rows = reports.listing(reports.latest(_articles(spark), limit=2))
    text_sinks.write_listing(rows, f"file://{tmp_path}/list", DAY2)
    text = "".join(f.read_text() for f in sorted((tmp_path / "list").glob("part-*")))
    assert text.startswith("# 最新条目（2024-05-02T08:00:00） 主题: ALL\n1. [[\"其他\"]] J | 2024-01-01 | C\n   DOI: 10.1/c\n   URL: https://j.org/c\n")
    text_sinks.write_digest_by_journal(reports.digest_lines(items, bounded=False), f"file://{tmp_path}/split")
    assert {p.name for p in (tmp_path / "split").glob("journal=*")} == {"journal=J"}


def test_doi_file(spark, tmp_path):
    (tmp_path / "dois.txt").write_text("# x\n10.1/A\n\nhttps://doi.org/10.1/b,c\n")
    got = doi_requests(lines=landing.doi_lines(spark, f"file://{tmp_path}/dois.txt"))
    assert {r.doi_key for r in got.collect()} == {"10.1/a", "10.1/b,c"}


def test_report_and_backfill_jobs(spark, store, tmp_path):
    tables.write_articles(_articles(spark), store.path("articles"))
    assert jobs.run_digest(spark, store, f"file://{tmp_path}/d", DAY2, "d1", ["其他"]) == 2
    assert jobs.run_latest(spark, store, f"file://{tmp_path}/l", DAY2, "l1", limit=2) == 2
    html = '<meta name="citation_journal_title" content="New J"><meta name="description" content="about a virus">'
    pages = spark.createDataFrame([("https://j.org/a", "text/html", html, None), ("https://j.org/c", "text/html", html, None)], schemas.PAGE_PAYLOADS)
    preview = jobs.run_backfill(spark, store, pages, DAY2, "b0", dry_run=True)
    assert (preview["to_apply"], preview["applied"]) == (2, 0)
    translate = lambda work: work.select("src_hash", F.concat(F.lit("译:"), "text").alias("text"))
    approve = lambda summary: summary.filter("uid <> 'c'")
    done = jobs.run_backfill(spark, store, pages, DAY2, "b1", translate=translate, approve=approve)
    assert (done["rows"], done["applied"], done["skipped"]) == (3, 1, 1)
    rows = {r.uid: r for r in tables.read_articles(spark, store.path("articles")).collect()}
    assert (rows["a"].title_cn, rows["a"].journal, rows["a"].abstract_en, rows["c"].journal) == ("译:On dna", "New J", "about a virus", "J")
    dois = doi_requests(spark.createDataFrame([(0, "10.1/C,10.9/none")], "ord long, value string"))
    done = jobs.run_backfill(spark, store, pages, DAY2, "b2", dois=dois, translate=translate)
    assert (done["rows"], done["applied"]) == (1, 1)
    row = tables.read_articles(spark, store.path("articles")).filter("uid = 'c'").first()
    assert (row.title_cn, row.journal) == ("译:C", "New J")
    log = {r.run_id: r.rows_processed for r in tables.read_appended(spark, store.path("runs_log"), schemas.RUNS_LOG).collect()}
    assert log == {"d1": 2, "l1": 2, "b0": 0, "b1": 1, "b2": 1}


def test_bounded_stream_dedupe(spark, tmp_path):
    rows = spark.createDataFrame([("a", DAY1), ("a", DAY1), ("b", DAY1)], "uid string, at timestamp_ntz").withColumn("at", F.col("at").cast("timestamp"))
    rows.write.parquet(f"file://{tmp_path}/in")
    stream = bounded_dedupe(spark.readStream.schema(rows.schema).parquet(f"file://{tmp_path}/in"), "at", "1 hour")
    query = stream.writeStream.format("memory").queryName("deduped").option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.uid for r in spark.table("deduped").collect()) == ["a", "b"]
