"""What several writers leave, folders of many runs, and items tried again."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators.identity import unseen
from feedloom.operators.retries import RetryPolicy, due_retries
from feedloom.plans.ingest import run_ingest
from feedloom.sources import tables
from feedloom.sources.tables import Store, VersionConflict

AT = datetime(2025, 1, 2)


@pytest.fixture
def store(tmp_path):
    return Store(f"file://{tmp_path}/store")


def article(spark, *rows):
    df = spark.createDataFrame([(u, t, at) for u, t, at in rows], "uid string, title_en string, fetched_at timestamp_ntz")
    return schemas.conform(df, schemas.ARTICLES)


def held(spark, path):
    return sorted((r.uid, r.title_en) for r in tables.read_articles(spark, path).collect())


def test_a_write_on_an_old_version_is_refused(spark, store):
    path = store.path("articles")
    tables.merge_articles(spark, path, article(spark, ("a", "old", AT)))
    version = tables.current_version(spark, path)
    rows = tables.read_articles(spark, path, version=version).drop(tables.DAY).unionByName(article(spark, ("c", "new", AT)))
    tables.merge_articles(spark, path, article(spark, ("b", "between", AT)))
    with pytest.raises(VersionConflict):
        tables.write_articles(rows, path, version)
    assert held(spark, path) == [("a", "old"), ("b", "between")]
    import os
    kept = [d for d in os.listdir(path.removeprefix("file://")) if d.startswith("version=")]
    assert len(kept) == 2  # the refused one left no folder


def test_merges_at_once_lose_nothing(spark, store, monkeypatch):
    path = store.path("articles")
    tables.merge_articles(spark, path, article(spark, ("a", "old", AT), ("x", "other day", datetime(2025, 1, 1))))
    real, calls = tables._publish, []

    def publish(*args):
        calls.append(args[2])
        if len(calls) == 1:  # another run comes first, with the same new uid among others
            tables.merge_articles(spark, path, article(spark, ("b", "theirs", datetime(2025, 1, 5)), ("d", "theirs", AT)))
        real(*args)

    monkeypatch.setattr(tables, "_publish", publish)
    tables.merge_articles(spark, path, article(spark, ("a", "new", AT), ("b", "ours", AT)))
    assert held(spark, path) == [("a", "new"), ("b", "ours"), ("d", "theirs"), ("x", "other day")]
    assert {r.uid: r[tables.DAY] for r in tables.read_articles(spark, path).collect()}["b"] == date(2025, 1, 5)
    assert calls == [2, 2, 3]


def test_a_merge_gives_up_in_the_end(spark, store, monkeypatch):
    path = store.path("articles")

    def refuse(*args):
        raise VersionConflict("taken")

    monkeypatch.setattr(tables, "_publish", refuse)
    with pytest.raises(VersionConflict):
        tables.merge_articles(spark, path, article(spark, ("a", "x", AT)))


def test_days_are_pruned_by_folder_names(spark, store):
    path = store.path("articles")
    tables.merge_articles(spark, path, article(spark, *((f"u{d}", "t", datetime(2025, 1, d)) for d in range(1, 6)), ("n", "no day", None)))
    version = tables.current_version(spark, path)
    assert len(version.folders) == 6 and len(version.on(date(2025, 1, 4), None)) == 2 and len(version.on(None, date(2025, 1, 1))) == 1
    assert len(tables.read_articles(spark, path, date(2025, 1, 2), date(2025, 1, 3)).inputFiles()) == 2
    assert tables.read_articles(spark, path, date(2026, 1, 1)).count() == 0


def test_many_runs_leave_few_folders(spark, store, tmp_path):
    path, ledger = store.path("seen"), {}
    row = lambda u: schemas.conform(spark.createDataFrame([(u,)], "uid string"), schemas.SEEN).coalesce(1)
    for k in range(40):
        tables.append_run(row(f"u{k}"), path, schemas.SEEN, f"r:{k}")
        ledger[f"u{k}"] = f"r:{k}"
        tables.merge_runs(spark, path, schemas.SEEN, keep=3, least=4)
        got = tables.read_appended(spark, path, schemas.SEEN)
        if k % 7 == 0:
            assert {r.uid: r[tables.RUN] for r in got.collect()} == ledger
        folders = [p.name for p in (tmp_path / "store" / "seen").iterdir() if p.name.startswith("run=")]
        assert len(folders) <= 3 + 4 + 1 + 3 + 4 + 1
    tables.append_run(row("again").where("1 = 0"), path, schemas.SEEN, "r:39")  # a run that can be repeated
    del ledger["u39"]
    rows = tables.read_appended(spark, path, schemas.SEEN).collect()
    assert {r.uid: r[tables.RUN] for r in rows} == ledger and len(rows) == len(ledger)


def test_a_small_batch_opens_the_buckets_of_its_uids(spark, store):
    path = store.path("seen")
    for k in range(3):
        uids = spark.range(400).select(F.concat(F.lit(f"u{k}-"), "id").alias("uid"))
        tables.append_run(schemas.conform(uids, schemas.SEEN), path, schemas.SEEN, f"r{k}")
    assert tables.merge_runs(spark, path, schemas.SEEN, keep=1, least=1, key="uid")
    tables.append_run(schemas.conform(spark.createDataFrame([("late",)], "uid string"), schemas.SEEN), path, schemas.SEEN, "r3")
    batch = spark.createDataFrame([("u0-7", 0), ("u1-399", 1), ("u2-3", 2), ("late", 3), ("new", 4), (None, 5)], "uid string, pos int")
    ledger = tables.read_ledger(spark, path, schemas.SEEN, batch)
    whole = tables.read_appended(spark, path, schemas.SEEN)
    assert "PartitionFilters: [bucket" in ledger._jdf.queryExecution().executedPlan().toString()
    opened = lambda df: {f for f in df.inputFiles() if "bucket=" in f}
    wanted = {r[0] for r in batch.select(tables.bucket_of("uid")).distinct().collect()}
    # ``inputFiles`` names all files of a relation; what is scanned is what holds rows of the buckets.
    assert ledger.filter("run <> 'r3' AND run <> 'r2'").select(tables.bucket_of("uid").alias("b")).distinct().count() <= len(wanted) < len(opened(whole))
    assert {r.uid for r in unseen(batch, ledger).collect()} == {r.uid for r in unseen(batch, whole).collect()} == {"new", None}
    assert whole.count() == 1_201 and whole.groupBy("run").count().count() == 4
    assert tables.merge_runs(spark, path, schemas.SEEN, keep=1, least=1, key="uid") and tables.read_appended(spark, path, schemas.SEEN).count() == 1_201


def test_a_merge_lost_before_publishing_and_one_at_once(spark, store, monkeypatch):
    path = store.path("seen")
    for k in range(4):
        tables.append_run(schemas.conform(spark.createDataFrame([(f"u{k}",)], "uid string"), schemas.SEEN), path, schemas.SEEN, f"r{k}")
    real = tables._publish_lines
    with monkeypatch.context() as m:
        m.setattr(tables, "_publish_lines", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            tables.merge_runs(spark, path, schemas.SEEN, 1, 1)
    assert tables.read_appended(spark, path, schemas.SEEN).count() == 4

    def second(*args):
        monkeypatch.setattr(tables, "_publish_lines", real)
        assert tables.merge_runs(spark, path, schemas.SEEN, 1, 1)
        real(*args)

    monkeypatch.setattr(tables, "_publish_lines", second)
    assert not tables.merge_runs(spark, path, schemas.SEEN, 1, 1)
    assert sorted(r.uid for r in tables.read_appended(spark, path, schemas.SEEN).collect()) == ["u0", "u1", "u2", "u3"]


def test_old_snapshots_go(spark, store):
    path = store.path("meta")
    for k in range(12):
        tables.write_snapshot(spark.createDataFrame([("k", str(k))], schemas.META), path, schemas.META, f"r{k}", keep=3)
    assert [n for n, _ in tables._snapshots(spark, path)] == [10, 11, 12]
    assert tables.read_snapshot(spark, path, schemas.META).first().value == "11"
    assert tables.read_snapshot(spark, path, schemas.META, before_run="r11").first().value == "10"


def test_waits_grow_and_end(spark):
    rows = [("a", 1, AT), ("b", 2, AT), ("c", 5, AT), ("d", 9, AT), ("e", 1, None)]
    pending = schemas.conform(spark.createDataFrame(rows, "uid string, fail_count long, last_attempt_at timestamp_ntz"), schemas.PENDING)
    policy = RetryPolicy(max_fail=8, first_wait=timedelta(hours=1), longest_wait=timedelta(hours=4))
    due = lambda hours: "".join(sorted(r.uid for r in due_retries(pending, AT + timedelta(hours=hours), policy).collect()))
    assert [due(h) for h in (0, 1, 2, 3.9, 4, 99)] == ["e", "ae", "abe", "abe", "abce", "abce"]


def _feed(spark, at, *items):
    xml = "".join(f"<item><title>t{i}</title><link>https://j.org/{i}</link><guid>g{i}</guid></item>" for i in items)
    row = ("f", 0, 200 if items else 304, None, None, f"<rss><channel>{xml}</channel></rss>" if items else None, at)
    return spark.createDataFrame([row], schemas.FEED_PAYLOADS)


def test_items_are_tried_again_without_their_feed(spark, store):
    pages = lambda *n: spark.createDataFrame([(f"https://j.org/{k}", "text/html", f'<meta name="citation_title" content="P{k}">', None) for k in n], schemas.PAGE_PAYLOADS)
    pending = lambda: {r.uid: (r.fail_count, r.first_seen_at) for r in tables.read_snapshot(spark, store.path("pending"), schemas.PENDING).collect()}
    policy, day = RetryPolicy(max_fail=2, first_wait=timedelta(hours=20)), timedelta(days=1)
    assert run_ingest(spark, store, _feed(spark, AT, 1, 2, 3), pages(1), AT, "r1", retries=policy) == {"inserted": 1, "failures": 2, "status": "partial_ok"}
    assert pending() == {"id:g2": (1, AT), "id:g3": (1, AT)}
    # The feed has not changed; one item is readable by now. A repeated run does the same.
    for _ in range(2):
        assert run_ingest(spark, store, _feed(spark, AT + day), pages(2), AT + day, "r2", retries=policy) == {"inserted": 1, "failures": 1, "status": "partial_ok"}
        assert pending() == {"id:g3": (2, AT)}
    stored = {r.uid: (r.title_en, r.feed_url) for r in tables.read_articles(spark, store.path("articles")).collect()}
    assert stored == {"id:g1": ("P1", "f"), "id:g2": ("P2", "f")}
    # Not due yet: nothing is tried. Served again: tried as a fresh item, once.
    assert run_ingest(spark, store, _feed(spark, AT + 1.5 * day), pages(), AT + 1.5 * day, "r3", retries=policy)["failures"] == 0
    assert run_ingest(spark, store, _feed(spark, AT + 4 * day, 3), pages(), AT + 4 * day, "r4", retries=policy)["failures"] == 1
    # Too many failures: it waits for its feed or a user.
    assert run_ingest(spark, store, _feed(spark, AT + 99 * day), pages(3), AT + 99 * day, "r5", retries=policy)["inserted"] == 0
    assert pending() == {"id:g3": (3, AT)}
    assert tables.read_appended(spark, store.path("seen"), schemas.SEEN).agg(F.count("uid")).first()[0] == 2
