"""Operators against hand-made cases and brute force, including skewed ones."""

import json
import random

import pytest
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.operators import feeds, identity, merge, pages, retries
from feedloom.operators.ranking import first_n, rank_within
from feedloom.operators.skew import heavy_keys, salted_join
from feedloom.plans import backfill, reports

ITEM = "feed_url string, feed_ord int, pos int, title string, link string, id_like string, pub_date string, doi string, journal string"


def test_canonical_json_matches_python(spark):
    row = ("f", 0, 0, 'q"\\\n\x07é', None, None, None, None, None)
    got = spark.createDataFrame([row], ITEM).select(identity.canonical_json()).first()[0]
    item = dict(title=row[3], link=None, id_like=None, pub_date=None, doi=None, journal=None)
    assert got == json.dumps(item, sort_keys=True, ensure_ascii=False)


def test_uid_precedence(spark):
    rows = [
        ("f", 0, 0, "t", "https://h/a?utm_x=1", "g", None, "https://doi.org/10.1/A", None),
        ("f", 0, 1, "t", "https://h/a", " raw ", None, "doi:", None),
        ("f", 0, 2, "t", "https://h/a?utm_x=1", None, None, None, None),
        ("f", 0, 3, "t", "https://h/a", "", None, None, None),
        ("f", 0, 4, "t", None, None, None, None, None),
    ]
    uids = [r[0] for r in spark.createDataFrame(rows, ITEM).orderBy("pos").select(identity.item_uid()).collect()]
    assert uids[0] == "doi:10.1/a" and uids[1] == "id: raw "
    assert uids[2] == uids[3] and uids[2].startswith("linkhash:") and len(uids[2]) == 9 + 24
    assert uids[4].startswith("hash:") and len(uids[4]) == 5 + 24


def test_dedupe_with_a_hot_uid(spark):
    items = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), (F.col("id") % 7).cast("string"))).alias("uid"),
        F.concat(F.lit("f"), (F.col("id") % 5).cast("string")).alias("feed_url"),
        (F.col("id") % 5).cast("int").alias("feed_ord"), F.col("id").cast("int").alias("pos"),
    )
    want = {}
    for r in items.collect():
        key = (-r["feed_ord"], r["pos"])
        if r["uid"] not in want or key > want[r["uid"]]:
            want[r["uid"]] = key
    got = {r["uid"]: (-r["feed_ord"], r["pos"]) for r in identity.dedupe_items(items.repartition(6)).collect()}
    assert got == want


def test_doi_requests_keep_first_spelling(spark):
    args = spark.createDataFrame([(0, "10.1/A, ,doi:10.1/b"), (1, "https://doi.org/10.1/a")], "ord long, value string")
    lines = spark.createDataFrame([(0, "# 10.1/x"), (1, " "), (2, "10.1/B/"), (3, "10.1/c")], "ord long, value string")
    got = {(r.doi_key, r.doi_raw) for r in identity.doi_requests(args, lines).collect()}
    assert got == {("10.1/a", "10.1/A"), ("10.1/b", "doi:10.1/b"), ("10.1/c", "10.1/c")}


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_join(spark, how):
    left = spark.range(2000).select(
        F.col("id").alias("uid"), F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    heavy = heavy_keys(left, "k", floor=500)
    assert heavy == [1]
    salted = salted_join(left, right, "k", how, "uid", heavy, salts=4)
    plain = left.join(right, "k", how)
    assert sorted(map(str, salted.select(sorted(salted.columns)).collect())) == sorted(map(str, plain.select(sorted(plain.columns)).collect()))


def test_rank_within_spans_slices(spark):
    """One group holds most rows and all its sort keys are equal but for the id."""
    rng = random.Random(5)
    rows = [("big" if i % 3 else rng.choice(["a", None]), 7 if i % 2 else rng.randrange(5), f"u{i:04d}") for i in range(900)]
    df = spark.createDataFrame(rows, "g string, t int, uid string")
    got = {r.uid: r.n for r in rank_within(df, ["g"], [F.desc("t"), F.asc("uid")], "n", slices=7).collect()}
    want, seen = {}, {}
    for g, t, uid in sorted(rows, key=lambda r: (str(r[0]), -r[1], r[2])):
        seen[g] = seen.get(g, 0) + 1
        want[uid] = seen[g]
    assert got == want
    whole = {r.uid: r.n for r in rank_within(df, [], [F.asc("uid")], "n", slices=5).collect()}
    assert whole == {f"u{i:04d}": i + 1 for i in range(900)}


def test_first_n_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("g"), F.col("id").alias("pos"))
    limited = first_n(df, ["g"], [F.asc("pos")], 3)
    assert sorted(r.pos for r in limited.collect()) == [0, 1, 2, 3, 4, 5]
    plan = limited._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert first_n(df, ["g"], [F.asc("pos")], 0).count() == 1000


def _payload(spark, *contents):
    rows = [(f"f{i}", i, 200 if c is not None else 304, None, None, c, None) for i, c in enumerate(contents)]
    return spark.createDataFrame(rows, schemas.FEED_PAYLOADS)


RSS1 = ('<?xml version="1.0"?><!DOCTYPE x><rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/"'
        ' xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:prism="http://prismstandard.org/namespaces/basic/2.0/"><channel/>'
        '<item rdf:about="about1"><title/><dc:title>DC &amp;eacute; title</dc:title><link> http://l/1 </link>'
        '<dc:identifier>doi:10.1234/id1.</dc:identifier></item><item><title>two</title><link>http://l/2</link></item></rdf:RDF>')
RSS2 = ('<rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><item><title>one</title><guid isPermaLink="false">g1</guid>'
        '<description><![CDATA[<p>see 10.1234/abc).</p>]]></description><dc:date>2025</dc:date></item>'
        '<item><title>two</title><link>http://l/10.5555/l2</link></item><item/></channel></rss>')
ATOM = ('<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>i1</id><title>A</title><link rel="self" href="s"/><link rel="alternate" href="alt"/>'
        '<updated>u</updated><published>p</published></entry><entry><title>B</title><link href="only"/><updated>u2</updated></entry></feed>')


def test_feed_dialects(spark):
    got = {(r.feed_url, r.pos): r for r in feeds.feed_items(_payload(spark, RSS1, RSS2, ATOM, None, "<html/>", RSS2[:200], ""), 0).collect()}
    assert set(got) == {("f0", 0), ("f0", 1), ("f1", 0), ("f1", 1), ("f1", 2), ("f2", 0), ("f2", 1)}
    first = got["f0", 0]
    assert (first.title, first.link, first.id_like, first.doi) == ("DC é title", "http://l/1", "about1", "10.1234/id1")
    assert (got["f0", 1].id_like, got["f0", 1].doi) == ("http://l/2", None)
    assert (got["f1", 0].id_like, got["f1", 0].doi, got["f1", 0].pub_date) == ("g1", "10.1234/abc", "2025")
    assert (got["f1", 1].id_like, got["f1", 1].doi) == ("http://l/10.5555/l2", "10.5555/l2")
    assert (got["f1", 2].title, got["f1", 2].id_like) == (None, None)
    assert (got["f2", 0].link, got["f2", 0].pub_date, got["f2", 0].id_like) == ("alt", "p", "i1")
    assert (got["f2", 1].link, got["f2", 1].id_like, got["f2", 1].pub_date) == ("only", "only", "u2")
    assert {r.feed_url for r in feeds.feed_items(_payload(spark, RSS2), 1).collect()} == {"f0"}
    broken = feeds.broken_payloads(_payload(spark, RSS1, None, RSS2[:200], "")).collect()
    assert sorted(r.feed_url for r in broken) == ["f2", "f3"]


def test_feed_state(spark):
    from datetime import datetime as dt

    old = spark.createDataFrame([("a", "e0", "m0", dt(2024, 1, 1)), ("b", "e1", "m1", dt(2024, 1, 1))], schemas.FEEDS)
    polls = spark.createDataFrame(
        [("a", 304, None, None, dt(2024, 1, 3)), ("c", 200, "n", "m", dt(2024, 1, 2)), ("c", 304, None, None, dt(2024, 1, 3)), ("b", 503, "x", None, dt(2024, 1, 3))],
        "feed_url string, status int, etag string, last_modified string, polled_at timestamp_ntz")
    got = {r.feed_url: (r.etag, r.last_modified, r.last_checked_at) for r in feeds.feed_state(old, polls).collect()}
    assert got == {"a": ("e0", "m0", dt(2024, 1, 3)), "b": ("e1", "m1", dt(2024, 1, 1)), "c": ("n", "m", dt(2024, 1, 3))}


def _record(spark, html, url="https://j.org/a", **kw):
    row = pages.extract_records(spark.createDataFrame([(url, html)], "url string, html string"), **kw).first()
    return row.asDict()


def test_page_priorities(spark):
    ld = '<script type="application/ld+json">{"@type":["Article"],"headline":"H","articleSection":["x"],"identifier":{"value":"10.1234/no"}}</script>'
    metas = "<meta name='citation_title' content='M'><META content=\"J &amp;amp; K\" name=citation_journal_title><meta name=\"citation_doi\" content=\"10.1/d\">"
    r = _record(spark, f"<head>{ld}{metas}</head>")
    assert (r["title"], r["journal"], r["doi"], r["type"]) == ("H", "J & K", "10.1/d", None)
    r = _record(spark, f"<head>{ld}{metas}</head>", compat=True)
    assert (r["title"], r["journal"], r["doi"]) == ("H", None, None)
    assert json.loads(r["raw_jsonld"])[0]["headline"] == "H"
    long = "word " * 20
    blocks = f'<div id="x-abstract">short</div><div class="big abstract"><b>A&amp;lt;</b> {long}<script>no</script></div>'
    assert _record(spark, blocks)["abstract"] == f"A< {long.strip()}"
    assert _record(spark, '<meta name="dc.description" content=""><meta name="description" content="D">' + blocks)["abstract"] == "D"
    assert _record(spark, f'<div id="Abs1">{long}</div><meta property="og:description" content="og">')["abstract"] == long.strip()
    assert _record(spark, '<meta property="og:description" content="og"><meta name="twitter:description" content="tw">')["abstract"] == "og"
    empty = _record(spark, "<p>nothing</p>")
    assert empty["raw_jsonld"] == "[]" and empty["article_url"] == "https://j.org/a" and empty["title"] is None


def test_publisher_page(spark):
    url = "https://www.nature.com/articles/x"
    html = ('<h1 class="c-article-title">T <i>x</i></h1><nav aria-label="Breadcrumb"><a>1</a><a> J </a></nav>'
            '<ul data-test="publication-history"><li>Received <time datetime="2020-01-01"></time></li>'
            '<li>Published online: <time datetime="2020-02-02T00:00"></time></li></ul><section id="Abs2"><p>abs &amp; more</p></section>')
    r = _record(spark, html, url)
    assert (r["title"], r["journal"], r["date_published"], r["abstract"], r["raw_jsonld"]) == ("T x", "J", "2020-02-02", "abs & more", None)
    letter = '<meta name="description" content="LETTER to the editor"><meta name="dc.identifier" content="doi:10.1234/L">' \
             '<div class="c-article-body main-content" data-test="main-content"><div><p>first</p></div><p>second</p></div>'
    r = _record(spark, letter, url)
    assert (r["abstract"], r["doi"]) == ("first", "10.1234/L")
    assert _record(spark, '<meta name="description" content="only this">', url)["raw_jsonld"] == "[]"


def test_jsonld_variants(spark):
    def doi(identifier):
        block = json.dumps({"@type": "Article", "identifier": identifier})
        return _record(spark, f'<script type="application/ld+json">{block}</script>')["doi"]

    assert doi("https://doi.org/10.1234/a.") == "10.1234/a."
    assert doi(["x", {"value": "doi:10.1234/b"}]) == "10.1234/b"
    assert doi([{"@id": "10.1234/c d"}]) == "10.1234/c"
    assert doi({"value": "10.1234/d"}) is None
    html = '<script type="application/ld+json">[{"@type":"Thing"},{"@type":["x","BlogPosting"]}, 3]</script>'
    objects = pages.ld_objects(pages.ld_blocks(F.col("h")))
    row = spark.createDataFrame([(html,)], "h string").select(objects.alias("o")).select(
        F.size("o").alias("n"), pages.pick_article(F.col("o")).isNull().alias("strict"), pages.pick_article(F.col("o"), True).isNotNull().alias("lenient")).first()
    assert (row.n, row.strict, row.lenient) == (2, True, True)


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([("a", "f1", "old", 1), ("b", "f1", "keep", 1)], "uid string, feed_url string, t string, fetched_at int")
    source = spark.createDataFrame([("a", "f2", None, 2), ("c", "f2", "new", 2)], "uid string, feed_url string, t string, fetched_at int")
    once = merge.upsert(target, source, "uid", ["feed_url", "fetched_at"])
    twice = merge.upsert(once, source, "uid", ["feed_url", "fetched_at"])
    want = {("a", "f1", None, 1), ("b", "f1", "keep", 1), ("c", "f2", "new", 2)}
    assert {tuple(r) for r in once.collect()} == want == {tuple(r) for r in twice.collect()}


def test_pending_matches_replay(spark):
    """Set-based bookkeeping equals replaying the attempts one by one."""
    from datetime import datetime, timedelta

    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    attempts = [(rng.choice(["hot"] * 5 + list("abcdefgh")), i, start + timedelta(seconds=i // 3), rng.random() < 0.3, f"e{i}" * 200) for i in range(300)]
    base = {"hot": (4, "old"), "zz": (2, "old")}
    state = {u: [n, e, start] for u, (n, e) in base.items()}
    for uid, _, at, ok, err in attempts:
        if ok:
            state.pop(uid, None)
        elif uid in state:
            state[uid][:2] = [state[uid][0] + 1, err[:500]]
        else:
            state[uid] = [1, err[:500], at]
    pending = spark.createDataFrame([(u, None, None, None, None, n, e, start, start) for u, (n, e) in base.items()], schemas.PENDING)
    df = spark.createDataFrame(attempts, "uid string, attempt_id long, attempted_at timestamp_ntz, ok boolean, error string").repartition(5)
    got = {r.uid: [r.fail_count, r.last_error, r.first_seen_at] for r in retries.update_pending(pending, df).collect()}
    assert got == state


def test_doi_candidates_match_brute_force(spark):
    urls = ["https://doi.org/10.1/ab", "HTTP://DX.DOI.ORG/10.1/AB/x", "https://x.org/?u=doi.org/doi.org/10.2/z", None, "https://doi.org/", "https://j.org/10.1/ab", "doi.org/10.1_x"]
    dois = [None, "10.1/AB", "10.3/q"]
    rows = [(f"u{i}{j}", u, d) for i, u in enumerate(urls) for j, d in enumerate(dois)]
    extra = [F.lit(None).cast("string").alias(c) for c in ("fetched_at",)]
    articles = spark.createDataFrame(rows, "uid string, article_url string, doi string").select("*", *extra)
    for keys in (["10.1/a", "10.3/q"], ["10.1/ab"], ["z", "10.2/z"], ["10.1%x"], []):
        wanted = spark.createDataFrame([(k,) for k in keys], "doi_key string")
        got = {r.uid for r in backfill.doi_candidates(articles, wanted).collect()}
        want = {uid for uid, u, d in rows if (d or "").lower() in keys or any(f"doi.org/{k}" in (u or "").lower() for k in keys)}
        assert got == want, keys


def test_empty_digest(spark):
    items = spark.createDataFrame([], schemas.ARTICLES).select(*reports._DIGEST_COLUMNS)
    row = reports.digest_summary(items).first()
    assert (row.n_items, row.date_range, row.sentence) == (0, reports.NO_DATES, reports.NO_ITEMS_SENTENCE)
    lines = [r.line for r in reports.digest_lines(items).orderBy(*reports.DIGEST_ORDER).collect()]
    assert lines[2:] == [reports.TOC_HEADING, reports.TOC_EMPTY, reports.BODY_HEADING]


def test_compat_date_range(spark):
    from datetime import datetime as dt

    rows = [("a", "f", "J", "t", None, None, d, None, None, None, None, None, dt(2024, 1, 1), None, None) for d in ("Spring 2024", "2024-03-01", None)]
    items = spark.createDataFrame(rows, schemas.ARTICLES)
    assert reports.digest_summary(items).first().date_range == "2024-03-01 ~ 2024-03-01"
    assert reports.digest_summary(items, compat=True).first().date_range == "2024-03-01 ~ Spring 2024"
