"""Feeds as they come: other prefixes, repeated and mixed elements, and answers that are no feeds."""

from datetime import datetime

import pytest

from feedloom import schemas
from feedloom.functions.feed_xml import NotAFeed, read_feed
from feedloom.operators import feeds, identity
from feedloom.plans.ingest import run_ingest
from feedloom.sources import tables
from feedloom.sources.tables import Store

R, S = "http://www.w3.org/1999/02/22-rdf-syntax-ns#", "http://purl.org/rss/1.0/"
DC, PRISM, ATOM, MEDIA = "http://purl.org/dc/elements/1.1/", "http://prismstandard.org/namespaces/basic/2.0/", "http://www.w3.org/2005/Atom", "http://search.yahoo.com/mrss/"


def fields(content, *names):
    return [tuple(i[n] for n in names) for i in read_feed(content)[1]]


def test_prefixes_are_the_feeds_own_choice():
    feed = (f'<a:RDF xmlns:a="{R}" xmlns:r="{S}" xmlns:x="{DC}"><r:channel/><r:item a:about="u1"><r:title>One</r:title><r:link>http://l/1</r:link>'
            f'<x:date>2024</x:date><x:identifier>i</x:identifier><q:doi xmlns:q="{PRISM}">10.1/x</q:doi><q:publicationName xmlns:q="{PRISM}">J</q:publicationName></r:item></a:RDF>')
    assert read_feed(feed)[0] == "rss1"
    assert fields(feed, "title", "link", "about", "ident", "pub_date", "doi", "journal") == [("One", "http://l/1", "u1", "i", "2024", "10.1/x", "J")]


def test_a_prefix_means_what_it_is_declared_as():
    feed = f'<rss xmlns:dc="{MEDIA}" xmlns:m="{DC}"><channel><item><dc:title>wrong</dc:title><dc:date>wrong</dc:date><m:title>right</m:title></item></channel></rss>'
    assert fields(feed, "title", "pub_date") == [("right", None)]


def test_names_of_other_namespaces_do_not_count():
    feed = (f'<feed xmlns="{ATOM}" xmlns:media="{MEDIA}"><entry><media:title>wrong</media:title><media:group><title>wrong</title></media:group>'
            '<title>right</title><id>i</id><media:link href="wrong"/><link href="l"/></entry></feed>')
    assert fields(feed, "title", "link", "ident") == [("right", "l", "i")]
    assert read_feed(f'<RDF xmlns="{R}"><item><title>no item of RSS</title></item></RDF>') == ("rss1", [])


def test_the_first_of_repeated_elements_counts():
    feed = f'<rss xmlns:dc="{DC}"><channel><item><title>first</title><title>second</title><guid>g1</guid><guid>g2</guid></item></channel></rss>'
    assert fields(feed, "title", "ident") == [("first", "g1")]
    feed = f'<r:RDF xmlns:r="{R}" xmlns="{S}" xmlns:dc="{DC}"><item><dc:identifier>a</dc:identifier><dc:identifier>b</dc:identifier></item></r:RDF>'
    assert fields(feed, "ident") == [("a",)]


def test_text_ends_at_markup_and_escaped_markup_stays():
    feed = ('<rss><channel><item><title>a <i>b</i> c</title></item><item><title><b>x</b></title><pubDate> </pubDate></item>'
            '<item><title>a &lt;i&gt;b&lt;/i&gt;</title></item><item><title><![CDATA[c <d>]]></title></item></channel></rss>')
    assert fields(feed, "title") == [("a",), (None,), ("a <i>b</i>",), ("c <d>",)]


@pytest.mark.parametrize("content", [None, "", "   ", "plain text", "<html><body><p>busy<br></body></html>", "<rss><channel>", "<rss>&nbsp;</rss>", "<a/><b/>", "\x00"])
def test_what_is_not_xml_is_no_feed(content):
    with pytest.raises(NotAFeed):
        read_feed(content)


def test_other_documents_have_no_items():
    assert read_feed("<html/>") == ("other", [])
    assert read_feed('﻿<?xml version="1.0" encoding="ISO-8859-1"?><!-- x --><rss><channel><item><title>é</title></item></channel></rss>')[1][0]["title"] == "é"


def _polls(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.FEED_PAYLOADS)


def test_one_reading_gives_items_failures_and_state(spark, tmp_path):
    at = datetime(2024, 5, 1, 8)
    good = "<rss><channel><item><title>t</title><link>https://j.org/1</link><guid>g</guid></item></channel></rss>"
    polls = _polls(spark, ("a", 0, 200, "ea", "ma", good, at), ("b", 1, 200, "eb", "mb", "<html><p>down<br></html>", at), ("c", 2, 200, "ec", None, "down", at),
                   ("d", 3, 304, None, None, None, at), ("e", 4, 503, None, None, good, at), ("f", 5, None, None, None, None, at))
    read = feeds.read_feeds(polls)
    assert [(r.feed_url, r.pos, r.title) for r in feeds.items_of(read).collect()] == [("a", 0, "t")]
    assert feeds.poll_failures(feeds.polls_of(read)) == (2, 1)
    errors = {r.feed_url: r.error for r in feeds.broken_payloads(polls).collect()}
    assert set(errors) == {"b", "c"} and all(e.startswith("not well-formed") for e in errors.values())

    store = Store(f"file://{tmp_path}/store")
    old = spark.createDataFrame([(f, f"old {f}", "m", at.replace(day=1, hour=1)) for f in "abcd"], schemas.FEEDS)
    tables.write_snapshot(old, store.path("feeds"), schemas.FEEDS, "r0")
    page = spark.createDataFrame([("https://j.org/1", "text/html", "<title>x</title>", None)], schemas.PAGE_PAYLOADS)
    assert run_ingest(spark, store, polls, page, at, "r1") == {"inserted": 1, "failures": 3, "status": "partial_ok"}
    state = {r.feed_url: (r.etag, r.last_checked_at.hour) for r in tables.read_snapshot(spark, store.path("feeds"), schemas.FEEDS).collect()}
    assert state == {"a": ("ea", 8), "b": ("old b", 1), "c": ("old c", 1), "d": ("old d", 8)}


def test_the_last_poll_of_a_feed_wins(spark):
    first, last = datetime(2024, 5, 1), datetime(2024, 5, 2)
    feed = "<rss><channel><item><title>{}</title><guid>g</guid></item></channel></rss>"
    polls = _polls(spark, ("a", 0, 200, None, None, feed.format("new"), last), ("a", 0, 200, None, None, feed.format("old"), first))
    items = feeds.feed_items(polls).withColumn("uid", identity.item_uid())
    assert [r.title for r in identity.dedupe_items(items).collect()] == ["new"]


def test_items_are_cut_into_batches(spark, monkeypatch):
    monkeypatch.setattr(feeds, "_ROWS_PER_BATCH", 7)
    items = "".join(f"<item><title>{k}</title></item>" for k in range(40))
    polls = _polls(spark, *((f"f{k}", k, 200, None, None, f"<rss><channel>{items}</channel></rss>", None) for k in range(3)))
    got = feeds.items_of(feeds.read_feeds(polls.coalesce(1)), 30).collect()
    assert sorted((r.feed_url, r.pos, r.title) for r in got) == [(f"f{k}", i, str(i)) for k in range(3) for i in range(30)]
