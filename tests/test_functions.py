"""Golden vectors of the scalar functions."""

import hashlib
import itertools
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedloom.functions import articles, dates, identifiers, text, topics


def apply(spark, expr, *rows, schema="a string"):
    """Results of ``expr`` over rows, in order."""
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


CASES = [
    (lambda: text.clean_text("a"), [
        ("a&amp;lt;b", "a&lt;b"), ("x  y", "x y"), (None, None), (" a\n\tb ", "a b"), ("R&D & co", "R&D & co"),
        ("&eacute;t&#233; &copy", "été ©"), ("&amp;amp;", "&amp;"), ("", ""), ("\x1cx　y\x85", "x y"),
    ]),
    (lambda: text.clean_text("a", decode=2), [("&amp;lt;", "<"), ("&amp;copy;", "©"), ("a &amp; b", "a & b"), ("&amp;amp;amp;", "&amp;")]),
    (lambda: text.show_value("a"), [(None, "(NULL)"), ("  ", "(EMPTY)"), ("x", "x")]),
    (lambda: text.truncate("a", 3, " ..."), [("abcd", "abc ..."), ("abc", "abc"), (None, None)]),
    (lambda: text.sha256_hex("a"), [("x", hashlib.sha256(b"x").hexdigest()), ("é", hashlib.sha256("é".encode()).hexdigest())]),
    (lambda: text.json_value("a"), [
        (None, "null"), ('a"b\\c\n', '"a\\"b\\\\c\\n"'), ("\x01é", '"\\u0001é"'), ("\x1f\t", '"\\u001f\\t"'),
    ]),
    (lambda: identifiers.doi_in("a"), [
        ("see (10.1038/s41586-1).", "10.1038/s41586-1"), ("x10.1038/a", None), ("10.1/a", None), ('10.1234/a"b', "10.1234/a"),
        ("éx 10.1234/a<b", "10.1234/a"), ("é10.1234/a", None),
    ]),
    (lambda: identifiers.ingest_doi("a"), [
        ("https://dx.doi.org/10.1234/AB", "10.1234/ab"), ("DOI: 10.1234/A", "10.1234/a"), ("doi.org/10.1234/a", "doi.org/10.1234/a"),
        ("  ", None), (None, None), ("doi:", None),
    ]),
    (lambda: identifiers.lookup_doi("a"), [
        ("doi.org/10.1234/a/", "10.1234/a"), ("DOI:10.1234/A", "doi:10.1234/a"), (None, ""), ("doi:10.1/doi:a", "10.1/a"),
    ]),
    (lambda: identifiers.publisher_doi("a"), [
        ("doi:10.1/a", "10.1/a"), ("DOI: https://doi.org/10.1/A", "10.1/A"), ("http://doi.org/10.1/a", "http://doi.org/10.1/a"), (" ", None),
    ]),
    (lambda: identifiers.normalize_link("a"), [
        ("https://h/p?utm_source=x&b=2&gclid=1", "https://h/p?&b=2"), ("https://h/p/?utm_source=x", "https://h/p"),
        ("https://h/?spm=1#a", "https://h/?#a"), ("https://h/", "https://h"), ("https://h?myspm=1", "https://h?myspm=1"),
        ("/", "/"), (None, None), ("https://h/p?UTM_Medium=a", "https://h/p"),
    ]),
    (lambda: identifiers.domain_of("a"), [
        ("HTTPS://U@My_Host.com:80/p q", "u@my_host.com:80"), ("no scheme", ""), (None, None), ("", None), ("//h/p", "h"),
    ]),
    (lambda: identifiers.host_in("a", "nature.com"), [
        ("https://www.nature.com/a", True), ("https://nature.com", True), ("https://xnature.com", False), (None, False),
    ]),
    (lambda: identifiers.host_in("a", "nature.com", compat=True), [("https://xnature.com", True)]),
    (lambda: identifiers.is_html_type("a"), [("Text/HTML; charset=x", True), ("application/pdf", False), (None, False)]),
    (lambda: dates.human_date("a"), [
        ("Published: 9 August 2025", "2025-08-09"), ("45 August 2025", "2025-08-45"), ("9 Aug 2025", None), (None, None), ("", None),
    ]),
    (lambda: dates.iso_date_prefix("a"), [("2025-08-19T00:00", "2025-08-19"), ("2025/08/19", None), (None, None)]),
    (lambda: dates.is_incomplete_date("a"), [
        (None, True), ("2025-08-19", False), ("2025-08", True), ("2025", True), ("Tue, 19 Aug 2025 10:00:00 GMT", False), ("", True),
    ]),
    (lambda: dates.flexible_date("a").cast("string"), [
        ("2025-08-19", "2025-08-19"), ("2025-08", "2025-08-01"), ("Tue, 19 Aug 2025 10:00:00 GMT", "2025-08-19"),
        ("9 August 2025", "2025-08-09"), ("2025-08-19T10:00:00+08:00", "2025-08-19"), ("nonsense", None), ("2025-13-40", None), (None, None),
    ]),
    (lambda: dates.flexible_date("a").cast("string"), [
        ("2025", "2025-01-01"), ("August 2025", "2025-08-01"), ("2025 Aug", "2025-08-01"), ("Aug 19, 2025", "2025-08-19"),
        ("August 19th, 2025", "2025-08-19"), ("1st of August 2025", "2025-08-01"), ("19-Aug-2025", "2025-08-19"), ("2025 Aug 9", "2025-08-09"),
        ("08/19/2025", "2025-08-19"), ("19/08/2025", "2025-08-19"), ("03/04/2025", "2025-03-04"), ("19.08.2025", "2025-08-19"),
        ("2025/8/9", "2025-08-09"), ("20250819", "2025-08-19"), ("20250819T101500", "2025-08-19"), ("08/19/25", "2025-08-19"),
        ("Tue Aug 19 10:00:00 2025", "2025-08-19"), ("Tuesday, August 19, 2025 at 10:00 PM EST", "2025-08-19"), ("9 Sept 99", "1999-09-09"),
        ("2025-02-30", None), ("Aug 19", None), ("19", None), ("10:00", None), ("2025-08-19 junk", None), ("8 9 10 2025", None), ("", None),
        ("Winter 2025", None), ("2025–08–19", None), ("1234567890123456789012", None), ("Aug Sep 2025", None),
    ]),
    (lambda: topics.primary_topic(F.lower("a")), [
        ("additive manufacturing", "其他"), ("3d print", "3D打印和增材制造"), ("protein ai", "生命科学"), ("proteins", "其他"),
        ("machine\nlearning", "人工智能"), ("AI技术", "其他"), ("the AI.", "人工智能"), ("_ai_", "其他"), ("", "其他"),
        ("stem cell", "生命科学"), ("multi-agent", "人工智能"), ("clinical  trial", "其他"),
    ]),
    (lambda: topics.decode_tags("a"), [
        ('["a"]', ["a"]), ("a", ["a"]), ("123", ["123"]), (None, []), ("", []), ('["a", oops', ['["a", oops']), ('{"a":1}', ['{"a":1}']),
    ]),
    (lambda: articles.article_type("a"), [("NEWS & Views", "News & Views"), ("Research Article", "Article"), ("Essay", "Essay"), (None, None)]),
]


@pytest.mark.parametrize("number", range(len(CASES)))
def test_golden(spark, number):
    expr, cases = CASES[number]
    assert apply(spark, expr(), *((i,) for i, _ in cases)) == [o for _, o in cases]


def test_dates_agree_with_the_usual_parser(spark):
    """Every order, separator and form of year, month and day that names a year, with and without a time."""
    parser = pytest.importorskip("dateutil.parser")
    texts = set()
    for y, m, d in ((2025, 8, 19), (2024, 2, 29), (2023, 12, 1), (2031, 5, 6), (1999, 11, 30), (2025, 2, 30), (2025, 13, 1)):
        names = [f"{m}", f"{m:02d}", *((f"{dates.MONTHS[m - 1][:3]}", f"{dates.MONTHS[m - 1].title()}") if m < 13 else ())]
        for month in names:
            for sep in ("-", "/", " ", ".", ", "):
                for year in (f"{y}", f"{y % 100:02d}"):
                    for order in itertools.permutations((year, month, f"{d:02d}")):
                        texts.add(sep.join(order))
                texts |= {sep.join((f"{y}", month)), sep.join((month, f"{y}"))} if sep != "." else set()
        texts |= {f"{y}{m:02d}{d:02d}", f"{y}-{m:02d}-{d:02d}T01:02:03Z", f"{y}-{m:02d}-{d:02d} 01:02:03.5+08:00", f"{y}"}
    texts = sorted(texts)
    want = []
    for t in texts:
        try:
            want.append(parser.parse(t, default=datetime(2025, 1, 1)).date().isoformat())
        except (ValueError, OverflowError):
            want.append(None)
    got = apply(spark, dates.flexible_date("a").cast("string"), *((t,) for t in texts))
    assert [x for x in zip(texts, got, want) if x[1] != x[2]] == []


def test_multi_topics(spark):
    out = apply(spark, topics.topic_array(topics.tagging_text("a", F.lit(None).cast("string"))), ("关于人工智能",), (None,))
    assert out == [["其他", "人工智能"], ["其他"]]


def test_encode_tags(spark):
    assert apply(spark, topics.encode_tags(F.array("a", F.lit("b"))), ('x"é',)) == ['["x\\"é", "b"]']


def test_external_label(spark):
    expr = topics.label_from_answer("a", F.lit("about ai"))
    assert apply(spark, expr, (" '生命 科学' ",), ("none",), (None,)) == ["生命科学", "人工智能", "人工智能"]


def test_better_abstract(spark):
    rows = [(None, "x"), ("x", " "), ("o" * 100, "n" * 119), ("o" * 100, "n" * 120), ("o" * 79, "n" * 10), ("o" * 80, "n" * 10), ("x", " x ")]
    assert apply(spark, articles.is_better_abstract("a", "b"), *rows, schema="a string, b string") == [
        True, False, False, True, True, False, False]


def test_guess_order(spark):
    assert apply(spark, identifiers.guess_doi("a", "b"), (None, "10.1234/b"), ("10.1/a", None), ("10.1111/a", "10.2222/b"),
                 schema="a string, b string") == ["10.1234/b", None, "10.1111/a"]


def test_second_application_changes_nothing(spark):
    links = [("https://h/p?utm_source=x&b=2",), ("https://h/p//",), ("h?&",)]
    dois = [("https://doi.org/10.1/A",), ("doi: x ",)]
    once = apply(spark, identifiers.ingest_doi("a"), *dois)
    assert once == apply(spark, identifiers.ingest_doi(identifiers.ingest_doi("a")), *dois)
    assert apply(spark, text.collapse_spaces("a"), *links) == apply(spark, text.collapse_spaces(text.collapse_spaces("a")), *links)


def test_clean_text_matches_python(spark):
    import html
    import re

    samples = ["&lt;p&gt;", "&#x41;&#65", "&notit;", "&&amp;", "&amp &lt", "a&nbsp;b", "&amp;#38;", " a b", "x\x1fy", "&;&#;", "&quot;&apos;"]
    want = [re.sub(r"\s+", " ", html.unescape(s)).strip() for s in samples]
    assert apply(spark, text.clean_text("a"), *((s,) for s in samples)) == want
    twice = [re.sub(r"\s+", " ", html.unescape(html.unescape(s))).strip() for s in samples]
    assert apply(spark, text.clean_text("a", decode=2), *((s,) for s in samples)) == twice
