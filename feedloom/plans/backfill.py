"""Backfill: choose candidates, compare them with re-read pages, and plan and apply the smallest changes."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.articles import is_better_abstract
from feedloom.functions.dates import is_incomplete_date, local_time
from feedloom.functions.identifiers import is_html_type
from feedloom.functions.text import blank_to_null, changed, sha256_hex, show_value, stripped_or_empty
from feedloom.functions.topics import decode_tags, primary_topic, tagging_text
from feedloom.operators.pages import records_for
from feedloom.operators.ranking import rank_within
from feedloom.operators.skew import heavy_keys, salted_join
from feedloom.schemas import PLAN_COLUMNS
from feedloom.session import broadcast_if_small, stage

BATCH_SIZE = 20
META_COLUMNS = ("type", "journal", "pub_date", "abstract_en")
_CANDIDATE_COLUMNS = (
    "uid", "article_url", "fetched_at", "title_en", "abstract_en", "title_cn", "abstract_cn", "topic_tag",
    "type", "journal", "pub_date", "doi",
)
# Reasons and markers of the report on rows that could not be improved.
NO_URL, FETCH_FAILED, NOT_HTML = "(missing)", "fetch/extract failed: ", "non-HTML or parser returned None"
NOT_LANDED = "page not landed"


# ---- candidates ------------------------------------------------------------------------------------------

def range_candidates(
    articles: DataFrame, start: date | None = None, end: date | None = None, limit: int = 0
) -> DataFrame:
    """Articles fetched from ``start`` to the end of day ``end``, oldest first; ``limit`` 0 means all.

    The bounds are literals on the raw column, so they reach the Parquet scan.
    """
    rows = articles.select(*_CANDIDATE_COLUMNS)
    if start:
        rows = rows.filter(F.col("fetched_at") >= local_time(datetime.combine(start, datetime.min.time())))
    if end:
        after = datetime.combine(end + timedelta(days=1), datetime.min.time())
        rows = rows.filter(F.col("fetched_at") < local_time(after))
    rows = rows.orderBy("fetched_at", "uid")
    return rows.limit(limit) if limit > 0 else rows


def doi_candidates(articles: DataFrame, dois: DataFrame) -> DataFrame:
    """Articles whose DOI is asked for, or whose link contains ``doi.org/`` followed by an asked DOI.

    ``dois(doi_key)`` holds distinct keys. Containment becomes an equi-join: after each ``doi.org/`` the link's
    prefixes of the lengths that occur among the keys are compared with the keys, so no pair is tried in vain.
    """
    keys = dois.select("doi_key")
    lengths = [r["n"] for r in keys.select(F.length("doi_key").alias("n")).distinct().collect()]
    if not lengths:
        return articles.filter(F.lit(False))
    parts = F.split(F.lower("article_url"), r"doi\.org/")
    tails = F.transform(
        F.sequence(F.lit(2), F.greatest(F.size(parts), F.lit(2))),
        lambda i: F.array_join(F.slice(parts, i, F.greatest(F.size(parts), F.lit(1))), "doi.org/"),
    )
    sizes = F.array(*(F.lit(n) for n in sorted(lengths)))
    prefixes = F.flatten(
        F.transform(
            F.filter(tails, lambda t: t != ""),
            lambda t: F.transform(F.filter(sizes, lambda n: n <= F.length(t)), lambda n: F.substr(t, F.lit(1), n)),
        )
    )
    wanted = F.array_distinct(F.concat(
        F.array_compact(F.array(F.lower("doi"))), F.coalesce(prefixes, F.array().cast("array<string>"))
    ))
    narrow = articles.select("uid", F.explode(wanted).alias("doi_key"))
    hits = narrow.join(broadcast_if_small(keys), "doi_key", "left_semi").select("uid").distinct()
    return articles.join(hits, "uid", "left_semi")


# ---- the plan --------------------------------------------------------------------------------------------

def missing_fields(with_abstract: Column) -> Column:
    blank_type, blank_journal = blank_to_null("type").isNull(), blank_to_null("journal").isNull()
    return F.array_compact(
        F.array(
            F.when(blank_type, "type"),
            F.when(blank_journal, "journal"),
            F.when(is_incomplete_date("pub_date"), "pub_date"),
            F.when(with_abstract, "abstract_en"),
        )
    )


def probe_outcome() -> Column:
    """NULL for a usable page, else why the row cannot be improved."""
    return (
        F.when(F.nullif("article_url", F.lit("")).isNull(), NO_URL)
        .when(F.col("probe").isNull(), NOT_LANDED)
        .when(F.col("probe.error").isNotNull(), F.concat(F.lit(FETCH_FAILED), F.col("probe.error")))
        .when(~is_html_type("probe.content_type"), NOT_HTML)
    )


def plan_metadata(candidates: DataFrame, probes: DataFrame) -> DataFrame:
    """Candidates with their metadata changes (``new_*`` columns, NULL for no change) and probe outcome.

    ``probes(uid, type, journal, date_published, abstract_en, content_type, error)`` has one row per uid. This
    is the only join with page data; every later step works on its rows.
    """
    fields = F.struct(*(c for c in probes.columns if c != "uid")).alias("probe")
    rows = candidates.join(probes.select("uid", fields), "uid", "left").withColumn("outcome", probe_outcome())
    usable = F.col("outcome").isNull()

    def if_different(name: str) -> Column:
        new = F.nullif(F.col(f"probe.{name}"), F.lit(""))
        return F.when(usable & changed(new, F.col(name)), new)

    day = F.nullif(F.col("probe.date_published"), F.lit(""))
    new_day = changed(day, F.col("pub_date")) | is_incomplete_date("pub_date")
    better = is_better_abstract("abstract_en", "probe.abstract_en")
    return rows.select(
        *candidates.columns,
        "outcome",
        missing_fields(F.col("outcome") != NO_URL).alias("missing"),
        if_different("type").alias("new_type"),
        if_different("journal").alias("new_journal"),
        F.when(usable & new_day, day).alias("new_pub_date"),
        F.when(usable & better, stripped_or_empty("probe.abstract_en")).alias("new_abstract_en"),
    )


def no_improve(plan: DataFrame) -> DataFrame:
    """Rows whose page could not be used, with the fields they still miss."""
    missing_url = F.col("outcome") == NO_URL
    return plan.filter(F.col("outcome").isNotNull()).select(
        "uid",
        F.when(missing_url, NO_URL).otherwise(F.col("article_url")).alias("url"),
        F.array_join("missing", ",").alias("missing_fields"),
        F.when(~missing_url, F.col("outcome")).alias("reason"),
    )


def translation_sources(plan: DataFrame, force: bool = False) -> DataFrame:
    """Add ``title_src`` and ``abstract_src``: the English text to translate, NULL where nothing is needed."""
    texts = _source_texts()
    need_title = F.lit(force) | blank_to_null("title_cn").isNull()
    need_abstract = F.lit(force) | _new_abstract().isNotNull() | blank_to_null("abstract_cn").isNull()
    return plan.withColumn("title_src", F.when(need_title, texts["title_src"])).withColumn(
        "abstract_src", F.when(need_abstract, texts["abstract_src"])
    )


def _new_abstract() -> Column:
    return F.nullif(F.col("new_abstract_en"), F.lit(""))


def _source_texts() -> dict[str, Column]:
    """What a text to translate is, if one is needed; cheap, since the texts themselves are in the row already."""
    return {"title_src": blank_to_null("title_en"), "abstract_src": F.coalesce(_new_abstract(), blank_to_null("abstract_en"))}


def _marked(rows: DataFrame) -> DataFrame:
    """The texts to translate as marks, so that rows do not travel, and are not written, with their abstract twice."""
    return rows.withColumns({f"_{c}": F.col(c).isNotNull() for c in _source_texts()}).drop(*_source_texts())


def _with_sources(marked: DataFrame) -> DataFrame:
    """The rows that ``_marked`` had."""
    columns = [F.when(F.col(f"_{c}"), text).alias(c) for c, text in _source_texts().items()]
    return marked.select(*(c for c in marked.columns if c not in {f"_{n}" for n in _source_texts()}), *columns)


def translation_work(sources: DataFrame) -> DataFrame:
    """Distinct texts to translate with their hash; repeated texts are combined before the shuffle."""
    texts = sources.select(F.explode(F.array("title_src", "abstract_src")).alias("text")).filter("text IS NOT NULL")
    hashed = texts.select(sha256_hex("text").alias("src_hash"), "text")
    return hashed.groupBy("src_hash").agg(F.min("text").alias("text"))


def add_translations(sources: DataFrame, translations: DataFrame) -> DataFrame:
    """Look up ``translations(src_hash, text)`` for both texts; a text many rows share is salted."""
    answers = translations.filter("text IS NOT NULL AND text <> ''")
    rows = _marked(sources.withColumn("_h_title", sha256_hex("title_src")).withColumn("_h_abstract", sha256_hex("abstract_src")))
    heavy = heavy_keys(rows.select(F.explode(F.array("_h_title", "_h_abstract")).alias("h")), "h")
    for key, out in (("_h_title", "new_title_cn"), ("_h_abstract", "new_abstract_cn")):
        right = answers.select(F.col("src_hash").alias(key), F.col("text").alias(out))
        rows = salted_join(rows, right, key, "left", "uid", heavy).drop(key)
    return _with_sources(rows)


def without_translations(sources: DataFrame) -> DataFrame:
    """No translator: the translation part of the plan stays empty."""
    empty = F.lit(None).cast("string")
    return sources.withColumn("new_title_cn", empty).withColumn("new_abstract_cn", empty)


def translation_batches(sources: DataFrame, src: str, size: int = BATCH_SIZE) -> DataFrame:
    """Texts with their batch number in candidate order; a batch is ``size`` candidates, blanks included."""
    numbered = rank_within(sources.select("uid", "fetched_at", src), [], [F.asc("fetched_at"), F.asc("uid")], "position")
    return numbered.filter(F.col(src).isNotNull()).select(
        "uid", F.expr(f"(position - 1) DIV {size}").cast("int").alias("batch"), F.col(src).alias("text")
    )


def plan_topics(plan: DataFrame, reclassify: bool = False, compat: bool = False) -> DataFrame:
    """Add ``new_topic_tag``; by default only where it differs from the stored tag."""
    current = blank_to_null("topic_tag")
    title = F.coalesce(blank_to_null("title_en"), blank_to_null("title_cn"))
    abstract = F.coalesce(
        F.nullif(F.col("new_abstract_en"), F.lit("")), blank_to_null("abstract_en"), blank_to_null("abstract_cn")
    )
    needed = F.lit(True) if reclassify else current.isNull()
    # The text of rows that keep their tag is NULL, so the rules run on the others only.
    tagged = plan.withColumn("_text", F.when(needed, tagging_text(title, abstract))).withColumn(
        "_tag", F.when(F.col("_text").isNotNull(), primary_topic(F.col("_text")))
    )
    different = F.lit(True) if compat else changed(F.array("_tag"), decode_tags("topic_tag"))
    return tagged.withColumn("new_topic_tag", F.when(different, F.col("_tag"))).drop("_text", "_tag")


def prepare_backfill(candidates: DataFrame, probes: DataFrame, doi_mode: bool = False) -> DataFrame:
    """First half of a plan: metadata changes, written down, and the texts to translate, which follow from them.

    ``translation_work`` of the result goes to a translator; the result and its answers go to ``plan_backfill``.
    """
    return translation_sources(stage(plan_metadata(candidates, probes), "backfill-sources"), force=doi_mode)


def plan_backfill(
    sources: DataFrame,
    translations: DataFrame | None = None,
    reclassify: bool = False,
    doi_mode: bool = False,
    compat: bool = False,
) -> DataFrame:
    """All changes of all candidates, one row each. DOI mode rebuilds: retag and retranslate everything.

    The plan is written down: summary, counts and the update read it, and a filter on a planned value must not
    make Spark compute that value twice.
    """
    plan = add_translations(sources, translations) if translations is not None else without_translations(sources)
    return _with_sources(stage(plan_topics(_marked(plan), reclassify or doi_mode, compat), "backfill-plan"))


def has_change(columns=PLAN_COLUMNS) -> Column:
    return F.coalesce(*(F.col(f"new_{c}") for c in columns)).isNotNull()


def change_summary(plan: DataFrame) -> DataFrame:
    """One line of ``column: old → new`` parts per row with a change."""
    def part(c: str) -> Column:
        new = F.col(f"new_{c}")
        return F.when(new.isNotNull(), F.concat(F.lit(f"{c}: "), show_value(c), F.lit(" → "), show_value(new)))

    return plan.filter(has_change()).select("uid", F.concat_ws("; ", *map(part, PLAN_COLUMNS)).alias("changes"))


def plan_counts(plan: DataFrame) -> DataFrame:
    """Plan sizes in one aggregate."""
    return plan.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(has_change(META_COLUMNS)).alias("meta"),
        F.count_if(has_change(("title_cn", "abstract_cn"))).alias("trans"),
        F.count_if(has_change(("topic_tag",))).alias("tag"),
        F.count_if(F.col("outcome").isNotNull()).alias("no_improve"),
        F.count_if(has_change()).alias("to_apply"),
    )


# ---- applying it -----------------------------------------------------------------------------------------

def approved_changes(plan: DataFrame, approved: DataFrame | None = None) -> DataFrame:
    """Rows with a change that may be written; ``approved(uid)`` stands for the answers of a reviewer."""
    wanted = plan.filter(has_change()).select("uid", *(f"new_{c}" for c in PLAN_COLUMNS))
    return wanted if approved is None else wanted.join(approved.select("uid"), "uid", "left_semi")


def apply_plan(
    articles: DataFrame,
    plan: DataFrame,
    run_ts: datetime,
    approved: DataFrame | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """Articles with the approved changes; ``last_updated_at`` moves only where something changed."""
    if dry_run:
        return articles
    changes = approved_changes(plan, approved).withColumn("_changed", F.lit(True))
    joined = articles.join(changes, "uid", "left")
    columns = []
    for c in articles.columns:
        if c in PLAN_COLUMNS:
            columns.append(F.coalesce(f"new_{c}", c).alias(c))
        elif c == "last_updated_at":
            moved = F.when(F.col("_changed"), local_time(run_ts))
            columns.append(moved.otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(c))
    return joined.select(*columns)


def page_probes(candidates: DataFrame, page_payloads: DataFrame) -> DataFrame:
    """Probes by uid from landed pages; candidates sharing a hot url are salted."""
    wanted = candidates.select("uid", F.nullif("article_url", F.lit("")).alias("url"))
    records = records_for(wanted, page_payloads)
    probed = salted_join(wanted, records, "url", "inner", "uid", heavy_keys(wanted, "url"))
    return probed.select(
        "uid", "page.type", "page.journal", "page.date_published", F.col("page.abstract").alias("abstract_en"),
        "page.content_type", "page.error",
    )
