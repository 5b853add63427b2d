"""Feed payloads to item rows, for RSS 1.0/RDF, RSS 2.0 and Atom.

Element names count by namespace, which ``from_xml`` does not resolve: it sees prefixes only. So payloads are read by
the standard library's parser inside Arrow batches, each once, into rows of two kinds: one for the poll, with what is
wrong with it, and one for each item. All that follows is column expressions.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from feedloom import schemas
from feedloom.functions.feed_xml import RAW, NotAFeed, read_feed
from feedloom.functions.identifiers import guess_doi
from feedloom.functions.text import blank_to_null, clean_all, first_filled

MAX_ITEMS_PER_FEED = 0  # landed payloads are taken whole; a limit is the caller's choice

_CLEANED_FIELDS = ("title", "pub_date", "doi", "journal")
_POLL = [f for f in schemas.FEED_PAYLOADS.fields if f.name != "content"]
_READ = T.StructType([
    *_POLL, T.StructField("dialect", T.StringType()), T.StructField("error", T.StringType()), T.StructField("pos", T.IntegerType()),
    *(T.StructField(c, T.StringType()) for c in RAW),
])
_ROWS_PER_BATCH = 200  # whole descriptions are in them


def read_feeds(payloads: DataFrame) -> DataFrame:
    """A row for each poll (``pos`` is NULL; ``error`` says why served content cannot be read) and one for each item,
    with its place in the document. Stage it: items, failures and poll state all come from it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, rows = to_arrow_schema(_READ), []
        for batch in batches:
            for k in range(batch.num_rows):
                rows += _read_rows(batch.slice(k, 1).to_pylist()[0])
                while len(rows) >= _ROWS_PER_BATCH:
                    yield pa.RecordBatch.from_pylist(rows[:_ROWS_PER_BATCH], schema)
                    rows = rows[_ROWS_PER_BATCH:]
        yield pa.RecordBatch.from_pylist(rows, schema)

    return schemas.conform(payloads, schemas.FEED_PAYLOADS).mapInArrow(run, _READ)


def _read_rows(payload: dict) -> list[dict]:
    content = payload.pop("content")
    poll = payload | dict.fromkeys(("dialect", "error", "pos", *RAW))
    if payload["status"] is None or not 200 <= payload["status"] <= 299:
        return [poll]
    try:
        dialect, items = read_feed(content)
    except NotAFeed as e:
        return [poll | {"error": str(e)}]
    poll["dialect"] = dialect
    return [poll, *(poll | item | {"pos": pos} for pos, item in enumerate(items))]


def polls_of(read: DataFrame) -> DataFrame:
    return read.filter(F.col("pos").isNull()).select(*(f.name for f in _POLL), "dialect", "error")


def items_of(read: DataFrame, max_items: int = MAX_ITEMS_PER_FEED) -> DataFrame:
    """The items of ``read_feeds``, at most ``max_items`` per payload in document order (``<= 0`` for all)."""
    wanted = F.col("pos").isNotNull() if max_items <= 0 else F.col("pos") < max_items
    link, ident = blank_to_null("link"), blank_to_null("ident")
    raw = read.filter(wanted).select(
        "feed_url", "feed_ord", "polled_at", "dialect", "pos", link.alias("link"), first_filled("about", ident, link).alias("id_like"),
        F.array("title", "pub_date", F.coalesce("doi", guess_doi(ident, blank_to_null("description"), link)), "journal").alias("_texts"),
    )
    cleaned = raw.withColumn("_clean", clean_all(F.col("_texts")))
    clean = {c: F.get("_clean", F.lit(k)).alias(c) for k, c in enumerate(_CLEANED_FIELDS)}
    return cleaned.select("feed_url", "feed_ord", "polled_at", "dialect", "pos", clean["title"], "link", "id_like", clean["pub_date"], clean["doi"], clean["journal"])


def feed_items(payloads: DataFrame, max_items: int = MAX_ITEMS_PER_FEED) -> DataFrame:
    """One row per feed item in document order, at most ``max_items`` per payload (``<= 0`` for all).

    Unchanged (304) and unreadable payloads give no rows.
    """
    return items_of(read_feeds(payloads), max_items)


def broken_payloads(payloads: DataFrame) -> DataFrame:
    """Payloads that could not be read; they count as failures and leave other feeds alone."""
    return polls_of(read_feeds(payloads)).filter("error IS NOT NULL").select("feed_url", "feed_ord", "dialect", "polled_at", "error")


def poll_failures(polls: DataFrame) -> tuple[int, int]:
    """How many polls served what cannot be read, and how many were refused or ended in an error."""
    row = polls.agg(F.count_if(F.col("error").isNotNull()).alias("broken"), F.count_if(F.col("status") >= 400).alias("refused")).first()
    return row.broken, row.refused


def feed_state(feeds: DataFrame, polls: DataFrame) -> DataFrame:
    """Poll state after a round of polls: 304 keeps the old validators, content replaces them.

    ``polls`` may hold several polls of one feed; the last one with content counts. Polls that failed, or whose content
    could not be read (``error``), change nothing.
    """
    good = F.col("status") < 400
    if "error" in polls.columns:
        good &= F.col("error").isNull()
    with_content = F.when(F.col("status") != 304, F.struct("polled_at", "status"))
    last = (
        polls.filter(good)
        .groupBy("feed_url")
        .agg(
            F.max_by(F.struct("etag", "last_modified"), with_content).alias("p"),
            F.max("polled_at").alias("polled_at"),
        )
    )

    def validator(name: str) -> Column:
        return F.when(F.col("p").isNull(), F.col(name)).otherwise(F.col(f"p.{name}")).alias(name)

    return feeds.join(last, "feed_url", "full_outer").select(
        "feed_url",
        validator("etag"),
        validator("last_modified"),
        F.coalesce("polled_at", "last_checked_at").alias("last_checked_at"),
    )


def poll_plan(configured: DataFrame, feeds: DataFrame) -> DataFrame:
    """Configured feeds with the validators to send on the next poll."""
    return configured.join(feeds.select("feed_url", "etag", "last_modified"), "feed_url", "left")


def failed_polls(payloads: DataFrame) -> DataFrame:
    """Polls that the server refused or that ended in an error."""
    return payloads.filter(F.col("status") >= 400)
