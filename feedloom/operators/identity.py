"""Item identity: uids, duplicates, and what has been seen before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.identifiers import ingest_doi, lookup_doi, normalize_link
from feedloom.functions.text import blank_to_null, json_value, sha256_hex, strip
from feedloom.session import is_small, stage

ITEM_FIELDS = ("title", "link", "id_like", "pub_date", "doi", "journal")
HASH_DIGITS = 24


def short_hash(c: Column) -> Column:
    return F.substr(sha256_hex(c), F.lit(1), F.lit(HASH_DIGITS))


def canonical_json(fields: tuple[str, ...] = ITEM_FIELDS) -> Column:
    """An item as JSON with sorted keys, explicit nulls and ``", "``/``": "`` separators."""
    pairs = [F.concat(F.lit(f'"{name}": '), json_value(name)) for name in sorted(fields)]
    return F.concat(F.lit("{"), F.concat_ws(", ", *pairs), F.lit("}"))


def item_uid() -> Column:
    """Identity by DOI, else by feed id, else by normalised link, else by the whole item."""
    link = F.nullif(normalize_link("link"), F.lit(""))
    return F.coalesce(
        F.concat(F.lit("doi:"), ingest_doi("doi")),
        F.concat(F.lit("id:"), F.nullif(F.col("id_like"), F.lit(""))),
        F.concat(F.lit("linkhash:"), short_hash(link)),
        F.concat(F.lit("hash:"), short_hash(canonical_json())),
    )


def dedupe_items(items: DataFrame) -> DataFrame:
    """One row per uid: the first feed wins, inside it the last poll, and of its items the last.

    A single map-side combined aggregate, so a uid with very many copies is reduced before the shuffle.
    """
    content = [c for c in items.columns if c != "uid"]
    polled = [F.col("polled_at")] if "polled_at" in content else []
    winning = F.struct(-F.col("feed_ord"), *polled, F.col("pos"))
    winner = items.groupBy("uid").agg(F.max_by(F.struct(*content), winning).alias("w"))
    return winner.select("uid", *(F.col(f"w.{c}").alias(c) for c in content))


def unseen(items: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows whose uid is not in the ledger. ``items`` must be deduplicated, so no join key is hot.

    An anti-join can broadcast only its right side, which would shuffle a large ledger for a few items; a small batch
    is therefore sent to the ledger first, and only its hits come back.
    """
    if not is_small(items.select("uid")):
        return items.join(seen.select("uid"), "uid", "left_anti")
    known = seen.select("uid").join(F.broadcast(items.select("uid")), "uid", "left_semi").distinct()
    return items.join(F.broadcast(known), "uid", "left_anti")


def new_items(items: DataFrame, seen: DataFrame) -> DataFrame:
    return unseen(stage(dedupe_items(items), "batch-items"), seen)


def bounded_dedupe(items: DataFrame, event_time: str, delay: str) -> DataFrame:
    """Streaming duplicate removal with state that expires; exact only within ``delay``."""
    return items.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["uid"])


def doi_requests(arguments: DataFrame | None = None, lines: DataFrame | None = None) -> DataFrame:
    """DOIs a user asked for, one row per distinct lookup key with its first spelling.

    ``arguments(ord, value)`` may hold several comma-separated DOIs per value; ``lines(ord, value)`` hold one
    per line with blanks and ``#`` comments left out. Arguments come before lines.
    """
    sources = []
    if arguments is not None:
        sources.append(
            arguments.select(F.lit(0).alias("src"), "ord", F.posexplode(F.split("value", ",")).alias("part", "raw"))
        )
    if lines is not None:
        text = strip("value")
        sources.append(
            lines.filter(~text.startswith("#")).select(
                F.lit(1).alias("src"), "ord", F.lit(0).alias("part"), text.alias("raw")
            )
        )
    requested = sources[0] if len(sources) == 1 else sources[0].unionByName(sources[1])
    return (
        requested.select("src", "ord", "part", blank_to_null("raw").alias("raw"))
        .withColumn("doi_key", lookup_doi("raw"))
        .filter(F.col("doi_key") != "")
        .groupBy("doi_key")
        .agg(F.min_by("raw", F.struct("src", "ord", "part")).alias("doi_raw"))
    )
