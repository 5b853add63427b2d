"""Table maintenance as DataFrame-to-DataFrame merges. Every input holds one row per key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom import schemas
from feedloom.session import is_small


def upsert(target: DataFrame, source: DataFrame, key: str, keep: Iterable[str] = ()) -> DataFrame:
    """Rows of both tables; where keys meet the source wins, except for the ``keep`` columns.

    For a small source the target's other rows pass by its broadcast keys, so they are neither shuffled nor sorted.
    """
    keys = source.select(key)
    if not is_small(keys):
        return _overlay(target, source, key, set(keep))
    others, met = (target.join(F.broadcast(keys), key, how).select(*target.columns) for how in ("left_anti", "left_semi"))
    return others.unionByName(_overlay(met, source, key, set(keep)))


def _overlay(target: DataFrame, source: DataFrame, key: str, keep: set[str]) -> DataFrame:
    t, s = target.withColumn("_in_t", F.lit(True)).alias("t"), source.withColumn("_in_s", F.lit(True)).alias("s")
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    columns = []
    for c in target.columns:
        old, new = F.col(f"t.{c}"), F.col(f"s.{c}")
        if c == key:
            columns.append(F.coalesce(old, new).alias(c))
        elif c in keep:
            columns.append(F.when(F.col("t._in_t"), old).otherwise(new).alias(c))
        else:
            columns.append(F.when(F.col("s._in_s"), new).otherwise(old).alias(c))
    return joined.select(*columns)


def upsert_articles(articles: DataFrame, updates: DataFrame) -> DataFrame:
    return upsert(articles, updates, "uid", schemas.ARTICLE_INSERT_ONLY)


def replace_rows(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Whole-row replacement by key."""
    return target.join(source.select(key), key, "left_anti").unionByName(source)


def insert_ignore(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """The source rows an insert-or-ignore would add; append them to the target."""
    return source.join(target.select(key), key, "left_anti")


def delete_keys(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return target.join(keys.select(key), key, "left_anti")
