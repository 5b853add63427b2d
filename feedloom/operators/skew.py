"""Joins that survive one key holding a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.functions.text import as_col

_SALT = "_salt"


def heavy_keys(df: DataFrame, key: str, floor: int = 100_000, top: int = 1_000) -> list:
    """The at most ``top`` most frequent keys with ``floor`` or more rows.

    A key beyond the first ``top`` holds under ``1/top`` of the rows, so it needs no salting. Counting is
    map-side combined and only the bounded list reaches the driver.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    frequent = counts.filter(F.col("n") >= floor).orderBy(F.desc("n"), key).limit(top)
    return [row[key] for row in frequent.select(key).collect()]


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str,
    spread: Column | str,
    heavy: list,
    salts: int = 32,
) -> DataFrame:
    """Join on ``key`` with heavy left keys spread over ``salts`` buckets by ``spread``, and NULL ones over all partitions.

    ``right`` must hold one row per key; only its rows for heavy keys are replicated. ``how`` is one of
    inner, left, left_semi and left_anti. The salt of the right rows comes out of a generator also where it is
    always 0: as a literal it would leave the join keys, and all NULL keys would meet in one task.
    """
    is_heavy = F.col(key).isin(heavy) if heavy else F.lit(False)
    place, none = F.xxhash64(as_col(spread)), F.lit(0).cast("long")
    bucket = F.when(F.col(key).isNull(), place).when(is_heavy, F.pmod(place, F.lit(salts).cast("long"))).otherwise(none)
    copies = F.when(is_heavy, F.sequence(none, F.lit(salts - 1).cast("long"))).otherwise(F.array(none))
    left, right = left.withColumn(_SALT, bucket), right.withColumn(_SALT, F.explode(copies))
    return left.join(right, [key, _SALT], how).drop(_SALT)
