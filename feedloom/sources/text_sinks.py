"""Text outputs of the reports. Files are written in order, as many as the sort has partitions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.plans import reports


def write_digest(lines: DataFrame, path: str, blank_between: bool = True) -> None:
    """The digest as Markdown: part files in document order."""
    ordered = lines.orderBy(*reports.DIGEST_ORDER)
    is_list_item = F.col("section") == 1
    spaced = F.when(is_list_item | F.lit(not blank_between), F.col("line")).otherwise(F.concat("line", F.lit("\n")))
    ordered.select(spaced.alias("value")).write.mode("overwrite").text(path)


def write_digest_by_journal(lines: DataFrame, path: str) -> None:
    """The body of an unbounded digest as one folder per journal, each sorted within its files."""
    body = lines.filter(F.col("section") == 3)
    ordered = body.repartitionByRange("journal", "item", "part").sortWithinPartitions("journal", "item", "part")
    ordered.select("journal", F.col("line").alias("value")).write.mode("overwrite").partitionBy("journal").text(path)


def write_listing(blocks: DataFrame, path: str, run_ts: datetime, topics=None) -> None:
    """The numbered listing under its heading; bounded by the listing's limit."""
    spark = blocks.sparkSession
    head = spark.range(1).select(F.lit(0).alias("position"), F.lit(reports.listing_header(run_ts, topics)).alias("block"))
    whole = head.unionByName(blocks.select("position", "block"))
    whole.orderBy("position").select(F.col("block").alias("value")).coalesce(1).write.mode("overwrite").text(path)
