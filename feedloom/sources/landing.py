"""Readers for landed payloads and for lists that users supply."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schemas


def feed_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Feed polls: one row per feed and poll with its status, validators and XML text."""
    return spark.read.schema(schemas.FEED_PAYLOADS).parquet(path)


def page_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Fetched article pages: one row per url with content type, HTML text or error."""
    return spark.read.schema(schemas.PAGE_PAYLOADS).parquet(path)


def feed_payload_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schemas.FEED_PAYLOADS)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def doi_lines(spark: SparkSession, path: str) -> DataFrame:
    """A DOI file as ``(ord, value)``; comments and blanks are dropped when the requests are formed."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("ord"), "value")
