"""Table and payload schemas, and the small enumerations that go with them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "timestamp_ntz": T.TimestampNTZType()}


def _schema(columns: str) -> T.StructType:
    """A flat schema from ``name type, …``; needs no running session."""
    pairs = (c.split() for c in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


FEEDS = _schema("feed_url string, etag string, last_modified string, last_checked_at timestamp_ntz")
SEEN = _schema(
    "uid string, feed_url string, article_url string, doi string, pub_date string, first_seen_at timestamp_ntz"
)
ARTICLES = _schema(
    "uid string, feed_url string, journal string, title_en string, title_cn string, type string,"
    " pub_date string, doi string, article_url string, abstract_en string, abstract_cn string,"
    " raw_jsonld string, fetched_at timestamp_ntz, last_updated_at timestamp_ntz, topic_tag string"
)
RUNS_LOG = _schema(
    "run_id string, script_name string, started_at timestamp_ntz, finished_at timestamp_ntz,"
    " status string, notes string, rows_processed long"
)
PENDING = _schema(
    "uid string, feed_url string, article_url string, doi string, pub_date string, fail_count long,"
    " last_error string, first_seen_at timestamp_ntz, last_attempt_at timestamp_ntz"
)
META = _schema("key string, value string")

FEED_PAYLOADS = _schema(
    "feed_url string, feed_ord int, status int, etag string, last_modified string, content string,"
    " polled_at timestamp_ntz"
)
PAGE_PAYLOADS = _schema("url string, content_type string, html string, error string")

# The topic labels in priority order; the last one is the default.
TOPICS = ("生命科学", "人工智能", "3D打印和增材制造", "其他")
DEFAULT_TOPIC = TOPICS[-1]

# Columns a page or a backfill may change; feed_url and fetched_at belong to the first insert.
ARTICLE_INSERT_ONLY = ("feed_url", "fetched_at")
PLAN_COLUMNS = ("title_cn", "abstract_cn", "topic_tag", "type", "journal", "pub_date", "abstract_en")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto ``schema``: missing columns become typed NULLs, extra columns are left out."""
    present = set(df.columns)
    return df.select(
        *(
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )
