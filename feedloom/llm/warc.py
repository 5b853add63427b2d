"""WARC archives: write pages as records, and read records back.

``write_archives`` makes compressed text files of WARC/1.1 records. Bodies use chunked transfer framing; a body above
``segment_bytes`` continues in further records, which name the first one (``WARC-Segment-Origin-ID``) and count up
(``WARC-Segment-Number``); the last states the total length. Chunks are cut so that the version line which starts a
record never occurs inside one: Spark's text reader can then split an archive of any size at record starts.

``read_archives`` parses records where they lie, groups only continued ones by their origin, puts the segments in
order, verifies number and total length, and decodes the framing.

Defined results: a null or empty payload is a record without content; a null url has no target header, control
characters in a url are percent-encoded; of equal payloads the row with the smallest page_id responds and others
revisit it, rows that repeat that page_id respond too, and a null page_id comes last; payloads of fewer than
``min_bytes`` bytes always respond; no rows give an archive without records. Extra columns are not read.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.llm.common import Rows, fresh_path, map_batches

VERSION = "WARC/1.1\r\n"
SEGMENT_BYTES = 32 << 10
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n"


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: five bytes, ten hex digits, make eight digits of base 32."""
    digest = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def plan_records(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """``page_id, url, payload, digest, record_type, refers_to``: which payloads respond, which revisit.

    Digests are reduced to the smallest page_id with map-side sums, and joined back; Spark splits a hot digest.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), payload.alias("payload"), base32_sha1(payload.cast("binary")).alias("digest"))
    first = pages.select(F.col(page_id).alias("first_id"), base32_sha1(payload.cast("binary")).alias("digest")).groupBy("digest").agg(F.min("first_id").alias("first_id"))
    revisit = (F.octet_length("payload") >= min_bytes) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.join(first, "digest").select(
        "page_id", "url", "payload", "digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def _chunked(payload: str, size: int) -> str:
    """Chunked framing; a chunk also ends inside each ``WARC/``, so the version line is never whole in a body."""
    parts = []
    for piece in re.split(r"(?<=WARC)(?=/)", payload):
        parts += [piece[i:i + size] for i in range(0, len(piece), size)]
    return "".join(f"{len(p.encode()):x}\r\n{p}\r\n" for p in parts) + "0\r\n\r\n"


def dechunk(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        n = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if not n:
            return b"".join(out)
        if body[at + n:at + n + 2] != b"\r\n":
            raise ValueError("chunk does not end where its size says")
        out.append(body[at:at + n])
        at += n + 2


def _cut(body: str, limit: int) -> list[str]:
    """Pieces of at most ``limit`` UTF-8 bytes, cut between code points and never inside a version line."""
    data, out, at = body.encode(), [], 0
    while len(data) - at > limit:
        end = at + limit
        while end > at + 1 and data[end] & 0xC0 == 0x80:
            end -= 1
        out.append(data[at:end].decode())
        at = end
    return [*out, data[at:].decode()]


def _record(headers: list[tuple[str, object]], body: str) -> str:
    lines = "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
    return f"{VERSION}{lines}Content-Length: {len(body.encode())}\r\n\r\n{body}\r\n"  # the writer adds the last CRLF


def _encode(segment_bytes: int, chunk_chars: int):
    def make() -> Rows:
        def records(row: dict) -> Iterator[str]:
            rid = f"<urn:uuid:{uuid.uuid4()}>"
            url = None if row["url"] is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", row["url"])
            url = url and re.sub("(?<=WARC)/", "%2F", url)
            head = [("WARC-Type", row["record_type"]), ("WARC-Record-ID", rid), ("WARC-Date", "2000-01-01T00:00:00Z"), ("WARC-Target-URI", url)]
            own = [("WARC-Payload-Digest", f"sha1:{row['digest']}"), ("Content-Type", "application/http; msgtype=response"), ("X-Page-ID", row["page_id"])]
            if row["record_type"] == "revisit":
                size = len(row["payload"].encode())
                own += [("WARC-Refers-To", f"<urn:page:{row['refers_to']}>"), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Payload-Length", size)]
                yield _record(head + own, _HTTP + "\r\n")
                return
            body = _HTTP + "\r\n" + _chunked(row["payload"], chunk_chars)
            parts = _cut(body, segment_bytes)
            if len(parts) == 1:
                yield _record(head + own, body)
                return
            yield _record([*head, *own, ("WARC-Segment-Number", 1)], parts[0])
            for k, part in enumerate(parts[1:], 2):
                last = ("WARC-Segment-Total-Length", len(body.encode()) if k == len(parts) else None)
                yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Segment-Origin-ID", rid), ("WARC-Segment-Number", k), last], part)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.record_batch({"value": pa.array([r for row in batch.to_pylist() for r in records(row)], pa.string())})

        return step

    return make


def write_archives(planned: DataFrame, path: str | None = None, segment_bytes: int = SEGMENT_BYTES, chunk_chars: int = 4096) -> str:
    """Write the records that ``plan_records`` planned; returns the folder of the archives, in the shared folder if
    none is named."""
    path = path or fresh_path(planned.sparkSession, "warc")
    map_batches(planned, _encode(segment_bytes, chunk_chars), "value string").write.option("lineSep", "\r\n").option("compression", "gzip").text(path)
    return path


_PARSED = """page_id long, record_type string, digest string, refers_to long, payload_length long, record_id string,
 origin string, segment int, total long, body binary, payload binary"""


def _parse():
    number = lambda v: None if v is None else int(v)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = {k.split()[0]: [] for k in _PARSED.split(",")}
        for value in batch.column("value").to_pylist():
            if not value:
                continue
            head, _, rest = value.encode().partition(b"\r\n\r\n")
            h = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n"))}
            body = rest[:int(h["content-length"])]
            if rest[len(body):] not in (b"\r\n\r\n", b"\r\n"):
                raise ValueError("record does not end where its length says")
            refers, part = h.get("warc-refers-to"), "warc-segment-number" in h
            for k, v in (
                ("page_id", number(h.get("x-page-id"))), ("record_type", h["warc-type"]),
                ("digest", h.get("warc-payload-digest", "").removeprefix("sha1:") or None),
                ("refers_to", None if refers is None else int(refers[len("<urn:page:"):-1])),
                ("payload_length", number(h.get("x-payload-length"))), ("record_id", h["warc-record-id"]),
                ("origin", h.get("warc-segment-origin-id")), ("segment", number(h.get("warc-segment-number"))),
                ("total", number(h.get("warc-segment-total-length"))), ("body", body if part else None),
                ("payload", None if part else _payload(h["warc-type"], body)),
            ):
                out[k].append(v)
        types = {"page_id": pa.int64(), "refers_to": pa.int64(), "payload_length": pa.int64(), "segment": pa.int32(), "total": pa.int64(), "body": pa.binary(), "payload": pa.binary()}
        return pa.record_batch({k: pa.array(v, types.get(k, pa.string())) for k, v in out.items()})

    return step


def _payload(kind: str, body: bytes) -> bytes | None:
    head, _, rest = body.partition(b"\r\n\r\n")
    if kind == "revisit":
        return None
    return dechunk(rest) if b"transfer-encoding: chunked" in head.lower() else rest


def _decode():
    """The payloads of continued records, whose bodies come as lists of parts."""
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [_payload(k, b"".join(b)) for k, b in zip(batch.column("record_type").to_pylist(), batch.column("body").to_pylist())]
        return batch.set_column(batch.schema.get_field_index("body"), "payload", pa.array(found, pa.binary()))

    return step


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, record_type, digest, refers_to, payload_length, payload``; the payload of a revisit is null.

    A continued record whose segments are not 1 to n, or whose total length differs, ends the query with an error:
    half a page must not pass for a whole one.
    """
    raw = spark.read.option("lineSep", VERSION).text(path)
    records = map_batches(raw, _parse, _PARSED)
    keys = ("page_id", "record_type", "digest", "refers_to", "payload_length")
    whole = records.where("segment is null").select(*keys, "payload")
    joined = records.where("segment is not null").groupBy(F.coalesce("origin", "record_id").alias("origin")).agg(
        *(F.min_by(k, "segment").alias(k) for k in keys), F.max("segment").alias("n"), F.max("total").alias("total"),
        F.sort_array(F.collect_list(F.struct("segment", "body"))).alias("parts"),
    )
    length = F.aggregate("parts", F.lit(0).cast("long"), lambda acc, p: acc + F.octet_length(p["body"]))
    ordered = F.transform("parts", lambda p: p["segment"]) == F.sequence(F.lit(1), F.size("parts"))
    checked = F.when(ordered & (length == F.col("total")), F.transform("parts", lambda p: p["body"])).otherwise(
        F.raise_error(F.concat(F.lit("broken segments of "), F.col("origin"))).cast("array<binary>"))
    schema = "page_id long, record_type string, digest string, refers_to long, payload_length long, payload binary"
    return whole.unionByName(map_batches(joined.select(*keys, checked.alias("body")), _decode, schema))
