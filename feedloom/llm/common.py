"""Helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from feedloom.session import fresh_path

_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BYTES, _USUAL = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
#: Bytes of an Arrow batch between an executor and its Python workers, where the session leaves Spark's own 64 MB.
BATCH_BYTES = 8_000_000
Rows = Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of what several later steps read, by a table in the shared folder; a lost executor costs a
    re-read. The folder belongs to the cluster, which removes it with the application. The shuffle files of the write
    have no further reader, so Spark removes them at its end."""
    spark = df.sparkSession
    path, before = fresh_path(spark, label), spark.conf.get(_CLEAN)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, fn: Callable[[], Rows], schema: StructType | str, chars: int = 4 << 20) -> DataFrame:
    """Apply ``fn()`` to Arrow batches; ``fn`` is called once per task, so it can build tables and memos there.

    A batch is cut into slices of at most about ``chars`` bytes (one row at least), which bounds a task's memory; so do
    smaller batches, in the executor too. The rows never depend on either.
    """
    conf = df.sparkSession.conf
    if conf.get(_BYTES) == _USUAL:
        conf.set(_BYTES, str(BATCH_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = fn()
        for batch in batches:
            for part in slices(batch, chars):
                out = step(part)
                yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    if not batch.num_rows:
        return
    per_row = max(1, batch.nbytes // batch.num_rows)
    if per_row * batch.num_rows <= limit:
        yield batch
        return
    texts = [c for c in batch.columns if pa.types.is_string(c.type) or pa.types.is_large_string(c.type)]
    sizes = [0] * batch.num_rows
    for column in texts:
        for i, n in enumerate(pc.binary_length(column).fill_null(0).to_pylist()):
            sizes[i] += n
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    yield batch.slice(start)


def rewrite_text(df: DataFrame, fn: Callable[[], Callable[[list], list]], text: str = "text",
                 length: str | None = "n_chars") -> DataFrame:
    """``df`` with the texts replaced by ``fn()(texts)`` and ``length`` brought up to date; other columns pass through.

    A text for which ``fn`` gives back the same string keeps its row unchanged.
    """
    def make() -> Rows:
        change = fn()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            old = batch.column(text).to_pylist()
            new = change(old)
            out = batch.set_column(batch.schema.get_field_index(text), text, pa.array(new, batch.column(text).type))
            if length in batch.schema.names:
                was = batch.column(length).to_pylist()
                now = [w if a == b else len(b or "") for w, a, b in zip(was, old, new)]
                out = out.set_column(batch.schema.get_field_index(length), length, pa.array(now, batch.column(length).type))
            return out

        return step

    return map_batches(df, make, df.schema)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores behind those that ``df`` has already (in any case of letters)."""
    used, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def row_keys(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """The named columns beside a unique ``key``; the table is written, so that the key stays what it is."""
    return stage(df.select(F.monotonically_increasing_id().alias(key), *columns), key)


def hex_digest(data: bytes) -> str:
    import hashlib

    return hashlib.sha256(data).hexdigest()
