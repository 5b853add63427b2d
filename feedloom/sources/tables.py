"""Parquet tables of the store.

``articles`` is partitioned by the day of the first fetch, which never changes for a row, so an upsert or a
backfill rewrites only the days it touches. They go to the folder of a new version; a manifest, renamed into place
last, names for each day the version that holds it. A run lost before that leaves the table as it was, and readers
keep the files they began with. A writer says which version its rows were made from; if another was published since,
the write is refused, and merges begin again on the days concerned.

``seen`` and ``runs_log`` are appended per run and a repeated run replaces its own rows. Folders of runs that will not
be repeated are merged into one now and then, published by a manifest too. The small mutable tables are written as new
snapshots; Spark's success marker publishes one, and old ones are removed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom import schemas
from feedloom.operators.merge import upsert_articles
from feedloom.session import broadcast_if_small, is_small

DAY = "fetched_date"
VERSION, MANIFESTS = "version", "_manifests"
RUN = "run"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"
_DAY_FIELD = T.StructField(DAY, T.DateType())
_RUN_FIELD = T.StructField(RUN, T.StringType())
_MERGED_RUN = T.StructField("merged_run", T.StringType())


@dataclass(frozen=True)
class Store:
    """Locations of the tables under one root folder."""

    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return fs.exists(p)


# ---- articles --------------------------------------------------------------------------------------------

class VersionConflict(RuntimeError):
    """Another run published a version after the one that rows were made from."""


class Version(NamedTuple):
    """A published version: its number and its day folders; 0 and none before the first."""

    number: int
    folders: tuple[str, ...]

    def on(self, first: date | None, last: date | None) -> list[str]:
        """The folders of the days from ``first`` to ``last``, known from their names alone."""
        days = {f: f.rpartition("=")[2] for f in self.folders}
        dated = {f: None if d == _NO_DAY else date.fromisoformat(d) for f, d in days.items()}
        return [f for f, d in dated.items() if (not first and not last) or (d and (not first or d >= first) and (not last or d <= last))]


def current_version(spark: SparkSession, path: str) -> Version:
    """The version that is read now; its manifest has one line per day."""
    fs, p = _fs_path(spark, f"{path}/{MANIFESTS}")
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    number = max((int(n) for n in names if n.isdigit()), default=0)
    if not number:
        return Version(0, ())
    return Version(number, tuple(r[0] for r in spark.read.text(f"{path}/{MANIFESTS}/{number}").collect()))


def _publish(spark: SparkSession, path: str, number: int, folders: list[str]) -> None:
    """Make a version the one that is read."""
    _publish_lines(spark, f"{path}/{MANIFESTS}", number, folders)


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


def _publish_lines(spark: SparkSession, folder: str, number: int, lines: list[str]) -> None:
    """Write a numbered manifest; a rename is one step, and fails if another run took the number."""
    fs, final = _fs_path(spark, f"{folder}/{number}")
    draft = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/draft-{uuid.uuid4().hex}")
    out = fs.create(draft)
    try:
        out.write(bytearray("".join(f"{line}\n" for line in lines), "utf-8"))
    finally:
        out.close()
    if fs.exists(final) or not fs.rename(draft, final):
        fs.delete(draft, False)
        raise VersionConflict(f"version {number} in {folder} was published by another run")


def read_articles(spark: SparkSession, path: str, first: date | None = None, last: date | None = None, version: Version | None = None) -> DataFrame:
    """Articles with their partition column; columns an older file lacks read as NULL.

    ``first`` and ``last`` prune the days outside them before any folder is listed. ``version`` is the one to read, for
    rows that will be written back.
    """
    whole = T.StructType([*schemas.ARTICLES.fields, _DAY_FIELD])
    folders = (version or current_version(spark, path)).on(first, last)
    if not folders:
        return spark.createDataFrame([], whole)
    articles = spark.read.schema(whole).option("basePath", path).parquet(*(f"{path}/{f}" for f in folders)).select(*whole.names)
    if first:
        articles = articles.filter(F.col(DAY) >= F.lit(first))
    if last:
        articles = articles.filter(F.col(DAY) <= F.lit(last))
    return articles


def newest_days(articles: DataFrame, rows: int) -> date | None:
    """The first day such that it and the later days hold at least ``rows`` rows; None if no day bounds them.

    Counts per day need only the partition column and what ``articles`` was filtered by; the driver gets one row
    per day.
    """
    total = 0
    counts = articles.filter(F.col(DAY).isNotNull()).groupBy(DAY).agg(F.count(F.lit(1)).alias("n"))
    for row in counts.orderBy(F.desc(DAY)).collect():
        total += row["n"]
        if total >= rows:
            return row[DAY]
    return None


def write_articles(articles: DataFrame, path: str, based_on: Version | None = None) -> None:
    """Replace the days present in ``articles``; a day goes to few tasks, and AQE splits a large one.

    Rows that were read from the table name by ``based_on`` the version they were read from. If another one has been
    published since, nothing changes and ``VersionConflict`` is raised.
    """
    spark = articles.sparkSession
    number, folders = based_on or current_version(spark, path)
    version = f"{VERSION}={number + 1}-{uuid.uuid4().hex}"
    rows = schemas.conform(articles, schemas.ARTICLES).withColumn(DAY, F.col("fetched_at").cast("date"))
    writer = rows.hint("rebalance", F.col(DAY)).write.partitionBy(DAY)
    writer.parquet(f"{path}/{version}")
    fs, p = _fs_path(spark, f"{path}/{version}")
    days = {name for s in fs.listStatus(p) if (name := s.getPath().getName()).startswith(f"{DAY}=")}
    kept = [f for f in folders if f.split("/")[1] not in days]
    try:
        if current_version(spark, path).number != number:
            raise VersionConflict(f"{path} is no longer at version {number}")
        _publish(spark, path, number + 1, kept + [f"{version}/{day}" for day in sorted(days)])
    except VersionConflict:
        fs.delete(p, True)
        raise


def write_again_on_conflict(write: Callable[[Version], None], spark: SparkSession, path: str, attempts: int = 5) -> None:
    """``write(version)`` on the version that is current, and again on a newer one if another run published it."""
    for left in reversed(range(attempts)):
        try:
            return write(current_version(spark, path))
        except VersionConflict:
            if not left:
                raise


def expire_articles(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove what only versions before the last ``keep`` refer to, and what lost runs left.

    Not for use while another run writes, since its version is not published yet.
    """
    fs, p = _fs_path(spark, f"{path}/{MANIFESTS}")
    names = {s.getPath().getName() for s in fs.listStatus(p)} if fs.exists(p) else set()
    numbers = sorted(int(n) for n in names if n.isdigit())[-keep:]
    if not numbers:
        return
    used = {r[0] for r in spark.read.text([f"{path}/{MANIFESTS}/{n}" for n in numbers]).distinct().collect()}
    for name in names - {str(n) for n in numbers}:
        fs.delete(_fs_path(spark, f"{path}/{MANIFESTS}/{name}")[1], True)
    for version in fs.listStatus(_fs_path(spark, path)[1]):
        if not version.getPath().getName().startswith(f"{VERSION}="):
            continue
        days = [d.getPath() for d in fs.listStatus(version.getPath()) if d.isDirectory()]
        gone = [d for d in days if f"{version.getPath().getName()}/{d.getName()}" not in used]
        for folder in [version.getPath()] if len(gone) == len(days) else gone:
            fs.delete(folder, True)


def touched_days(articles: DataFrame, changes: DataFrame) -> list[date]:
    """Days holding rows of ``changes``; one value per day of the table's life at most."""
    hit = articles.select("uid", DAY).join(broadcast_if_small(changes.select("uid")), "uid", "left_semi")
    return [r[DAY] for r in hit.select(DAY).distinct().collect()]


def on_days(days: Iterable[date | None]) -> Column:
    """Rows of the given days; None stands for rows without a fetch time."""
    known = [d for d in days if d is not None]
    on = F.col(DAY).isin(*known)
    return F.coalesce(on, F.lit(None in days)) if known else F.col(DAY).isNull() & F.lit(None in days)


def merge_articles(spark: SparkSession, path: str, updates: DataFrame) -> None:
    """Upsert ``updates`` (one row per uid), reading and rewriting only the days concerned; what other runs publish
    meanwhile is merged with, not lost."""
    own = {r[0] for r in updates.select(F.col("fetched_at").cast("date")).distinct().collect()}

    def write(version: Version) -> None:
        articles = read_articles(spark, path, version=version)
        days = own | set(touched_days(articles, updates))
        old = articles.filter(on_days(days)).drop(DAY)
        write_articles(upsert_articles(old, schemas.conform(updates, schemas.ARTICLES)), path, version)

    write_again_on_conflict(write, spark, path)


# ---- append-only tables ----------------------------------------------------------------------------------

MERGES, MERGED = "_merges", "merged-"
KEEP_RUNS = 64
BUCKET, BUCKETS = "bucket", 256
_BUCKET_FIELD = T.StructField(BUCKET, T.IntegerType())


def _merge_record(spark: SparkSession, path: str) -> tuple[int, str | None, set[str]]:
    """The last merge of run folders: its number, the folder it made, and the folders that this one stands for."""
    fs, p = _fs_path(spark, f"{path}/{MERGES}")
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    number = max((int(n) for n in names if n.isdigit()), default=0)
    if not number:
        return 0, None, set()
    lines = [r[0] for r in spark.read.text(f"{path}/{MERGES}/{number}").collect()]
    return number, next(line[1:] for line in lines if line[0] == "+"), {line for line in lines if line[0] != "+"}


def _run_folders(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Folders that are read, the oldest first, each with the time it was last changed."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    _, made, replaced = _merge_record(spark, path)
    found = [(s.getModificationTime(), s.getPath().getName()) for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith(f"{RUN}=")]
    return sorted(f for f in found if f[1] == made or not (f[1] in replaced or f[1].startswith(f"{RUN}={MERGED}")))


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _rows_of(spark: SparkSession, path: str, schema: T.StructType, names: list[str], buckets: list[int] | None = None) -> DataFrame:
    """The rows of run folders with the run that appended each; of merged folders only the named buckets."""
    whole = T.StructType([*schema.fields, _RUN_FIELD])
    out = spark.createDataFrame([], whole)
    single = [n for n in names if not n.startswith(f"{RUN}={MERGED}")]
    if single:
        out = spark.read.schema(whole).option("basePath", path).parquet(*(f"{path}/{n}" for n in single)).select(*whole.names)
    for name in set(names) - set(single):
        rows = spark.read.schema(T.StructType([*schema.fields, _MERGED_RUN, _BUCKET_FIELD])).parquet(f"{path}/{name}")
        if buckets is not None:
            rows = rows.filter(F.col(BUCKET).isin(buckets))
        rows = rows.select(*schema.names, F.col(_MERGED_RUN.name).alias(RUN))
        out = out.unionByName(rows) if single else rows
    return out


def read_appended(spark: SparkSession, path: str, schema: T.StructType, buckets: list[int] | None = None) -> DataFrame:
    """All rows with the run that appended them, also of merged runs. ``buckets`` leaves out merged rows of others."""
    return _rows_of(spark, path, schema, [name for _, name in _run_folders(spark, path)], buckets)


def read_ledger(spark: SparkSession, path: str, schema: T.StructType, keys: DataFrame, key: str = "uid") -> DataFrame:
    """The rows of a bucketed table that ``keys`` can meet, and others: for a small batch only the folders of its
    buckets are opened. What the driver gets is a list of bucket numbers."""
    buckets = None
    if is_small(keys.select(key)):
        buckets = sorted(r[0] for r in keys.select(bucket_of(key).alias(BUCKET)).distinct().collect())
    return read_appended(spark, path, schema, buckets)


def append_run(df: DataFrame, path: str, schema: T.StructType, run_id: str) -> None:
    """Append the rows of one run; writing the same run again replaces them, also by no rows."""
    spark = df.sparkSession
    name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(run_id)
    schemas.conform(df, schema).write.mode("overwrite").parquet(f"{path}/{RUN}={name}")


def merge_runs(spark: SparkSession, path: str, schema: T.StructType, keep: int = KEEP_RUNS, least: int = KEEP_RUNS, key: str | None = None) -> bool:
    """Merge the folders of all runs but the last ``keep`` into one, once there are ``least`` of them; whether it did.

    The last ``keep`` runs can be repeated: their folders stay their own. The folder of a merged run that is written
    again is not read. Folders that a merge stands for are removed by the next one, so that readers of the time before
    keep their files. Of two merges at once, one is refused. With ``key``, merged rows lie in buckets of its hash, sorted
    by it, for ``read_ledger``.
    """
    number, made, replaced = _merge_record(spark, path)
    old = [name for _, name in _run_folders(spark, path) if name != made]
    old = old[:max(0, len(old) - keep)]
    if len(old) < max(1, least):
        return False
    gone, new = [*old, *([made] if made else [])], f"{RUN}={MERGED}{uuid.uuid4().hex}"
    rows = _rows_of(spark, path, schema, gone).withColumnRenamed(RUN, _MERGED_RUN.name)
    if key:
        rows = rows.withColumn(BUCKET, bucket_of(key)).hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, key)
        rows.write.partitionBy(BUCKET).parquet(f"{path}/{new}")
    else:
        rows.hint("rebalance").write.parquet(f"{path}/{new}")
    try:
        _publish_lines(spark, f"{path}/{MERGES}", number + 1, [f"+{new}", *gone])
    except VersionConflict:
        _remove(spark, f"{path}/{new}")
        return False
    for name in replaced:
        _remove(spark, f"{path}/{name}")
    return True


# ---- small mutable tables --------------------------------------------------------------------------------

KEEP_SNAPSHOTS = 8


def _snapshots(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Published snapshots as (number, run id), oldest first."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(p)]
    done = [n.split("-", 2) for n in names if n.startswith("snap-") and path_exists(spark, f"{path}/{n}/_SUCCESS")]
    return sorted((int(number), run) for _, number, run in done)


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType, before_run: str | None = None) -> DataFrame:
    """The last published snapshot, or an empty table; ``before_run`` ignores what that run published."""
    done = [s for s in _snapshots(spark, path) if s[1] != before_run]
    if not done:
        return spark.createDataFrame([], schema)
    number, run = done[-1]
    return spark.read.schema(schema).parquet(f"{path}/snap-{number:08d}-{run}")


def write_snapshot(df: DataFrame, path: str, schema: T.StructType, run_id: str, keep: int = KEEP_SNAPSHOTS) -> None:
    """Write the next snapshot beside the one being read; readers switch when it is complete. The last ``keep`` stay."""
    spark = df.sparkSession
    done = _snapshots(spark, path)
    number = (done[-1][0] if done else 0) + 1
    schemas.conform(df, schema).write.mode("overwrite").parquet(f"{path}/snap-{number:08d}-{run_id}")
    for old, run in done[:len(done) + 1 - keep]:
        _remove(spark, f"{path}/snap-{old:08d}-{run}")
