"""Session settings, the shared work folder, and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings every job wants. Partition counts are left to the cluster; AQE coalesces and splits them.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

#: Narrow key tables up to so many rows are broadcast; the rows of a result never depend on it.
BROADCAST_KEYS = 200_000


def build_session(app_name: str = "feedloom", master: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**JOB_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a local session, where every executor is on this machine, may fall back to a temporary folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="feedloom-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


#: Paths of the tables that the job running here has staged; None outside of a job.
_STAGED: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage of a result that several later steps read, by a table in the shared folder.

    A lost executor then costs a re-read, not a recomputation. Inside ``staging`` the table is removed at
    the end of the job; else it stays with the cluster's folder, since the result may still be read.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    if (mine := _STAGED.get()) is not None:
        mine.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """A job's own staged tables: those made inside are removed at its end, also when it fails; other jobs' stay."""
    mine: list[str] = []
    token = _STAGED.set(mine)
    try:
        yield
    finally:
        _STAGED.reset(token)
        sc = spark.sparkContext
        for path in mine:
            location = sc._jvm.org.apache.hadoop.fs.Path(path)
            location.getFileSystem(sc._jsc.hadoopConfiguration()).delete(location, True)


def is_small(df: DataFrame, max_rows: int = BROADCAST_KEYS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows; the count stops right after that."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_KEYS) -> DataFrame:
    """Broadcast a narrow key table only after a count has proved the bound; otherwise let the join shuffle."""
    return F.broadcast(df) if is_small(df, max_rows) else df


def read_spread(spark: SparkSession, path: str, key: str, bytes_per_core: int = 64 << 20) -> DataFrame:
    """Read a Parquet table for CPU-heavy work such as parsing.

    A small table may sit in one row group and so in one task; it is spread over all cores by its unique ``key``,
    at a cost bounded by ``bytes_per_core``. A larger one has enough splits and is read as it is, without a shuffle.
    """
    sc = spark.sparkContext
    location = sc._jvm.org.apache.hadoop.fs.Path(path)
    size = location.getFileSystem(sc._jsc.hadoopConfiguration()).getContentSummary(location).getLength()
    df = spark.read.parquet(path)
    return df.repartition(sc.defaultParallelism, key) if size < sc.defaultParallelism * bytes_per_core else df
