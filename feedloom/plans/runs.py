"""Run counters, status and log rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom import schemas


def status_of(inserted: Column, failures: Column) -> Column:
    return F.when(failures == 0, "ok").when(inserted > 0, "partial_ok").otherwise("error")


def run_status(attempts: DataFrame, feeds: int = 0) -> DataFrame:
    """One row of counters and status from ``attempts(uid, ok)``; a stored uid counts once.

    The first aggregate works per uid and is combined map-side, so no distinct set is gathered.
    """
    per_uid = attempts.groupBy("uid").agg(
        F.max(F.when(F.col("ok"), 1).otherwise(0)).alias("stored"), F.count_if(~F.col("ok")).alias("failed")
    )
    totals = per_uid.agg(
        F.coalesce(F.sum("stored"), F.lit(0)).alias("inserted"), F.coalesce(F.sum("failed"), F.lit(0)).alias("failures")
    )
    return totals.select("inserted", "failures", status_of(F.col("inserted"), F.col("failures")).alias("status"))


def log_row(
    spark: SparkSession,
    run_id: str,
    script: str,
    started_at: datetime,
    finished_at: datetime,
    status: str,
    rows: int,
    notes: str = "",
) -> DataFrame:
    row = (run_id, script, started_at, finished_at, status, notes, rows)
    return spark.createDataFrame([row], schemas.RUNS_LOG)
