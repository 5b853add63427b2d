"""Row numbers, for bounded results and for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedloom.session import stage

SLICE_ROWS = 1_000_000


def first_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every group; ``n <= 0`` keeps all.

    The rank filter lets Spark cut each group to ``n`` rows per task before the shuffle, so a hot group sends
    at most ``n`` rows from each task.
    """
    if n <= 0:
        return df
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def bounded_rank(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Row number inside a result that a limit has already bounded."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))


def rank_within(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    name: str,
    slices: int | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Row number per group without ever gathering a group in one task.

    Rows are range-partitioned by group and order, so a large group spans many slices. The slice of each row
    is written down (a later recomputation could draw other range bounds). A row's number is its number inside
    the slice plus the rows of its group in earlier slices, known from one small count per group and slice.

    Bounds come from quantiles of the keys. If a slice has more than ``slice_rows`` rows all the same, there are cut
    as many more slices as that takes, whatever the session's number of partitions; only rows that tie in group and
    order stay together.
    """
    spark = df.sparkSession
    group = list(group)
    slices = slices or max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )
    by_group = [F.col(g).asc_nulls_first() for g in group]
    largest, rows = None, df
    while True:
        sliced = stage(rows.repartitionByRange(slices, *by_group, *order).withColumn("_slice", F.spark_partition_id()), "rank")
        before, largest = largest, sliced.groupBy("_slice").count().agg(F.max("count")).first()[0] or 0
        if largest <= slice_rows or before == largest:
            break
        slices, rows = slices * (largest // slice_rows + 1), sliced.drop("_slice")
    sizes = sliced.groupBy(*group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = (
        Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(
        *(F.col(g).alias(f"_g_{g}") for g in group),
        F.col("_slice").alias("_g_slice"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
    )
    numbered = sliced.withColumn(
        "_in_slice", F.row_number().over(Window.partitionBy("_slice", *group).orderBy(*order))
    )
    same = F.col("_slice") == F.col("_g_slice")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    return numbered.join(offsets, same).select(
        *df.columns, (F.col("_in_slice") + F.col("_before")).cast("int").alias(name)
    )
