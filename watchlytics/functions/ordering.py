"""Rank and running total over a whole table without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from watchlytics.session import keep

BUCKET = "_bucket"


def range_buckets(df: DataFrame, order: list[Column], partitions: int | None = None) -> DataFrame:
    """``df`` cut into ranges of ``order``, numbered in ``_bucket``.

    The checkpoint stores the number with the row, so later passes see the
    same cut however often tasks are repeated. It also keeps the (aggregated)
    input from being computed again by those passes.
    """
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return keep(ranged.withColumn(BUCKET, F.spark_partition_id()))


def rank_and_running_total(
    buckets: DataFrame,
    order: list[Column],
    value: str,
    rank: str = "rank",
    running: str = "running_total",
    total: str = "total",
) -> DataFrame:
    """Row number, running total and grand total of ``value`` in ``order``.

    ``buckets`` comes from :func:`range_buckets` with the same ``order``. One
    window runs per bucket; what precedes a bucket is added from a table with
    one row per bucket, which is as small as the number of partitions.
    """
    sums = buckets.groupBy(BUCKET).agg(F.count("*").alias("_rows"), F.sum(value).alias("_sum"))
    earlier = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sums.select(
        BUCKET,
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum_before"),
        F.sum("_sum").over(everything).alias(total),
    )

    inside = Window.partitionBy(BUCKET).orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        buckets.join(F.broadcast(offsets), BUCKET)
        .withColumn(rank, F.row_number().over(inside).cast("bigint") + F.col("_rows_before"))
        .withColumn(running, F.sum(value).over(so_far) + F.col("_sum_before"))
        .drop(BUCKET, "_rows_before", "_sum_before")
    )
