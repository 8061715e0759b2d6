"""Distributed rank and running total against one global window."""

import random

import pytest
from conftest import rows
from pyspark.sql import Window, functions as F

from watchlytics.functions.ordering import range_buckets, rank_and_running_total

def order():
    return [F.col("v").desc(), F.col("id")]


def distributed(df, partitions=None):
    return rank_and_running_total(range_buckets(df, order(), partitions), order(), "v", "rank", "running", "total")


def single_window(df):
    w = Window.orderBy(*order())
    return df.select(
        "id",
        "v",
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
        F.row_number().over(w).cast("bigint").alias("rank"),
        F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("running"),
    )


@pytest.mark.parametrize("partitions", [None, 1, 7, 50])
def test_equals_a_global_window(spark, partitions):
    rng = random.Random(5)
    # A third of the rows tie in the value, the id decides among them.
    data = [(i, 100 if i % 3 == 0 else rng.randrange(1000)) for i in range(2000)]
    df = spark.createDataFrame(data, "id int, v bigint").repartition(8)
    columns = ["id", "v", "rank", "running", "total"]
    assert rows(distributed(df, partitions), *columns) == rows(single_window(df), *columns)


def test_many_buckets_share_the_ties(spark):
    df = spark.range(1000).select(F.col("id").cast("int").alias("id"), F.lit(5).cast("bigint").alias("v"))
    assert range_buckets(df, order(), 10).groupBy("_bucket").count().count() == 10


def test_empty(spark):
    assert distributed(spark.createDataFrame([], "id int, v bigint")).count() == 0
