"""Grouped aggregates together with a distinct count."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def with_distinct_count(
    df: DataFrame, keys: dict[str, Column], value: str, name: str, aggregates: list[Column]
) -> DataFrame:
    """Group by ``keys`` and count the distinct values of ``value`` as ``name``.

    In a single aggregation every pair of key and value would be shuffled with
    the state of all aggregates. Here the aggregates shrink to one row per key
    before they move, and only bare pairs are shuffled for the count. Pairs
    are spread over all tasks, so one large group is no burden.
    """
    grouping = [column.alias(key) for key, column in keys.items()]
    grouped = df.groupBy(*grouping).agg(*aggregates)
    pairs = df.select(*grouping, F.col(value).alias("_value")).distinct()
    counted = pairs.groupBy(*(F.col(key).alias(f"_d_{key}") for key in keys)).agg(F.count("_value").alias(name))
    same = reduce(Column.__and__, (F.col(key).eqNullSafe(F.col(f"_d_{key}")) for key in keys))
    return grouped.join(counted, same).drop(*(f"_d_{key}" for key in keys))


#: How partial results of an aggregate come together.
MERGES = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


def merged_over(
    df: DataFrame, keys: dict[str, Column], value: str, name: str, parts: dict[str, tuple[str, Column]]
) -> DataFrame:
    """Group by ``keys``, with the distinct values of ``value`` counted as ``name``, in one pass over ``df``.

    ``parts`` names the other aggregates, each a kind (count, sum, min, max) and its column. They are taken per key and
    value first, where every distinct value is one row, and merged per key from there: the rows are read once
    and nothing is joined. A large group spreads over the tasks by its values.
    """
    start = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    grouping = [column.alias(key) for key, column in keys.items()]
    per_value = df.groupBy(*grouping, F.col(value).alias("_value")).agg(
        *(start[kind](column).alias(part) for part, (kind, column) in parts.items())
    )
    merged = [MERGES[kind](part).alias(part) for part, (kind, _) in parts.items()]
    return per_value.groupBy(*keys).agg(F.count("_value").alias(name), *merged)
