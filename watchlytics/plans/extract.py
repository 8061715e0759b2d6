"""Extract the nine source tables into dated landing folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from watchlytics.sources.landing import land_all_tables
from watchlytics.sources.relational import extract_table


def run_extract(spark: SparkSession, source: dict, landing: str, as_of: str, partitions: int = 64) -> DataFrame:
    """Land one day of every table; returns the rows written per table.

    Each table is read in ``partitions`` ranges of its key and every range is
    written by the task that read it: rows never pass through the driver.
    """
    return land_all_tables(
        spark, lambda table: extract_table(spark, source, table, partitions=partitions), landing, as_of
    )
