"""Full snapshots of relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_bounds(spark: SparkSession, options: dict[str, str], table: str, column: str) -> tuple[int, int]:
    """Smallest and largest value of a numeric key, computed by the database."""
    query = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    row = spark.read.format("jdbc").options(**options).option("query", query).load().first()
    return (int(row[0]), int(row[1])) if row[0] is not None else (0, 0)


def jdbc_options(
    options: dict[str, str], table: str, column: str, bounds: tuple[int, int], partitions: int
) -> dict[str, str]:
    """Reader options for a read split over ranges of ``column``."""
    lower, upper = bounds
    return {
        "fetchsize": "10000",
        **options,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper + 1),
        "numPartitions": str(partitions),
    }


def extract_table(
    spark: SparkSession, source: dict, table: str, column: str = "id", partitions: int = 64
) -> DataFrame:
    """Snapshot of one table.

    ``source`` is ``{"format": "jdbc", "options": {...}}`` with the caller's
    connection settings, or ``{"format": "parquet", "root": folder}`` for a
    store that already keeps its tables as files. A database is read by
    ``partitions`` tasks at a time, each with its own range of ``column``.
    """
    if source["format"] == "jdbc":
        options = source["options"]
        bounds = jdbc_bounds(spark, options, table, column)
        return spark.read.format("jdbc").options(
            **jdbc_options(options, table, column, bounds, partitions)
        ).load()
    return spark.read.format(source["format"]).load(f"{source['root'].rstrip('/')}/{table}")


def skip_empty(df: DataFrame) -> bool:
    """Whether a snapshot has nothing to land. Stops at the first row found."""
    return df.isEmpty()
