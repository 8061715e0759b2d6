"""Build time of a model."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_updated_at(df: DataFrame, updated_at) -> DataFrame:
    """Add ``updated_at``, unless it is None."""
    if updated_at is None:
        return df
    return df.withColumn("updated_at", F.lit(str(updated_at)).cast("timestamp_ntz"))
